"""Every view of the engine by name, wired from the stored tables.

:func:`build_views` is lazy.  With a storage folder, :func:`refresh` writes the
views that many others read, so their JSON parsing, dedup and joins are paid
once; :func:`build_views` then starts from the stored versions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsboard.functions.time import BOARD_ZONE
from newsboard.operators import analysis as N
from newsboard.operators import articles as A
from newsboard.operators import digests as D
from newsboard.operators import register as R
from newsboard.operators import routing as C
from newsboard.operators import sectors as S
from newsboard.operators.boards import leaderboard
from newsboard.operators.counting import period_counts
from newsboard.plans.storage import current, materialize
from newsboard.sources.feed import parse_analyses, parse_entries

GRAINS = ("day", "week", "month")

TABLES = (
    "feedly_entries", "feedly_entry_text_analyses", "organizations", "category_groups",
    "channels", "concepts", "channel_concepts", "concept_entity_rules",
)

# Views worth storing, in the order in which they depend on each other.
STORED = (
    "articles", "vw_article_nlp_topics", "vw_article_nlp_entities", "vw_article_nlp_companies",
    "xr_company_articles_with_sectors", "vw_xr_channel_articles", "vw_xr_channel_article_details",
    "vw_organization_categories", "vw_organization_category_groups",
    "vw_categories_with_category_groups", "vw_category_list", "vw_category_groups_list",
)

# Columns that only save joins inside the engine, hidden from registered views.
_HELPERS = {
    "articles": A.ITEM_COLUMNS,
    "vw_feedly_entry_details": A.ITEM_COLUMNS,
    "vw_xr_article_rankings": A.ITEM_COLUMNS,
    "vw_article_nlp_topics": ["published_at"],
    "vw_article_nlp_entities": ["published_at"],
    "vw_article_nlp_companies": ["categories", "category_groups", "published_at"],
}


class Views(Mapping[str, DataFrame]):
    """Views by name; one is planned when it is first asked for."""

    def __init__(self, stored: Mapping[str, DataFrame]):
        self._plans: dict[str, Callable[[], DataFrame]] = {}
        self._frames: dict[str, DataFrame] = dict(stored)
        self._stored = frozenset(stored)

    def has_stored(self, names: Iterable[str]) -> bool:
        return self._stored.issuperset(names)

    def add(self, name: str, plan: Callable[[], DataFrame]) -> None:
        self._plans[name] = plan

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._plans[name]()
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._plans)

    def __len__(self) -> int:
        return len(self._plans)


def build_views(
    tables: Mapping[str, DataFrame],
    as_of: datetime,
    week: datetime | None = None,
    zone: str = BOARD_ZONE,
    alternates: str = "first",
    stored: Mapping[str, DataFrame] | None = None,
) -> Views:
    """All views over ``tables`` (see :data:`TABLES`).

    ``as_of`` is the moment the digests look back from, ``week`` the local
    Monday of the popularity ranking.  Views found in ``stored`` are taken as
    they are instead of being planned again.
    """
    v = Views(stored or {})
    _feed_views(v, tables, alternates)
    if week is not None:
        v.add("vw_xr_article_rankings", lambda: A.article_rankings(v["articles"], week, zone=zone))
    _analysis_views(v, tables)
    _register_views(v, tables)
    _board_views(v, zone)
    _digest_views(v, as_of, zone)
    _channel_views(v, tables, zone)
    return v


def _feed_views(v: Views, tables: Mapping[str, DataFrame], alternates: str) -> None:
    v.add(
        "vw_feedly_entry_details",
        lambda: A.entry_details(parse_entries(tables["feedly_entries"]), alternates),
    )
    v.add("articles", lambda: A.articles(v["vw_feedly_entry_details"]))
    for name, make in (
        ("vw_article_common_topics", A.common_topics),
        ("vw_article_entities", A.feed_entities),
        ("vw_article_keywords", A.keywords),
        ("vw_article_summary_sentences", A.summary_sentences),
        ("vw_article_priorities", A.priorities),
        ("vw_article_entities_by_topics", A.entities_by_topics),
        ("vw_article_entities_by_keywords", A.entities_by_keywords),
    ):
        v.add(name, lambda make=make: make(v["articles"]))
    v.add("vw_article_common_common_topic_list", lambda: A.topic_list(v["vw_article_common_topics"]))
    v.add("vw_article_entity_list", lambda: A.entity_list(v["vw_article_entities"]))
    v.add("vw_article_keyword_list", lambda: A.keyword_list(v["vw_article_keywords"]))
    for grain in GRAINS:
        for subject, source, label in (
            ("topics", "vw_article_common_topics", "topic_label"),
            ("keywords", "vw_article_keywords", "keyword"),
            ("entities", "vw_article_entities", "entity_label"),
        ):
            v.add(
                f"vw_article_{subject}_by_{grain}",
                lambda source=source, label=label, grain=grain: period_counts(v[source], label, grain),
            )


def _analysis_views(v: Views, tables: Mapping[str, DataFrame]) -> None:
    parsed = lambda: parse_analyses(tables["feedly_entry_text_analyses"])
    for name, make in (
        ("vw_article_nlp_topics", partial(N.analysis_topics, with_time=True)),
        ("vw_article_nlp_entities", partial(N.analysis_entities, with_time=True)),
        ("vw_article_nlp_text", N.analysis_text),
        ("vw_article_nlp_categories", N.analysis_categories),
    ):
        v.add(name, lambda make=make: make(v["articles"], parsed()))
    v.add(
        "vw_article_nlp_companies",
        lambda: N.resolve_companies(v["vw_article_nlp_entities"], tables["organizations"]),
    )
    v.add("vw_xr_nlp_topics", lambda: N.matching_labels(v["vw_article_nlp_topics"]))
    v.add("vw_xr_topics", lambda: N.canonical_labels(v["vw_xr_nlp_topics"]))
    v.add(
        "vw_nlp_entities_without_concepts",
        lambda: N.uncovered_types(v["vw_article_nlp_entities"], tables["concept_entity_rules"]),
    )


def _register_views(v: Views, tables: Mapping[str, DataFrame]) -> None:
    for name, make, table in (
        ("vw_organization_categories", R.org_categories, "organizations"),
        ("vw_organization_category_groups", R.org_category_groups, "organizations"),
        ("vw_categories_with_category_groups", R.category_map, "category_groups"),
        ("vw_category_list", R.category_list, "category_groups"),
        ("vw_category_groups_list", R.group_list, "category_groups"),
    ):
        v.add(name, lambda make=make, table=table: make(tables[table]))


def _board_views(v: Views, zone: str) -> None:
    def of_companies(make):
        return lambda: make(v["articles"], v["vw_article_nlp_companies"])

    def ranked_topics() -> DataFrame:
        topics = N.subject_topics(v["vw_article_nlp_topics"])
        return S.topic_mentions(v["articles"], topics.withColumnRenamed("topic_label", "ranked_name"))

    for grain in GRAINS:
        for subject, rows, by, options in (
            ("companies", of_companies(S.company_mentions), "name", {}),
            ("categories", of_companies(S.category_mentions), "category", {}),
            ("category_groups", of_companies(S.group_mentions), "category_group", {}),
            ("companies_by_categories", of_companies(S.category_mentions), "name", {"within": "category"}),
            ("topics", ranked_topics, "ranked_name", {"score": "topic_score"}),
        ):
            v.add(
                f"vw_xr_ranked_{subject}_by_{grain}",
                lambda rows=rows, by=by, grain=grain, options=options: leaderboard(
                    rows(), by, grain, zone, **options
                ),
            )


def _digest_views(v: Views, as_of: datetime, zone: str) -> None:
    inputs = lambda: (v["articles"], v["vw_article_nlp_topics"], v["vw_article_nlp_companies"])
    v.add("xr_company_articles_with_sectors", lambda: S.company_articles(*inputs()))
    v.add("vw_latest_articles", lambda: D.latest_digest(*inputs(), as_of, None, zone))
    v.add("vw_top_articles_last_24_hours", lambda: D.top_digest(*inputs(), as_of, None, zone))


def _channel_views(v: Views, tables: Mapping[str, DataFrame], zone: str) -> None:
    v.add(
        "vw_xr_channel_articles",
        lambda: C.route(
            v["articles"], v["vw_article_nlp_entities"],
            N.subject_topics(v["vw_article_nlp_topics"], distinct_topics=True),
            tables["concept_entity_rules"], tables["concepts"], tables["channel_concepts"],
            tables["channels"], zone,
        ),
    )
    v.add(
        "vw_xr_channel_article_details",
        lambda: C.details_of(v["articles"], v["vw_article_nlp_entities"], v["vw_article_nlp_topics"],
                             v["vw_article_nlp_companies"], tables),
    )
    parts = ("vw_article_nlp_entities", "vw_article_nlp_topics", "vw_article_nlp_companies")
    v.add(
        "vw_xr_channel_articles_unsent_by_channel_and_target",
        # Stored parts are narrowed where they are read, documents before they are parsed.
        lambda: C.unsent_of(v["articles"], *(v[p] for p in parts), tables, zone=zone)
        if v.has_stored(parts)
        else C.unsent_from(v["articles"], tables["feedly_entry_text_analyses"], tables, zone=zone),
    )


def register_views(views: Mapping[str, DataFrame]) -> None:
    """Make the views available to ``spark.sql`` under their names."""
    for name, df in views.items():
        df.drop(*_HELPERS.get(name, [])).createOrReplaceTempView(name)


def load_stored(spark: SparkSession, root: str, names: Iterable[str] = STORED) -> dict[str, DataFrame]:
    """The current version of every stored view below ``root``."""
    found = {name: current(spark, f"{root}/{name}") for name in names}
    return {name: df for name, df in found.items() if df is not None}


def refresh(
    tables: Mapping[str, DataFrame],
    root: str,
    as_of: datetime,
    names: Iterable[str] = STORED,
    **options,
) -> Views:
    """Write new versions of ``names`` and return all views on top of them.

    Names are written in dependency order, each from the versions written just
    before, and views that are not named keep the version they have.
    """
    wanted = set(names)
    unknown = wanted - set(STORED)
    if unknown:
        raise ValueError(f"not stored: {sorted(unknown)}")
    spark = next(iter(tables.values())).sparkSession
    stored = {n: df for n, df in load_stored(spark, root).items() if n not in wanted}
    for name in STORED:
        if name in wanted:
            view = build_views(tables, as_of, stored=stored, **options)[name]
            stored[name] = materialize(view, f"{root}/{name}")
    return build_views(tables, as_of, stored=stored, **options)
