"""Views that read the text-analysis document: topics, entities, companies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from newsboard.functions.json import json_num
from newsboard.functions.text import any_ilike, any_like, map_labels, split_list
from newsboard.functions.time import moment
from newsboard.operators.joins import spread_join, together
from newsboard.operators.ranking import dedupe_by_rank
from newsboard.operators.unnest import distinct_values, unnest

# Topic patterns, canonical labels and labels left out.
TOPIC_INCLUDE = ("%reality%", "%learn%", "%virtual%")
TOPIC_EXCLUDE = ("%reality television%",)
CANONICAL_LABELS = {
    "Virtual reality headset": "Virtual reality headsets",
    "Virtual reality organizations": "Virtual reality companies",
    "Virtual machine": "Virtual machines",
    "Virtual economy": "Virtual economies",
    "Virtual assistant": "Virtual assistants",
    "Mixed reality game": "Mixed reality games",
}
STOP_LABELS = ("Alternate reality", "Virtual reality", "Mixed reality", "Reality")

# Entity types that name a company.
COMPANY_TYPES = ("Company", "Organisation")

# Entity types per theme, as LIKE patterns.
THEMES = {
    "sports": ("%League", "%Team", "Tournament", "Racecourse", "Stadium", "Sports%", "Soccer%"),
    "culture": ("TopicalConcept", "%Show", "VideoGame", "Fashion", "MusicalArtist", "MusicalWork"),
    "academia": (
        "University", "EducationalInstitution", "AcademicJournal", "AcademicConference", "School",
    ),
    "events": ("Venue", "Theatre", "Event"),
}

_STAMPS = ["created_at", "updated_at", "published_at", "feedly_id"]

_ENTITY_KEYS = [
    "entity_type", "entity_id", "unit", "crunchbase_id", "figi", "freebase_id", "lei",
    "permid", "wikidata_id", "wiki_link", "matched_text", "starting_pos", "matching_tokens",
]

_ORG_COLUMNS = [
    "uuid", "name", "short_description", "legal_name", "permalink", "cb_url", "status",
    "logo_url", "state_code", "country_code", "region", "city", "closed_on",
]

COMPANY_COLUMNS = [
    "feedly_id", "entity_id", "entity_external_id", "relevance_score", "confidence_sore",
    "uuid", "name", "short_description", "legal_name", "crunchbase_id", "permalink",
    "cb_url", "status", "logo_url", "state_code", "country_code", "region", "city", "closed_on",
]


def _of_articles(articles: DataFrame, parsed: DataFrame, cols: Sequence[str], keep: Sequence[str]) -> DataFrame:
    # Arrays are joined before they are unnested: one shuffled row per article.
    # The id is unique on both sides, so no key is hot.
    return articles.select(*keep).join(parsed.select("feedly_id", *cols), "feedly_id")


def _time(df: DataFrame) -> list[str]:
    """The publishing time, if it travels with the rows: boards then need no
    join back to the articles."""
    return ["published_at"] if "published_at" in df.columns else []


def analysis_topics(articles: DataFrame, parsed: DataFrame, with_time: bool = False) -> DataFrame:
    kept = ["feedly_id", "published_at"] if with_time else ["feedly_id"]
    return unnest(
        _of_articles(articles, parsed, ["topics"], kept),
        F.col("topics"),
        {
            "topic_position": ("id", "int"),
            "topic_label": "label",
            "topic_score": ("score", "double"),
            "topic_wiki_link": "wikiLink",
            "topic_wikidata_id": "wikidataId",
        },
        kept,
    )


def analysis_categories(articles: DataFrame, parsed: DataFrame) -> DataFrame:
    return unnest(
        _of_articles(articles, parsed, ["categories"], _STAMPS),
        F.col("categories"),
        {
            "category_position": ("id", "int"),
            "category_label": "label",
            "category_score": ("score", "double"),
            "category_id": "categoryId",
            "classifier_id": "classifierId",
        },
        _STAMPS,
    )


def analysis_text(articles: DataFrame, parsed: DataFrame) -> DataFrame:
    return _of_articles(articles, parsed, ["full_text"], _STAMPS).select(*_STAMPS, "full_text")


def entity_mentions(articles: DataFrame, parsed: DataFrame, with_time: bool = False) -> DataFrame:
    """One row per entity mention and type of that entity."""
    kept = ["feedly_id", "published_at"] if with_time else ["feedly_id"]
    docs = _of_articles(articles, parsed, ["entities"], kept)
    return unnest(
        unnest(docs, F.col("entities"), "e", kept),
        F.col("e.type"),
        "entity_type",
        [
            *kept,
            F.col("e.entityEnglishId").alias("entity_id"),
            F.col("e.unit").alias("unit"),
            F.col("e.crunchbaseId").alias("crunchbase_id"),
            F.col("e.figi").alias("figi"),
            F.col("e.freebaseId").alias("freebase_id"),
            F.col("e.lei").alias("lei"),
            F.col("e.permid").alias("permid"),
            F.col("e.wikidataId").alias("wikidata_id"),
            F.col("e.wikiLink").alias("wiki_link"),
            F.col("e.matchedText").alias("matched_text"),
            F.col("e.startingPos").try_cast("int").alias("starting_pos"),
            F.col("e.matchingTokens").alias("matching_tokens"),
            json_num(F.col("e.relevanceScore").cast("string")).alias("relevance_score"),
            json_num(F.col("e.confidenceScore").cast("string")).alias("confidence_sore"),
        ],
    )


def rollup_entities(mentions: DataFrame) -> DataFrame:
    """Best scores and number of mentions per entity, type and position."""
    rolled = mentions.groupBy("feedly_id", *_ENTITY_KEYS).agg(
        F.max("relevance_score").alias("relevance_score"),
        F.max("confidence_sore").alias("confidence_sore"),
        F.count("entity_id").alias("mentions"),
        *[F.max(c).alias(c) for c in _time(mentions)],
    )
    external = F.coalesce(
        "crunchbase_id", "figi", "freebase_id", "lei", "permid", "wikidata_id", "wiki_link"
    )
    return rolled.withColumn("entity_external_id", external).select(
        "feedly_id", *_ENTITY_KEYS[:10], "entity_external_id", *_ENTITY_KEYS[10:],
        "relevance_score", "confidence_sore", "mentions", *_time(mentions),
    )


def analysis_entities(articles: DataFrame, parsed: DataFrame, with_time: bool = False) -> DataFrame:
    return rollup_entities(entity_mentions(articles, parsed, with_time))


def pick_companies(entities: DataFrame, types: Sequence[str] = COMPANY_TYPES) -> DataFrame:
    """One company mention per article and external id: the smallest entity id.

    Partitioned by the article, which both steps contain: they work on one
    shuffle, or on none if the mentions of an article lie together already.
    """
    per_entity = (
        together(entities.where(F.col("entity_type").isin(*types)), "feedly_id")
        .groupBy("feedly_id", "entity_id", "entity_external_id", "crunchbase_id")
        .agg(
            F.max("relevance_score").alias("relevance_score"),
            F.max("confidence_sore").alias("confidence_sore"),
            F.max("mentions").alias("mentions"),
            *[F.max(c).alias(c) for c in _time(entities)],
        )
    )
    return dedupe_by_rank(
        per_entity,
        ["feedly_id", "entity_external_id"],
        [
            F.col("entity_id").asc_nulls_last(),
            F.col("relevance_score").desc_nulls_last(),
            F.col("crunchbase_id").asc_nulls_last(),
        ],
    )


def list_column(df: DataFrame, name: str) -> Column:
    """A list column that is stored either as comma text or as an array."""
    stored = dict(df.dtypes)[name]
    return F.col(name) if stored.startswith("array") else split_list(F.col(name))


def resolve_companies(
    entities: DataFrame, organizations: DataFrame, types: Sequence[str] = COMPANY_TYPES
) -> DataFrame:
    """Company mentions with their register row, if any.

    ``categories`` and ``category_groups`` hold the sector lists of the
    organisation, so sector queries need no second join.  The mentions stay
    with their article: only the distinct pairs of article and register id are
    shuffled to the register and come back with its row.  A few companies take
    most mentions, so that join is spread; mentions without a register id, and
    scores and external ids of the others, do not travel.  The picked mentions
    are distinct and ``uuid`` is a key of the register: the rows cannot repeat,
    and no ``distinct`` is needed.  Mentions belong to an article (they come
    from a join by its id, which therefore is not NULL).
    """
    register = organizations.select(*_ORG_COLUMNS, "category_list", "category_groups_list")
    asked = (
        entities.where(F.col("entity_type").isin(*types) & F.col("crunchbase_id").isNotNull())
        .select(F.col("feedly_id").alias("_article"), F.col("crunchbase_id").alias("permalink"))
        .distinct()
    )
    found = spread_join(asked, register, ["permalink"]).repartition("_article")
    # Joined by the article alone, by which both sides lie already; as a second
    # key the register id would have both dealt out anew.
    own = F.array_contains(F.array("permalink"), F.col("crunchbase_id"))
    joined = pick_companies(entities, types).join(found, (F.col("feedly_id") == F.col("_article")) & own, "left")
    return joined.select(
        *COMPANY_COLUMNS,
        list_column(joined, "category_list").alias("categories"),
        list_column(joined, "category_groups_list").alias("category_groups"),
        *_time(joined),
    )


def label_matches(
    label: Column,
    include: Sequence[str] = TOPIC_INCLUDE,
    exclude: Sequence[str] = TOPIC_EXCLUDE,
) -> Column:
    return any_ilike(label, include) & ~any_ilike(label, exclude)


def matching_labels(
    topics: DataFrame,
    include: Sequence[str] = TOPIC_INCLUDE,
    exclude: Sequence[str] = TOPIC_EXCLUDE,
    label: str = "topic_label",
) -> DataFrame:
    """Distinct topic labels that match the patterns."""
    return distinct_values(topics.where(label_matches(F.col(label), include, exclude)), label)


def canonical_labels(
    labels: DataFrame,
    mapping: Mapping[str, str] = CANONICAL_LABELS,
    drop: Sequence[str] = STOP_LABELS,
    label: str = "topic_label",
) -> DataFrame:
    """Labels without the stop labels, variants renamed; a label may then repeat."""
    kept = labels.where(~F.col(label).isin(*drop)) if drop else labels
    return kept.select(map_labels(F.col(label), mapping).alias(label))


def topics_with_labels(
    topics: DataFrame, labels: DataFrame, distinct_topics: bool = False
) -> DataFrame:
    """Topic rows whose raw label is in ``labels``, once per copy of the label.

    ``distinct_topics`` counts a repeated label once.  For any list of labels;
    :func:`subject_topics` selects by pattern without a join of this size.
    """
    how = "left_semi" if distinct_topics else "inner"
    return spread_join(topics, labels, ["topic_label"], how)


def subject_topics(
    topics: DataFrame,
    include: Sequence[str] = TOPIC_INCLUDE,
    exclude: Sequence[str] = TOPIC_EXCLUDE,
    mapping: Mapping[str, str] = CANONICAL_LABELS,
    drop: Sequence[str] = STOP_LABELS,
    distinct_topics: bool = False,
) -> DataFrame:
    """Topic rows joined with their own canonical labels.

    Equal to ``topics_with_labels(topics, canonical_labels(matching_labels(topics)))``.
    A label that passes the patterns is in that list by itself, so a filter
    finds it.  What the list adds is one copy of a label per variant of it that
    occurs, and variants are at most the keys of ``mapping``: a lookup with that
    many rows is broadcast, and the topic rows are not shuffled.
    """
    label = F.col("topic_label")
    listed = label_matches(label, include, exclude) & ~label.isin(*drop)
    plain = F.coalesce(listed & ~label.isin(*mapping), F.lit(False))
    variants = (
        topics.where(listed & label.isin(*mapping))
        .select("topic_label")
        .distinct()
        .groupBy(map_labels(label, mapping).alias("topic_label"))
        .agg(F.count("*").alias("_variants"))
    )
    copies = plain.cast("int") + F.coalesce("_variants", F.lit(0))
    rows = (
        topics.where(plain | label.isin(*set(mapping.values())))
        .join(F.broadcast(variants), "topic_label", "left")
        .withColumn("_copies", copies)
        .where("_copies > 0")
        .select(*topics.columns, "_copies")
    )
    if distinct_topics:
        return rows.drop("_copies")
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).drop(
        "_copy", "_copies"
    )


def uncovered_types(entities: DataFrame, rules: DataFrame) -> DataFrame:
    """Entity types that no rule names."""
    # Distinct first: the difference then compares a few thousand type names.
    return entities.select("entity_type").distinct().subtract(rules.select("entity_type").distinct())


def themed_mentions(
    entities: DataFrame,
    articles: DataFrame,
    on_topic: DataFrame,
    types: Sequence[str],
    since: datetime,
    min_confidence: float = 1.0,
    min_relevance: float = 0.2,
    min_topic_score: float = 0.2,
) -> DataFrame:
    """Mentions of some entity types in recent articles on the given topics.

    ``on_topic`` holds the topic rows of :func:`subject_topics`.  Confidence
    must exceed its threshold, the other scores may equal theirs.  An article
    gives an entity once per matching topic.
    """
    picked = entities.where(
        any_like(F.col("entity_type"), types)
        & (F.col("confidence_sore") > min_confidence)
        & (F.col("relevance_score") >= min_relevance)
    ).select("feedly_id", "entity_type", "confidence_sore", "relevance_score", "entity_id")
    scored = on_topic.where(F.col("topic_score") >= min_topic_score).select("feedly_id")
    recent = articles.where(F.col("created_at") > moment(since))
    return (
        picked.join(recent.select("feedly_id", "published_on", "title", "url"), "feedly_id")
        .join(scored, "feedly_id")
        .select(
            "entity_type", "confidence_sore", "relevance_score", "entity_id",
            "published_on", "title", "url",
        )
    )
