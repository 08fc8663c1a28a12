"""Entries to articles, and the views that read the feed document."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsboard.functions.arrays import null_if_empty
from newsboard.functions.json import json_num
from newsboard.functions.text import first_non_null, host_of, soundex_pg
from newsboard.functions.time import (
    BOARD_ZONE, bucket, epoch_ms, in_local_range, in_period, period_start, shift_zone,
)
from newsboard.operators.ranking import dedupe_by_rank
from newsboard.operators.unnest import distinct_values, unnest

# The item arrays travel with an entry row, so that the views below need no
# join back to the entries; column pruning drops those a query does not read.
ITEM_COLUMNS = ["common_topics", "entities", "keywords", "sentences", "priorities"]

DETAIL_COLUMNS = [
    "created_at", "updated_at", "feedly_id", "visual_image_url", "enclosure_image_url",
    "title", "author", "url", "fingerprint", "origin_url", "amp_url", "canonical_url",
    "alternate_url", "site", "content", "summary", "leo_summary", "published_at",
    "published", "crawled_at", "crawled", "engagement", "engagement_rate", "image_url",
    "published_on", "soundex_title",
]

_STAMPS = ["created_at", "updated_at", "published_at", "feedly_id"]


def entry_details(parsed: DataFrame, alternates: str = "first") -> DataFrame:
    """Url, site, image, crawl time, engagement and title code of parsed entries.

    ``alternates="first"`` reads the first alternate link of an entry;
    ``"all"`` gives one row per alternate link.
    """
    if alternates == "first":
        rows = parsed.withColumn("alternate_url", F.get("alternates", F.lit(0))["href"])
    elif alternates == "all":
        rows = parsed.withColumn("_alt", F.explode_outer("alternates")).withColumn(
            "alternate_url", F.col("_alt.href")
        )
    else:
        raise ValueError(f"alternates must be 'first' or 'all', not {alternates!r}")
    enclosure = F.get("enclosures", F.lit(1))["href"]
    visual = F.col("visual_image_url")
    computed = {
        "enclosure_image_url": enclosure,
        "url": first_non_null(
            F.col("amp_url"), F.col("canonical_url"), F.col("alternate_url"), F.col("origin_url")
        ),
        # Only the alternate link names the site.
        "site": host_of(F.col("alternate_url")),
        "crawled_at": epoch_ms(F.col("crawled")),
        "engagement": F.coalesce("engagement", F.lit(0.0)),
        "engagement_rate": F.coalesce("engagement_rate", F.lit(0.0)),
        # A missing visual stays missing; only the literal 'none' falls back.
        "image_url": F.when(visual == "none", enclosure).otherwise(visual),
        "published_on": bucket(F.col("published_at"), "day"),
        "soundex_title": soundex_pg(F.col("title")),
    }
    return rows.withColumns(computed).select(*DETAIL_COLUMNS, *ITEM_COLUMNS)


# Best copy of an article first, with the NULL order of the source database.
def article_order() -> list[Column]:
    return [
        F.col("author").asc_nulls_last(),
        F.col("engagement").desc_nulls_first(),
        F.col("engagement_rate").desc_nulls_first(),
        F.col("crawled_at").desc_nulls_first(),
        F.col("published_at").desc_nulls_first(),
        F.col("fingerprint").asc_nulls_last(),
        # Copies that tie on everything above: the smallest id stays.
        F.col("feedly_id").asc_nulls_last(),
    ]


def articles(details: DataFrame, keys: tuple[str, ...] = ("site", "soundex_title")) -> DataFrame:
    """One article per near-duplicate key."""
    kept = dedupe_by_rank(details, keys, article_order())
    return kept.withColumn("duplicate_index", F.lit(1))


def _titled(*more: str) -> list[str]:
    return [*_STAMPS, "title", *more]


def common_topics(articles: DataFrame) -> DataFrame:
    return unnest(
        articles,
        F.col("common_topics"),
        {
            "topic_id": "id",
            "topic_label": "label",
            "topic_score": ("score", "double"),
            "topic_salince_level": "salienceLevel",
        },
        _titled(),
    )


def topic_list(topics: DataFrame) -> DataFrame:
    return distinct_values(topics, "topic_id", "topic_label")


def feed_entities(articles: DataFrame) -> DataFrame:
    return unnest(
        articles,
        F.col("entities"),
        {"entity_id": "id", "entity_label": "label", "entity_salince_level": "salienceLevel"},
        _titled(),
    )


def entity_list(entities: DataFrame) -> DataFrame:
    return distinct_values(entities, "entity_id", "entity_label")


def keywords(articles: DataFrame) -> DataFrame:
    return unnest(articles, F.col("keywords"), "keyword", _titled())


def keyword_list(words: DataFrame) -> DataFrame:
    return distinct_values(words, "keyword")


def summary_sentences(articles: DataFrame) -> DataFrame:
    return unnest(
        articles,
        F.col("sentences"),
        {
            "summary_sentence": "text",
            "summary_sentence_position": ("position", "int"),
            "summary_sentence_score": ("score", "double"),
        },
        _titled(),
    )


def sentence_texts(sentences: Column) -> Column:
    """Sentence texts by position, straight from the article row.

    An article without sentences gives a list of one NULL, which is what
    collecting over an outer join to the sentence rows would give.
    """
    keyed = F.transform(
        sentences,
        lambda s, i: F.struct(
            F.coalesce(json_num(s["position"], "int"), F.lit(2**31 - 1)).alias("p"),
            i.alias("i"),
            s["text"].alias("text"),
        ),
    )
    texts = F.transform(F.array_sort(keyed), lambda s: s["text"])
    return F.coalesce(null_if_empty(texts), F.array(F.lit(None).cast("string")))


def priorities(articles: DataFrame) -> DataFrame:
    """Priorities and their search terms, two arrays deep."""
    items = unnest(
        articles,
        F.col("priorities"),
        {"priority_id": "id", "priority_label": "label", "_terms": "searchTerms"},
        _STAMPS,
    )
    return unnest(
        items,
        F.col("_terms.parts"),
        {"search_term_id": "id", "search_term_label": "label"},
        [*_STAMPS, "priority_id", "priority_label"],
    )


def cooccurrence(left: DataFrame, right: DataFrame, on: str = "feedly_id") -> DataFrame:
    """Left join of two item views of the same articles."""
    extra = [c for c in right.columns if c not in left.columns]
    return left.join(right.select(on, *extra), on, "left")


def _with_entity(articles: DataFrame, other: str) -> DataFrame:
    # Both arrays sit in the article row: no join is needed to pair them.
    return articles.select(
        *_titled(other), F.explode(null_if_empty(F.col("entities"))).alias("_e")
    ).select(
        *_titled(),
        F.col("_e.id").alias("entity_id"),
        F.col("_e.label").alias("entity_label"),
        F.explode_outer(other).alias("_o"),
    )


def entities_by_topics(articles: DataFrame) -> DataFrame:
    """Entities of an article with its topics; entities without topics stay."""
    pairs = _with_entity(articles, "common_topics")
    return pairs.select(
        *pairs.columns[:-1], F.col("_o.id").alias("topic_id"), F.col("_o.label").alias("topic_label")
    )


def entities_by_keywords(articles: DataFrame) -> DataFrame:
    """Entities of an article with its keywords; entities without keywords stay."""
    return _with_entity(articles, "keywords").withColumnRenamed("_o", "keyword")


def article_rankings(
    articles: DataFrame, week: datetime, k: int = 20, zone: str = BOARD_ZONE
) -> DataFrame:
    """Articles of one local week whose rate is among the ``k`` best rates.

    Gives the dense rank by engagement rate in the day, the week and the month.
    A month may hold any number of articles, so no window runs over them: the
    week rank needs only the ``k`` best distinct rates; better rates of a day
    are better rates of its week, so day ranks follow from those; and a month
    rank is one more than the number of better distinct rates, counted for the
    few thresholds in question.
    """
    rate = "engagement_rate"
    local = shift_zone(F.col("published_at"), zone)
    shifted = articles.where(F.col("engagement").isNotNull()).withColumns(
        {
            "published_at_with_tz": local,
            **{f"published_{g}": bucket(local, g) for g in ("day", "week", "month", "quarter", "year")},
        }
    )
    in_week = shifted.where(in_period(F.col("published_at"), "week", week, zone))

    # k rows at most from here on: the windows below see k, 7k and 2k rows.
    best = in_week.select(rate).distinct().orderBy(F.col(rate).desc_nulls_first()).limit(k)
    by_rate = F.col(rate).desc_nulls_first()
    week_ranks = best.select(
        F.col(rate).alias("_w_rate"),
        F.dense_rank().over(Window.orderBy(by_rate)).alias("popularity_by_week"),
    )
    top = in_week.join(
        F.broadcast(week_ranks), F.col(rate).eqNullSafe(F.col("_w_rate"))
    ).drop("_w_rate")

    levels = top.select("published_day", "published_month", rate).distinct()
    day_ranks = levels.select(
        F.col("published_day").alias("_d"),
        F.col(rate).alias("_d_rate"),
        F.dense_rank().over(Window.partitionBy("published_day").orderBy(by_rate)).alias("popularity_by_day"),
    )

    wanted = levels.select(
        F.col("published_month").alias("_m"), F.col(rate).alias("_m_rate")
    ).distinct()
    first = period_start("month", week)
    after = period_start("month", week + timedelta(days=6), -1)
    months = (
        shifted.where(in_local_range(F.col("published_at"), first, after, zone))
        .select("published_month", rate)
        .distinct()
    )
    better = F.col(rate).isNull() & F.col("_m_rate").isNotNull() | (F.col(rate) > F.col("_m_rate"))
    month_ranks = (
        F.broadcast(wanted)
        .join(months, (F.col("published_month") == F.col("_m")) & better, "inner")
        .groupBy("_m", "_m_rate")
        .agg(F.count("*").alias("_better"))
    )
    return (
        top.join(
            F.broadcast(day_ranks),
            (F.col("published_day") == F.col("_d")) & F.col(rate).eqNullSafe(F.col("_d_rate")),
        )
        .join(
            F.broadcast(month_ranks),
            (F.col("published_month") == F.col("_m")) & F.col(rate).eqNullSafe(F.col("_m_rate")),
            "left",
        )
        .withColumn("popularity_by_month", F.coalesce("_better", F.lit(0)) + 1)
        .drop("_d", "_d_rate", "_m", "_m_rate", "_better")
    )
