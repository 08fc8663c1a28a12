"""24-hour digests and their messages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from newsboard.functions import captions as C
from newsboard.functions.text import first_non_null
from newsboard.functions.time import BOARD_ZONE, shift_zone, within
from newsboard.operators.articles import sentence_texts
from newsboard.operators.ranking import top_k
from newsboard.operators.sectors import article_sectors

TOP_MIN_SCORE = 0.3
TOP_MIN_ENGAGEMENT = 10
TOP_MIN_RATE = 0.1

_COLUMNS = [
    "feedly_id", "published_at", "published_at_with_tz", "topic_labels", "categories",
    "category_group", "company_names", "title", "engagement_rate", "engagement", "url",
    "author", "site", "image_url", "summary_sentences",
]


def _digest(
    recent: DataFrame,
    topics: DataFrame,
    companies: DataFrame,
    order: list[Column],
    k: int | None,
    zone: str,
    min_score: float | None,
    **patterns,
) -> DataFrame:
    # Only the ids of the window decide which analysis rows are grouped.
    ids = recent.select("feedly_id")
    sets = article_sectors(
        topics.join(ids, "feedly_id", "left_semi"),
        companies.join(ids, "feedly_id", "left_semi"),
        min_score=min_score,
        **patterns,
    )
    rows = recent.join(sets, "feedly_id")
    if k is not None:
        rows = top_k(rows, order, k)
    return rows.withColumns(
        {
            "published_at_with_tz": shift_zone(F.col("published_at"), zone),
            "summary_sentences": sentence_texts(F.col("sentences")),
        }
    )


def latest_digest(
    articles: DataFrame,
    topics: DataFrame,
    companies: DataFrame,
    as_of: datetime,
    k: int | None = 10,
    zone: str = BOARD_ZONE,
    **patterns,
) -> DataFrame:
    """Articles of the last 24 hours that have a topic and a company, newest first."""
    recent = articles.where(within(F.col("created_at"), as_of))
    order = [F.col("created_at").desc_nulls_first(), F.col("feedly_id").asc()]
    return _digest(recent, topics, companies, order, k, zone, None, **patterns).select(*_COLUMNS)


def top_digest(
    articles: DataFrame,
    topics: DataFrame,
    companies: DataFrame,
    as_of: datetime,
    k: int | None = 10,
    zone: str = BOARD_ZONE,
    min_score: float = TOP_MIN_SCORE,
    min_engagement: float = TOP_MIN_ENGAGEMENT,
    min_rate: float = TOP_MIN_RATE,
    **patterns,
) -> DataFrame:
    """Engaging articles of the last 24 hours with a strong topic or company."""
    recent = articles.where(
        within(F.col("created_at"), as_of)
        & ((F.col("engagement") >= min_engagement) | (F.col("engagement_rate") >= min_rate))
    )
    order = [F.col("engagement_rate").desc_nulls_first(), F.col("feedly_id").asc()]
    return _digest(recent, topics, companies, order, k, zone, min_score, **patterns).select(*_COLUMNS)


def digest_messages(digest: DataFrame) -> DataFrame:
    """The text parts of every digest line."""
    return digest.select(
        "feedly_id",
        C.headline(F.col("url"), F.col("title")).alias("headline"),
        "image_url",
        C.bullets(F.col("summary_sentences")).alias("bullets"),
        C.captions(
            F.col("company_names"), F.col("topic_labels"), F.col("categories")
        ).alias("captions"),
        C.author_line(F.col("author"), F.col("site"), F.col("published_at_with_tz")).alias("author_line"),
    )


def digest_headline(digest: DataFrame, title: str) -> DataFrame:
    """One row: the title and all companies of the digest, sorted.

    ``digest`` is a top-k report, so the names of one row are few.
    """
    names = digest.select(F.explode("company_names").alias("name"))
    joined = F.array_join(F.array_sort(F.collect_set("name")), ", ")
    return names.agg(
        F.concat(F.lit(f"{title} mention "), first_non_null(joined, F.lit(""))).alias("headline")
    )
