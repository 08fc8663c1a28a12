"""Articles with their topics, companies and company sectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from newsboard.functions.arrays import set_keep_nulls, set_of, union_of
from newsboard.functions.time import bucket
from newsboard.operators.analysis import TOPIC_EXCLUDE, TOPIC_INCLUDE, label_matches


def company_name() -> Column:
    return F.coalesce("name", "entity_id")


def company_articles(
    articles: DataFrame,
    topics: DataFrame,
    companies: DataFrame,
    include: Sequence[str] = TOPIC_INCLUDE,
    exclude: Sequence[str] = TOPIC_EXCLUDE,
) -> DataFrame:
    """The sector table: article x matching topic x company x category x group.

    The label list is made of these very topics, so testing a label by its
    patterns selects the same rows as joining the list.  Sector lists ride on
    the company row.  Rows multiply by design (do not sum over this table); for
    sets per article use :func:`article_sectors`, which never multiplies.
    """
    matched = topics.where(label_matches(F.col("topic_label"), include, exclude))
    by_article = (
        articles.select("feedly_id", "title", "image_url", "published_at")
        .join(matched.select("feedly_id", "topic_label", "topic_score"), "feedly_id")
        .join(companies.drop("published_at"), "feedly_id")
    )
    with_category = by_article.withColumn("category", F.explode_outer("categories"))
    return with_category.withColumn("category_group", F.explode_outer("category_groups")).select(
        "feedly_id", "topic_label", "topic_score", "uuid", company_name().alias("name"),
        "relevance_score", "confidence_sore", "country_code", "city", "region",
        "category", "category_group", "title", "image_url", "published_at",
        bucket(F.col("published_at"), "day").alias("published_on"),
        bucket(F.col("published_at"), "week").alias("published_week"),
        bucket(F.col("published_at"), "month").alias("published_month"),
    )


def article_sectors(
    topics: DataFrame,
    companies: DataFrame,
    include: Sequence[str] = TOPIC_INCLUDE,
    exclude: Sequence[str] = TOPIC_EXCLUDE,
    min_score: float | None = None,
) -> DataFrame:
    """Sets of topics, categories, groups and company names per article.

    Equal to collecting sets over :func:`company_articles`, but topics and
    companies are reduced to one row per article each before they meet.  With
    ``min_score`` only pairs count in which the topic score or the relevance
    reaches it: a topic stays if it is strong itself or the best company is,
    and the other way round, which the two maxima decide.
    """
    matched = topics.where(label_matches(F.col("topic_label"), include, exclude))
    if min_score is None:
        by_topic = _topic_sets(matched)
        return by_topic.join(_company_sets(companies), "feedly_id")

    strong_topic = F.col("topic_score") >= min_score
    strong_company = F.col("relevance_score") >= min_score
    flags = (
        matched.groupBy("feedly_id").agg(F.bool_or(strong_topic).alias("_topic"))
        .join(
            companies.groupBy("feedly_id").agg(F.bool_or(strong_company).alias("_company")),
            "feedly_id",
        )
        .where("_topic OR _company")
    )
    # Scores that are missing are not strong; a flag over none of them is NULL.
    kept_topics = matched.join(flags, "feedly_id").where(F.col("_company") | strong_topic)
    kept_companies = companies.join(flags, "feedly_id").where(F.col("_topic") | strong_company)
    return _topic_sets(kept_topics).join(_company_sets(kept_companies), "feedly_id")


def _topic_sets(topics: DataFrame) -> DataFrame:
    return topics.groupBy("feedly_id").agg(set_of(F.col("topic_label")).alias("topic_labels"))


def _company_sets(companies: DataFrame) -> DataFrame:
    return companies.groupBy("feedly_id").agg(
        union_of(F.col("categories")).alias("categories"),
        union_of(F.col("category_groups")).alias("category_group"),
        set_keep_nulls(company_name()).alias("company_names"),
    )


def company_mentions(articles: DataFrame, companies: DataFrame) -> DataFrame:
    """Company rows with the publishing time, for the boards by company."""
    return _published(articles, companies).where(F.col("name").isNotNull())


def category_mentions(articles: DataFrame, companies: DataFrame) -> DataFrame:
    """One row per company mention and category, for the boards by category."""
    return _published(articles, companies).withColumn("category", F.explode("categories"))


def group_mentions(articles: DataFrame, companies: DataFrame) -> DataFrame:
    """One row per company mention and category group."""
    return _published(articles, companies).withColumn(
        "category_group", F.explode("category_groups")
    )


def topic_mentions(articles: DataFrame, topics: DataFrame) -> DataFrame:
    """Topic rows with the publishing time; filter labels first."""
    return _published(articles, topics)


def _published(articles: DataFrame, rows: DataFrame) -> DataFrame:
    if "published_at" in rows.columns:
        return rows
    return rows.join(articles.select("feedly_id", "published_at"), "feedly_id")
