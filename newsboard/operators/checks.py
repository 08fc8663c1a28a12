"""Data checks: each returns the rows (or counts) that break a rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

# The rules of the data model, by table or view.
UNIQUE_KEYS = {
    "feedly_entries": [["feedly_id"]],
    "feedly_entry_text_analyses": [["feedly_id"]],
    "channels": [["name"], ["name", "target", "target_id"]],
    "concepts": [["name"]],
    "concept_entity_rules": [["concept_id", "entity_type"]],
    "organizations": [["uuid"]],
    "category_groups": [["id"]],
    "articles": [["feedly_id"]],
    "xr_company_articles_with_sectors": [
        ["feedly_id", "topic_label", "uuid", "category_group", "category"]
    ],
    "vw_xr_channel_articles": [["identifier"]],
    "vw_xr_channel_article_details": [["channel_id", "target", "target_id", "feedly_id"]],
}
REQUIRED = {
    "feedly_entries": ["created_at", "updated_at", "published_at", "feedly_id"],
    "channels": ["name", "target", "target_id", "emoji_icon"],
    "concepts": ["name", "emoji_icon"],
    "channel_concepts": ["channel_id", "concept_id"],
    "concept_entity_rules": [
        "entity_type", "entity_confidence_score_threshold",
        "entity_relevance_score_threshold", "topic_score_threshold", "emoji_icon",
    ],
}
REFERENCES = {
    "channel_concepts": [("channel_id", "channels", "id"), ("concept_id", "concepts", "id")],
    "concept_entity_rules": [("concept_id", "concepts", "id")],
}


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows.

    As in a unique index, a key with a NULL part equals no other.
    """
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column with NULLs, and how many."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], list(cols), "column_name", "n_nulls").where("n_nulls > 0")


def check_fk(df: DataFrame, ref: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Foreign key values that ``ref`` lacks, with their number of rows.

    ``on`` maps a column to the column it refers to.  Values are counted
    before the join, so a value that fills the table is one row in it.
    """
    used = df.dropna(subset=list(on)).groupBy(*on).agg(F.count("*").alias("n_rows"))
    known = ref.select(*[F.col(r).alias(c) for c, r in on.items()])
    return used.join(known, list(on), "left_anti")


def check_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The rules of the data model that ``tables`` break, with how often.

    Takes any of the tables and views that have rules; a foreign key is checked
    when both of its tables are given.
    """
    found = []

    def add(table: str, rule: str, broken: DataFrame, count) -> None:
        found.append(
            broken.agg(count.cast("bigint").alias("n_violations")).select(
                F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "n_violations"
            )
        )

    for table, df in tables.items():
        for keys in UNIQUE_KEYS.get(table, []):
            add(table, f"unique ({', '.join(keys)})", check_unique(df, keys), F.count("*"))
        for col in REQUIRED.get(table, []):
            add(table, f"{col} not null", df, F.count_if(F.col(col).isNull()))
        for col, other, key in REFERENCES.get(table, []):
            if other in tables:
                broken = check_fk(df, tables[other], {col: key})
                add(table, f"{col} in {other}", broken, F.coalesce(F.sum("n_rows"), F.lit(0)))
    return reduce(DataFrame.unionByName, found).where("n_violations > 0")
