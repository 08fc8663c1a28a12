"""Feed documents and analysis documents to typed rows.

The document is parsed once here, and fields that may be string-encoded a
second time; every later operator works on the typed columns and lets column
pruning drop the rest.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from newsboard.functions.json import json_num, json_text, json_unwrap
from newsboard.functions.time import epoch_s, moment
from newsboard.sources import schemas as S


def explode_items(df: DataFrame, col: str = "value") -> DataFrame:
    """``{"items": [...]}`` envelopes to one raw JSON row per item.

    A document that does not parse, or has no items, gives no rows.
    """
    items = json_unwrap(F.col(col), "struct<items:array<string>>")["items"]
    return df.select(F.explode(items).alias("payload"))


def entries_from_json(df: DataFrame, col: str, now: datetime) -> DataFrame:
    """Raw item JSON to entry rows; publishing time is cut to whole seconds."""
    doc = F.col(col)
    stamp = moment(now)
    millis = json_num(json_text(doc, "published"))  # 1.7e12 is a number of JSON as well
    return df.select(
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
        epoch_s(F.floor(millis / 1000)).alias("published_at"),
        json_text(doc, "id").alias("feedly_id"),
        doc.alias("payload"),
    )



def parse_entries(entries: DataFrame) -> DataFrame:
    """Entry rows with the payload unpacked into typed columns."""
    doc = entries.withColumn("doc", json_unwrap(F.col("payload"), f"struct<{S.ENTRY_PAYLOAD}>"))
    p = F.col("doc")
    leo = p["leoSummary"]
    return doc.select(
        "created_at",
        "updated_at",
        "published_at",
        "feedly_id",
        p["title"].alias("title"),
        p["author"].alias("author"),
        p["fingerprint"].alias("fingerprint"),
        p["originId"].alias("origin_url"),
        p["ampUrl"].alias("amp_url"),
        p["canonicalUrl"].alias("canonical_url"),
        p["alternate"].alias("alternates"),
        json_unwrap(p["enclosure"], S.HREFS).alias("enclosures"),
        json_unwrap(p["visual"], S.VISUAL)["url"].alias("visual_image_url"),
        json_unwrap(p["content"], S.TEXT_BLOCK)["content"].alias("content"),
        json_unwrap(p["summary"], S.TEXT_BLOCK)["content"].alias("summary"),
        json_unwrap(leo, S.SUMMARY_TEXT)["sentences"].alias("leo_summary"),
        json_num(p["published"], "double").alias("published"),
        json_num(p["crawled"], "double").alias("crawled"),
        json_num(p["engagement"], "double").alias("engagement"),
        json_num(p["engagementRate"], "double").alias("engagement_rate"),
        json_unwrap(p["commonTopics"], S.COMMON_TOPICS).alias("common_topics"),
        json_unwrap(p["entities"], S.FEED_ENTITIES).alias("entities"),
        p["keywords"].alias("keywords"),
        json_unwrap(leo, f"struct<sentences:{S.SENTENCES}>")["sentences"].alias("sentences"),
        F.transform(p["priorities"], lambda x: json_unwrap(x, S.PRIORITY)).alias("priorities"),
    )


def parse_analyses(analyses: DataFrame) -> DataFrame:
    """Analysis rows with topics, entities, categories and text as columns."""
    doc = analyses.withColumn("doc", json_unwrap(F.col("payload"), f"struct<{S.ANALYSIS_PAYLOAD}>"))
    p = F.col("doc")
    return doc.select(
        "feedly_id",
        p["cleanedText"].alias("full_text"),
        p["topics"].alias("topics"),
        p["entities"].alias("entities"),
        p["categories"].alias("categories"),
    )
