"""The registered queries: public functions of the engine on the given tables.

Columns are rendered so that another engine can be compared value by value:
periods as text, scores rounded to nine places, sets as joined text.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

import bindings as B
from newsboard.functions import captions as C
from newsboard.functions.arrays import list_keep_nulls, set_keep_nulls, set_of
from newsboard.functions.json import json_num, json_text
from newsboard.functions.text import host_of, soundex_pg
from newsboard.functions.time import BOARD_ZONE, moment
from newsboard.operators import analysis as N
from newsboard.operators import articles as A
from newsboard.operators import checks as K
from newsboard.operators import digests as D
from newsboard.operators import maintenance as M
from newsboard.operators import register as R
from newsboard.operators import routing as T
from newsboard.operators import sectors as S
from newsboard.operators.boards import board_of_days, leaderboard, ordered_board, top_mentions
from newsboard.operators.counting import period_counts, roll_up
from newsboard.operators.ranking import dedupe_by_rank
from newsboard.plans.incremental import IncrementalViews
from newsboard.plans.keyed import KeyedTable
from newsboard.plans.storage import current, ensure_checkpoint_dir, input_bytes, materialize, shared_dir
from newsboard.plans.views import GRAINS, build_views, load_stored, refresh
from newsboard.sources import schemas
from newsboard.sources.feed import entries_from_json, explode_items, parse_entries
from newsboard.sources.register import read_register
from newsboard.sources.seeds import conform, read_seeds, stamped
from newsboard.streaming.counts import count_increments, daily_counts, day_table, fold_counts, windowed_counts
from newsboard.streaming.ingest import compact, current_entries, ingest_entries
from newsboard.streaming.routing import arrivals, channel_state, deliver, deliver_analyses

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(1998, 6, 15)
VIEWS_AS_OF = datetime(1995, 7, 10)
EVENTS_AS_OF = datetime(2024, 1, 15, 17)
MIN_VALUE = 50.0


def day(col: str) -> Column:
    return F.date_format(col, "yyyy-MM-dd").alias(col)


def second(col: str) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(col)


def rounded(col: str) -> Column:
    return F.round(col, 9).alias(col)


def joined(col: str, sep: str = "|") -> Column:
    return F.array_join(col, sep).alias(col)


def show_period(df: DataFrame) -> DataFrame:
    df = df.withColumn("time_period", day("time_period"))
    return df.withColumn("pct", rounded("pct")) if "pct" in df.columns else df


# --- boards and counts -----------------------------------------------------

LINE_BOARDS = {
    "company": ("name", None),
    "category": ("category", None),
    "group": ("category_group", None),
    "company_in_category": ("name", "category"),
}


def line_board(by: str, within: str | None, grain: str) -> Query:
    sectors = by != "name" or within is not None
    return lambda spark, sf: show_period(
        leaderboard(B.line_mentions(spark, sf, sectors), by, grain, within=within)
    )


def topic_board(grain: str) -> Query:
    return lambda spark, sf: show_period(
        leaderboard(B.event_mentions(spark, sf), "topic_label", grain, score="topic_score", min_score=MIN_VALUE)
    )


def line_top(by: str, period: str) -> Query:
    return lambda spark, sf: show_period(
        top_mentions(B.line_mentions(spark, sf, sectors=False), by, period, AS_OF)
    )


def topic_top(period: str) -> Query:
    return lambda spark, sf: show_period(
        top_mentions(
            B.event_mentions(spark, sf), "topic_label", period, EVENTS_AS_OF,
            score="topic_score", min_score=MIN_VALUE,
        )
    )


def counted(rows: Query, label: str, grain: str) -> Query:
    return lambda spark, sf: show_period(period_counts(rows(spark, sf), label, grain))


# --- feed documents --------------------------------------------------------


def doc_articles(spark: SparkSession, sf: str) -> DataFrame:
    return A.articles(A.entry_details(parse_entries(B.stored(spark, sf, B.document_entries))))


def part_articles(spark: SparkSession, sf: str) -> DataFrame:
    return A.entry_details(parse_entries(B.stored(spark, sf, B.part_entries)))


def doc_keywords(spark: SparkSession, sf: str) -> DataFrame:
    return A.keywords(doc_articles(spark, sf))


def doc_entities(spark: SparkSession, sf: str) -> DataFrame:
    return A.feed_entities(doc_articles(spark, sf))


def page_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "feedly_id", "url", "site", "title", "author", "image_url", "engagement",
        rounded("engagement_rate"), F.length("content").cast("bigint").alias("content_chars"),
        day("published_on"), second("crawled_at"), "soundex_title",
    )


def entry_details(spark: SparkSession, sf: str) -> DataFrame:
    return page_columns(A.entry_details(parse_entries(B.stored(spark, sf, B.page_entries))))


def page_articles(spark: SparkSession, sf: str) -> DataFrame:
    return page_columns(A.articles(A.entry_details(parse_entries(B.stored(spark, sf, B.page_entries)))))


def sites(spark: SparkSession, sf: str) -> DataFrame:
    return B.table(spark, sf, "pages").select("page_id", host_of(F.col("url")).alias("site"))


def document_soundex(spark: SparkSession, sf: str) -> DataFrame:
    return B.table(spark, sf, "documents").select("doc_id", soundex_pg(F.col("text")).alias("code"))


def articles_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = B.table(spark, sf, "documents").select(
        "doc_id", "source", soundex_pg(F.col("text")).alias("code"), "n_chars"
    )
    return dedupe_by_rank(docs, ["source", "code"], [F.col("n_chars").desc_nulls_first(), F.col("doc_id").asc()])


def json_fields(spark: SparkSession, sf: str) -> DataFrame:
    props = F.col("props")
    return B.table(spark, sf, "events").select(
        "event_id",
        json_text(props, "k").alias("k_text"),
        json_num(json_text(props, "k"), "bigint").alias("k_number"),
        json_text(props, "k", "inner").alias("missing"),
    )


def feed_items(spark: SparkSession, sf: str) -> DataFrame:
    """An envelope per document with its lines as items, unpacked to entries."""
    millis = F.lit(B.FIRST_HOUR_MS) + F.col("doc_id") * B.HOUR_MS
    items = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            F.concat_ws("/", F.col("doc_id").cast("string"), i.cast("string")).alias("id"),
            # Half a second is cut off again.
            (millis + i * 1000 + 500).alias("published"),
            line.alias("title"),
        ),
    )
    envelopes = B.table(spark, sf, "documents").select(B.json_of(items=items).alias("value"))
    entries = entries_from_json(explode_items(envelopes), "payload", AS_OF)
    return entries.select(
        "feedly_id", second("published_at"), json_text(F.col("payload"), "title").alias("title")
    )


def feed_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as feed items whose numbers are out of range, infinite or none by rule."""
    kind = F.col("doc_id") % 6
    millis = F.lit(B.FIRST_HOUR_MS) + F.col("doc_id") * B.HOUR_MS
    odd = lambda good: (
        F.when(kind == 0, good.cast("string")).when(kind == 1, "9000000000000000000").when(kind == 2, "NaN")
        .when(kind == 3, "1e300").when(kind == 4, "-Infinity").otherwise("twelve")
    )
    items = B.table(spark, sf, "documents").select(
        B.json_of(
            id=F.concat(F.lit("doc/"), F.col("doc_id")), published=odd(millis), crawled=odd(millis),
            engagement=odd(F.col("n_chars")),
            commonTopics=F.array(F.struct(F.col("lang").alias("label"), odd(F.col("n_chars")).alias("score"))),
        ).alias("payload")
    )
    entries = entries_from_json(items, "payload", AS_OF)
    rows = A.entry_details(parse_entries(entries))
    topics = A.common_topics(rows).select("feedly_id", "topic_score")
    return rows.join(topics, "feedly_id").select(
        "feedly_id", second("published_at"), second("crawled_at"), "engagement", "topic_score"
    )


def all_alternates(spark: SparkSession, sf: str) -> DataFrame:
    """A row per alternate link of a page's links."""
    pages = B.table(spark, sf, "pages")
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    entries = B._entry(
        pages, F.concat(F.lit("page/"), F.col("page_id")), moment(AS_OF), moment(AS_OF), B.json_of(alternate=B.hrefs(links))
    )
    return A.entry_details(parse_entries(entries), alternates="all").select("feedly_id", "url")


def seed_files(spark: SparkSession, sf: str) -> DataFrame:
    """Seeds written as CSV from the nations and read back, with ids and stamps."""
    path = shared_dir(spark, "seeds")
    nation = B.table(spark, sf, "nation").orderBy("n_nationkey").coalesce(1)
    name = F.col("n_name").alias("name")
    frames = {
        "channels": nation.select(name, F.col("n_comment").alias("description") if "n_comment" in nation.columns else name.alias("description"),
                                  F.lit("slack").alias("target"), F.concat(F.lit("#"), F.col("n_name")).alias("target_id")),
        "concepts": nation.select(name),
        "concept_entity_rules": nation.select(
            (F.col("n_nationkey") + 1).alias("concept_id"), F.col("n_name").alias("entity_type"),
            F.lit("1").alias("entity_confidence_score_threshold"), F.lit("0.2").alias("entity_relevance_score_threshold"),
            F.lit("0.2").alias("topic_score_threshold"),
        ),
    }
    for file, df in frames.items():
        df.write.option("header", True).csv(f"{path}/{file}.csv")
    seeds = stamped(read_seeds(spark, path), AS_OF)
    rules = seeds["concept_entity_rules"].join(
        seeds["concepts"].select(F.col("id").alias("concept_id"), F.col("name").alias("concept_name")), "concept_id"
    )
    channels = seeds["channels"].select(F.col("name").alias("concept_name"), "target_id", second("created_at"))
    return rules.drop("created_at").join(channels, "concept_name").select(
        "id", "concept_name", "entity_type", rounded("entity_relevance_score_threshold").cast("double").alias("relevance"),
        "target_id", "created_at",
    )


def null_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Sets and lists with NULLs, shown by a marker."""
    lines = B.table(spark, sf, "lineitem").select(
        "l_orderkey", F.struct("l_linenumber", "l_partkey", "l_extendedprice").alias("place"), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag")
    )
    shown = lambda c, name: F.array_join(c, "|", "<null>").alias(name)
    return lines.groupBy("l_orderkey").agg(
        shown(set_keep_nulls(F.col("flag")), "with_nulls"),
        shown(F.coalesce(set_of(F.col("flag")), F.array(F.lit(None).cast("string"))), "without"),
        shown(list_keep_nulls(F.col("flag"), F.col("place")), "in_order"),
    )


def common_topics(spark: SparkSession, sf: str) -> DataFrame:
    return A.common_topics(doc_articles(spark, sf)).select(
        "feedly_id", "topic_id", "topic_label", rounded("topic_score"), "topic_salince_level"
    )


def topic_list(spark: SparkSession, sf: str) -> DataFrame:
    return A.topic_list(A.common_topics(doc_articles(spark, sf)))


def feed_entities(spark: SparkSession, sf: str) -> DataFrame:
    return doc_entities(spark, sf).select("feedly_id", "entity_id", "entity_label", "entity_salince_level")


def summary_sentences(spark: SparkSession, sf: str) -> DataFrame:
    return A.summary_sentences(doc_articles(spark, sf)).select(
        "feedly_id", "summary_sentence", "summary_sentence_position", "summary_sentence_score"
    )


def sentence_lists(spark: SparkSession, sf: str) -> DataFrame:
    texts = A.sentence_texts(F.col("sentences"))
    return doc_articles(spark, sf).select("feedly_id", F.array_join(texts, " / ").alias("sentences"))


def priorities(spark: SparkSession, sf: str) -> DataFrame:
    return A.priorities(doc_articles(spark, sf)).select(
        "feedly_id", "priority_id", "priority_label", "search_term_id", "search_term_label"
    )


def entities_by_topics(spark: SparkSession, sf: str) -> DataFrame:
    return A.entities_by_topics(part_articles(spark, sf)).select(
        "feedly_id", "entity_id", "entity_label", "topic_id", "topic_label"
    )


def entities_by_keywords(spark: SparkSession, sf: str) -> DataFrame:
    return A.entities_by_keywords(part_articles(spark, sf)).select(
        "feedly_id", "entity_id", "entity_label", "keyword"
    )


def cooccurrence(spark: SparkSession, sf: str) -> DataFrame:
    articles = part_articles(spark, sf)
    return A.cooccurrence(A.feed_entities(articles), A.keywords(articles)).select(
        "feedly_id", "entity_id", "entity_label", "keyword"
    )


def article_rankings(spark: SparkSession, sf: str) -> DataFrame:
    return A.article_rankings(stored_articles(spark, sf), datetime(1998, 6, 29)).select(
        "feedly_id", day("published_day"), rounded("engagement_rate"),
        F.col("popularity_by_day").cast("bigint").alias("popularity_by_day"),
        F.col("popularity_by_week").cast("bigint").alias("popularity_by_week"),
        "popularity_by_month",
    )


# --- analysis documents ----------------------------------------------------


def topics(spark: SparkSession, sf: str) -> DataFrame:
    return N.analysis_topics(B.order_articles(spark, sf), B.order_parsed(spark, sf))


def entities(spark: SparkSession, sf: str) -> DataFrame:
    return N.analysis_entities(B.order_articles(spark, sf), B.order_parsed(spark, sf))


def known_entities(spark: SparkSession, sf: str) -> DataFrame:
    # Entities that lie there are read; they are not written for their companies or types alone.
    mentions = stored_entities if B.is_stored(spark, sf, entities) else entities
    return mentions(spark, sf)


def resolved(spark: SparkSession, sf: str) -> DataFrame:
    return N.resolve_companies(known_entities(spark, sf), B.organizations(spark, sf))


# The views that many others read are stored, as plans.views.refresh does:
# queries on top of them do not parse and group the documents again.


def stored_articles(spark: SparkSession, sf: str) -> DataFrame:
    return B.stored(spark, sf, B.order_articles, bucketed=True)


def stored_topics(spark: SparkSession, sf: str) -> DataFrame:
    return B.stored(spark, sf, topics, bucketed=True)


def stored_entities(spark: SparkSession, sf: str) -> DataFrame:
    return B.stored(spark, sf, entities, bucketed=True)


def stored_companies(spark: SparkSession, sf: str) -> DataFrame:
    return B.stored(spark, sf, resolved, bucketed=True)


def on_topic(spark: SparkSession, sf: str, distinct: bool = False) -> DataFrame:
    return N.subject_topics(stored_topics(spark, sf), distinct_topics=distinct)


def labels(spark: SparkSession, sf: str) -> DataFrame:
    return N.canonical_labels(N.matching_labels(stored_topics(spark, sf)))


def analysis_topics(spark: SparkSession, sf: str) -> DataFrame:
    return topics(spark, sf).select("feedly_id", "topic_position", "topic_label", rounded("topic_score"))


def analysis_categories(spark: SparkSession, sf: str) -> DataFrame:
    rows = N.analysis_categories(B.order_articles(spark, sf), B.order_parsed(spark, sf))
    return rows.select(
        "feedly_id", "category_position", "category_label", rounded("category_score"), "category_id", "classifier_id"
    )


def analysis_text(spark: SparkSession, sf: str) -> DataFrame:
    return N.analysis_text(B.order_articles(spark, sf), B.order_parsed(spark, sf)).select("feedly_id", "full_text")


def analysis_entities(spark: SparkSession, sf: str) -> DataFrame:
    return entities(spark, sf).select(
        "feedly_id", "entity_type", "entity_id", "crunchbase_id", "wikidata_id", "entity_external_id",
        "matched_text", "starting_pos", joined("matching_tokens", ","),
        rounded("relevance_score"), rounded("confidence_sore"), "mentions",
    )


def companies(spark: SparkSession, sf: str) -> DataFrame:
    return resolved(spark, sf).select(
        "feedly_id", "entity_id", "entity_external_id", "crunchbase_id", rounded("relevance_score"),
        rounded("confidence_sore"), "uuid", "name", "permalink", "city", "region",
    )


def uncovered_types(spark: SparkSession, sf: str) -> DataFrame:
    return N.uncovered_types(known_entities(spark, sf), B.seeds(spark)["concept_entity_rules"])


def matching_words(spark: SparkSession, sf: str) -> DataFrame:
    docs = B.table(spark, sf, "documents")
    words = docs.select(F.explode(F.split("text", " ")).alias("keyword"))
    return N.matching_labels(words, ["%tion%", "%ment%"], ["%mention%"], "keyword")


def topics_with_labels(spark: SparkSession, sf: str) -> DataFrame:
    return N.topics_with_labels(stored_topics(spark, sf), labels(spark, sf)).select(
        "feedly_id", "topic_label", rounded("topic_score")
    )


def subject_topics(spark: SparkSession, sf: str) -> DataFrame:
    return on_topic(spark, sf).select("feedly_id", "topic_label", rounded("topic_score"))


def themed(theme: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = N.themed_mentions(
            stored_entities(spark, sf), stored_articles(spark, sf), on_topic(spark, sf),
            N.THEMES[theme], datetime(1998, 3, 1),
        )
        return rows.select(
            "entity_type", rounded("confidence_sore"), rounded("relevance_score"), "entity_id",
            day("published_on"), "title", "url",
        )

    return query


def company_articles(spark: SparkSession, sf: str) -> DataFrame:
    rows = S.company_articles(stored_articles(spark, sf), stored_topics(spark, sf), stored_companies(spark, sf))
    return rows.select(
        "feedly_id", "topic_label", rounded("topic_score"), "uuid", "name", rounded("relevance_score"),
        "city", "region", "category", "category_group",
        day("published_on"), day("published_week"), day("published_month"),
    )


def sector_sets(min_score: float | None) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        sets = S.article_sectors(stored_topics(spark, sf), stored_companies(spark, sf), min_score=min_score)
        return sets.select(
            "feedly_id", *[joined(c) for c in ("topic_labels", "categories", "category_group", "company_names")]
        )

    return query


def digest(make) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = make(stored_articles(spark, sf), stored_topics(spark, sf), stored_companies(spark, sf), AS_OF)
        return rows.select(
            "feedly_id", second("published_at_with_tz"),
            *[joined(c) for c in ("topic_labels", "categories", "category_group", "company_names")],
            "title", rounded("engagement_rate"), "engagement", "url", "author", "site", joined("summary_sentences"),
        )

    return query


def digest_messages(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.latest_digest(stored_articles(spark, sf), stored_topics(spark, sf), stored_companies(spark, sf), AS_OF)
    return D.digest_messages(rows).select("feedly_id", "headline", "bullets", joined("captions", "\n"), "author_line")


def digest_headline(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.latest_digest(stored_articles(spark, sf), stored_topics(spark, sf), stored_companies(spark, sf), AS_OF)
    return D.digest_headline(rows, C.LATEST_TITLE)


def register_file(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "register")
    B.organizations(spark, sf).write.option("header", True).option("escape", '"').csv(path)
    return read_register(spark, path, "organizations").select(
        "uuid", "name", "permalink", "city", "region", "category_list"
    )


# --- routing ---------------------------------------------------------------


def routed(spark: SparkSession, sf: str) -> DataFrame:
    seeds = B.seeds(spark)
    return T.route(
        stored_articles(spark, sf), stored_entities(spark, sf), on_topic(spark, sf, distinct=True),
        seeds["concept_entity_rules"], seeds["concepts"], seeds["channel_concepts"], seeds["channels"],
    )


def analysed(spark: SparkSession, sf: str) -> tuple[DataFrame, ...]:
    return (
        stored_articles(spark, sf), stored_entities(spark, sf), stored_topics(spark, sf), stored_companies(spark, sf),
    )


def details(spark: SparkSession, sf: str) -> DataFrame:
    return T.details_of(*analysed(spark, sf), B.seeds(spark))


def unsent_rows(spark: SparkSession, sf: str) -> DataFrame:
    return T.unsent_of(*analysed(spark, sf), B.seeds(spark))


def match_rules(spark: SparkSession, sf: str) -> DataFrame:
    return T.match_rules(stored_entities(spark, sf), B.seeds(spark)["concept_entity_rules"]).select(
        "feedly_id", "entity_type", "entity_id", "concept_id"
    )


def route(spark: SparkSession, sf: str) -> DataFrame:
    return routed(spark, sf).select(
        "channel_id", "channel_name", "channel_emoji_icon", "target", "target_id", "concept_name",
        "entity_type", "entity_id", "topic_label", "feedly_id", "identifier",
    )


def channel_details(spark: SparkSession, sf: str) -> DataFrame:
    sets = ("concept_names", "entity_types", "topic_labels", "categories", "category_group", "company_names")
    return details(spark, sf).select("channel_id", "target", "target_id", "feedly_id", *[joined(c) for c in sets])


def unsent(spark: SparkSession, sf: str) -> DataFrame:
    return unsent_rows(spark, sf).select(
        "channel_id", "channel_name", "feedly_id", "title", "site", "author", "url",
        *[joined(c) for c in ("concept_names", "topic_labels", "categories", "company_names")],
        "engagement", day("created_at"), second("last_sent_at"),
    )


def unsent_always(spark: SparkSession, sf: str) -> DataFrame:
    """A channel without a mark gets everything."""
    mark = F.when(F.col("id") == 2, F.col("last_sent_at"))
    seeds = B.seeds(spark)
    seeds["channels"] = seeds["channels"].withColumn("last_sent_at", mark)
    rows = T.unsent_of(*analysed(spark, sf), seeds, null_watermark="always")
    return rows.select("channel_id", "feedly_id", "title", joined("topic_labels"), second("last_sent_at"))


def outbox(spark: SparkSession, sf: str) -> DataFrame:
    """Messages, and how far their send times lie after now, the published minute and second."""
    rows = T.outbox(unsent_rows(spark, sf), "slack", AS_OF)
    published = json_text(F.col("item"), "published_at").cast("timestamp_ntz")
    seconds = lambda ts: F.unix_seconds(ts.cast("timestamp"))
    after = seconds(F.col("post_at")) - seconds(moment(AS_OF))
    late = after - 60 * F.minute(published) - F.second(published)
    return rows.select(
        "channel_id", "feedly_id", "channel", "text", "headline", "bullets", joined("captions", "\n"), "author_line",
        "image_url", (late % 60).between(0, 9).alias("seconds_fit"), F.floor(late / 60).between(0, 9).alias("minutes_fit"),
    )


def advance_watermarks(spark: SparkSession, sf: str) -> DataFrame:
    channels = B.seeds(spark)["channels"]
    return T.advance_watermarks(channels, unsent_rows(spark, sf)).select("id", "name", second("last_sent_at"))


# --- keyed changes, work lists, checks -------------------------------------


def customer_rows(spark: SparkSession, sf: str) -> DataFrame:
    return B.table(spark, sf, "orders").select(
        F.concat(F.lit("customer/"), F.col("o_custkey")).alias("feedly_id"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
        F.col("o_orderdate").alias("published_at"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderpriority").alias("payload"),
        "o_orderstatus",
    )


def old_and_new(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = customer_rows(spark, sf)
    cut = moment(datetime(1998, 1, 1))
    old = rows.where(F.col("updated_at") < cut)
    base = M.latest_by_key(old, ["feedly_id"], ["updated_at", "seq"], ["created_at"])
    return base, rows.where(F.col("updated_at") >= cut)


def upsert(spark: SparkSession, sf: str) -> DataFrame:
    base, new = old_and_new(spark, sf)
    return M.upsert(base, new, ["feedly_id"], ("updated_at", "seq")).select(
        "feedly_id", day("created_at"), day("updated_at"), "payload"
    )


def update_existing(spark: SparkSession, sf: str) -> DataFrame:
    base, new = old_and_new(spark, sf)
    merged = M.update_existing(base, new, ["feedly_id"], ["payload", "updated_at"], ("updated_at", "seq"))
    return merged.select("feedly_id", day("created_at"), day("updated_at"), day("published_at"), "payload")


def upsert_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """Old rows, then new ones, into a table of buckets; the newest of both stays."""
    base, new = old_and_new(spark, sf)
    columns = ["feedly_id", "created_at", "updated_at", "payload", "seq"]
    table = KeyedTable(spark, shared_dir(spark, "keyed"), ["feedly_id"], base.select(*columns).schema, 16)
    for rows in (base, new):
        table.upsert(rows.select(*columns), ("updated_at", "seq"), ("created_at",))
    return table.read().select("feedly_id", day("created_at"), day("updated_at"), "payload")


def defaults(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as rows without ids, every second one stored before."""
    ensure_checkpoint_dir(spark)
    rows = B.table(spark, sf, "customer").select(
        F.concat(F.lit("customer/"), F.lpad(F.col("c_custkey").cast("string"), 12, "0")).alias("feedly_id"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"), F.lit(None).cast("timestamp_ntz").alias("updated_at"),
        F.when(F.col("c_acctbal") > 0, B.json_of(title=F.col("c_name"))).alias("payload"), "c_custkey",
    )
    none = spark.createDataFrame([], "id bigint, feedly_id string, created_at timestamp_ntz")
    first = M.with_defaults(rows.where("c_custkey % 2 = 0").drop("c_custkey"), none, "feedly_id", datetime(2001, 1, 1))
    stored = materialize(first, shared_dir(spark, "customers"))
    both = M.with_defaults(rows.drop("c_custkey"), stored, "feedly_id", datetime(2002, 1, 1))
    return both.select("id", "feedly_id", day("created_at"), day("updated_at"), "payload", M.digest_uuid(F.col("feedly_id")).alias("uuid"))


def merge_analyses(spark: SparkSession, sf: str) -> DataFrame:
    base, new = old_and_new(spark, sf)
    analyses = base.select(
        "created_at", "updated_at", "feedly_id", "payload", F.lit(200).alias("status_code"),
        F.col("updated_at").alias("status_at"), F.col("updated_at").alias("parsed_at"),
    )
    results = new.select(
        "feedly_id",
        F.when(F.col("o_orderstatus") != "F", F.col("payload")).alias("payload"),
        F.struct("updated_at", "seq").alias("seq"),
    )
    return M.merge_analyses(analyses, results, datetime(2002, 1, 1)).select(
        "feedly_id", "payload", "status_code", day("created_at"), day("parsed_at")
    )


def analysis_backlog(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without a label are those that wait for their analysis."""
    analyses = B.table(spark, sf, "labels").select(
        F.concat(F.lit("doc/"), F.col("doc_id")).alias("feedly_id"), F.lit(200).alias("status_code")
    )
    return M.analysis_backlog(B.stored(spark, sf, B.document_entries), analyses)


def refresh_batches(spark: SparkSession, sf: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    crawled = A.entry_details(parse_entries(B.stored(spark, sf, B.document_entries)))
    batches = M.refresh_batches(crawled, datetime(2020, 1, 2, 9))
    return batches.select(
        "batch", F.size("feedly_ids").cast("bigint").alias("n_ids"), F.array_join("feedly_ids", ",").alias("ids")
    )


def check_unique(spark: SparkSession, sf: str) -> DataFrame:
    return K.check_unique(B.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def check_not_null(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.table(spark, sf, "documents").join(B.table(spark, sf, "labels"), "doc_id", "left")
    return K.check_not_null(rows, ["quality", "toxic", "text"])


def check_fk(spark: SparkSession, sf: str) -> DataFrame:
    return K.check_fk(B.table(spark, sf, "documents"), B.table(spark, sf, "labels"), {"doc_id": "doc_id"})


def as_json(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.table(spark, sf, "orders").withColumn("none", F.lit(None).cast("string"))
    item = rows.select(M.as_json(*rows.columns).alias("item"))
    field = lambda name: json_text(F.col("item"), name)
    return item.select(
        field("o_orderkey").cast("bigint").alias("o_orderkey"),
        field("o_orderpriority").alias("o_orderpriority"),
        field("o_orderstatus").alias("o_orderstatus"),
        F.col("item").contains('"none":null').alias("keeps_nulls"),
    )


def materialized(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "board")
    materialize(leaderboard(B.line_mentions(spark, sf, sectors=False), "name", "month"), path)
    return show_period(current(spark, path))


def ordered_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The place of every line in the final order of a board."""
    board = ordered_board(leaderboard(B.line_mentions(spark, sf, sectors=False), "name", "month"), "name")
    return show_period(number_rows_as_posted(board))


def in_written_order(df: DataFrame, within: str) -> DataFrame:
    """``place`` within a group follows the order that a sorted frame is written in."""
    path = shared_dir(df.sparkSession, "ordered")
    df.withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(within).orderBy("_id")))


def number_rows_as_posted(board: DataFrame) -> DataFrame:
    return in_written_order(board, "time_period").select("time_period", "name", "rank", "place")


def ordered_unsent(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.ordered_unsent(unsent_rows(spark, sf)).select("channel_id", "feedly_id", "published_at")
    return in_written_order(rows, "channel_id").select("channel_id", "feedly_id", day("published_at"), "place")


def unsent_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Unsent rows from the analysis documents, narrowed before they are parsed."""
    tables = B.order_tables(spark, sf)
    rows = T.unsent_from(stored_articles(spark, sf), tables["feedly_entry_text_analyses"], tables)
    return rows.select(
        "channel_id", "channel_name", "feedly_id", "title", "site", "author", "url",
        *[joined(c) for c in ("concept_names", "topic_labels", "categories", "company_names")],
        "engagement", day("created_at"), second("last_sent_at"),
    )


def refreshed(spark: SparkSession, sf: str) -> DataFrame:
    """Views stored by two refreshes and read back from their current version."""
    root, tables = shared_dir(spark, "views"), B.order_tables(spark, sf)
    names = ["articles", "vw_article_nlp_topics"]
    refresh(tables, root, AS_OF, names)
    refresh(tables, root, AS_OF, names[:1])
    stored = load_stored(spark, root, names)
    topics = stored["vw_article_nlp_topics"].groupBy("feedly_id").agg(F.count("*").alias("n_topics"))
    return stored["articles"].select("feedly_id", "title").join(topics, "feedly_id")


def refresh_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The views after two changes that follow the changed keys only."""
    tables = B.order_tables(spark, sf)
    # Buckets of a bounded size; no reader keeps an older version.
    views = IncrementalViews(spark, shared_dir(spark, "views"), tables["organizations"], B.bounded_buckets(spark, sf, 16), keep=1)
    part = F.pmod(F.xxhash64("feedly_id"), F.lit(20))
    for name, some in (("most", part > 0), ("some", part < 2)):
        change = (tables[t].where(some) for t in ("feedly_entries", "feedly_entry_text_analyses"))
        views.apply(name, *(conform(df, schema) for df, schema in zip(change, (schemas.ENTRIES, schemas.ANALYSES), strict=True)))
    stored = views.stored()
    topics = stored["vw_article_nlp_topics"].groupBy("feedly_id").agg(F.count("*").alias("n_topics"))
    return stored["articles"].select("feedly_id", "title").join(topics, "feedly_id")


def check_model(spark: SparkSession, sf: str) -> DataFrame:
    """The rules of the data model, broken by design: entries are lines of one order."""
    tables = {
        "feedly_entries": B.table(spark, sf, "lineitem").select(
            F.col("l_orderkey").alias("feedly_id"), F.col("l_shipdate").alias("created_at"),
            F.col("l_shipdate").alias("updated_at"),
            F.when(F.col("l_returnflag") != "R", F.col("l_shipdate")).alias("published_at"),
        ),
        "channel_concepts": B.table(spark, sf, "documents").select(
            F.col("doc_id").alias("channel_id"), F.col("doc_id").alias("concept_id")
        ),
        "channels": B.table(spark, sf, "labels").select(
            F.col("doc_id").alias("id"), *[F.col("doc_id").cast("string").alias(c) for c in ("name", "target", "target_id", "emoji_icon")]
        ),
    }
    return K.check_tables(tables)


# Views through the graph: the entries they are fed with, and what is shown of them.
SETS = ("topic_labels", "categories", "category_group", "company_names")
DIGEST = lambda df: df.select(
    "feedly_id", second("published_at_with_tz"), *[joined(c) for c in SETS], "title", rounded("engagement_rate"),
    "engagement", "url", "author", "site", joined("summary_sentences"),
)
VIEWS: dict[str, tuple[Callable, Callable[[DataFrame], DataFrame]]] = {
    "vw_feedly_entry_details": (B.page_entries, page_columns),
    "vw_article_common_topics": (B.document_entries, lambda df: df.select(
        "feedly_id", "topic_id", "topic_label", rounded("topic_score"), "topic_salince_level")),
    "vw_article_entities": (B.document_entries, lambda df: df.select(
        "feedly_id", "entity_id", "entity_label", "entity_salince_level")),
    "vw_article_keywords": (B.document_entries, lambda df: df.select("feedly_id", "keyword")),
    "vw_article_summary_sentences": (B.document_entries, lambda df: df.select(
        "feedly_id", "summary_sentence", "summary_sentence_position", "summary_sentence_score")),
    "vw_article_priorities": (B.document_entries, lambda df: df.select(
        "feedly_id", "priority_id", "priority_label", "search_term_id", "search_term_label")),
    "vw_article_common_common_topic_list": (B.document_entries, lambda df: df),
    "vw_article_entity_list": (B.document_entries, lambda df: df),
    "vw_article_keyword_list": (B.document_entries, lambda df: df),
    "vw_article_entities_by_topics": (B.part_entries, lambda df: df.select(
        "feedly_id", "entity_id", "entity_label", "topic_id", "topic_label")),
    "vw_article_entities_by_keywords": (B.part_entries, lambda df: df.select(
        "feedly_id", "entity_id", "entity_label", "keyword")),
    "vw_article_nlp_topics": (B.order_entries, lambda df: df.select(
        "feedly_id", "topic_position", "topic_label", rounded("topic_score"))),
    "vw_article_nlp_entities": (B.order_entries, lambda df: df.select(
        "feedly_id", "entity_type", "entity_id", "crunchbase_id", "wikidata_id", "entity_external_id",
        "matched_text", "starting_pos", joined("matching_tokens", ","),
        rounded("relevance_score"), rounded("confidence_sore"), "mentions")),
    "vw_article_nlp_text": (B.order_entries, lambda df: df.select("feedly_id", "full_text")),
    "vw_article_nlp_categories": (B.order_entries, lambda df: df.select(
        "feedly_id", "category_position", "category_label", rounded("category_score"), "category_id", "classifier_id")),
    "vw_article_nlp_companies": (B.order_entries, lambda df: df.select(
        "feedly_id", "entity_id", "entity_external_id", "crunchbase_id", rounded("relevance_score"),
        rounded("confidence_sore"), "uuid", "name", "permalink", "city", "region")),
    "vw_xr_nlp_topics": (B.order_entries, lambda df: df),
    "vw_xr_topics": (B.order_entries, lambda df: df),
    "vw_nlp_entities_without_concepts": (B.order_entries, lambda df: df),
    "vw_organization_categories": (B.order_entries, lambda df: df),
    "vw_organization_category_groups": (B.order_entries, lambda df: df),
    "vw_categories_with_category_groups": (B.order_entries, lambda df: df),
    "vw_category_list": (B.order_entries, lambda df: df),
    "vw_category_groups_list": (B.order_entries, lambda df: df),
    "xr_company_articles_with_sectors": (B.order_entries, lambda df: df.select(
        "feedly_id", "topic_label", rounded("topic_score"), "uuid", "name", rounded("relevance_score"),
        "city", "region", "category", "category_group",
        day("published_on"), day("published_week"), day("published_month"))),
    "vw_latest_articles": (B.order_entries, DIGEST),
    "vw_top_articles_last_24_hours": (B.order_entries, DIGEST),
    "vw_xr_channel_articles": (B.order_entries, lambda df: df.select(
        "channel_id", "channel_name", "channel_emoji_icon", "target", "target_id", "concept_name",
        "entity_type", "entity_id", "topic_label", "feedly_id", "identifier")),
    "vw_xr_channel_article_details": (B.order_entries, lambda df: df.select(
        "channel_id", "target", "target_id", "feedly_id", *[joined(c) for c in ("concept_names", "entity_types", *SETS)])),
    "vw_xr_channel_articles_unsent_by_channel_and_target": (B.order_entries, lambda df: df.select(
        "channel_id", "channel_name", "feedly_id", "title", "site", "author", "url",
        *[joined(c) for c in ("concept_names", "topic_labels", "categories", "company_names")],
        "engagement", day("created_at"), second("last_sent_at"))),
}
for _grain in GRAINS:
    for _subject in ("topics", "keywords", "entities"):
        VIEWS[f"vw_article_{_subject}_by_{_grain}"] = (B.document_entries, show_period)
    for _subject in ("companies", "categories", "category_groups", "companies_by_categories", "topics"):
        VIEWS[f"vw_xr_ranked_{_subject}_by_{_grain}"] = (B.order_entries, show_period)


def view_name(name: str) -> str:
    return "view_" + name.removeprefix("vw_").removeprefix("xr_")


def shown_view(name: str) -> Query:
    entries, show = VIEWS[name]

    def query(spark: SparkSession, sf: str) -> DataFrame:
        tables = B.order_tables(spark, sf)
        if entries is not B.order_entries:
            tables["feedly_entries"] = B.stored(spark, sf, entries)
        return show(build_views(tables, VIEWS_AS_OF)[name])

    return query


def view_rankings(spark: SparkSession, sf: str) -> DataFrame:
    rows = build_views(B.order_tables(spark, sf), AS_OF, week=datetime(1998, 6, 29))["vw_xr_article_rankings"]
    return rows.select("feedly_id", day("published_day"), "popularity_by_month")


def view_articles(spark: SparkSession, sf: str) -> DataFrame:
    rows = build_views(B.order_tables(spark, sf), AS_OF)["articles"]
    return rows.select("feedly_id", "site", "title", "url", day("published_at"))


# --- streams ---------------------------------------------------------------


def file_stream(df: DataFrame, key: str, file_bytes: int = 32 << 20) -> DataFrame:
    """A table as a stream of four batches; a hash deals the rows out, so every
    batch holds times from all over.  A batch has as many files as keep one near
    ``file_bytes`` of what the table is read from."""
    path = shared_dir(df.sparkSession, "stream")
    files = max(1, -(-input_bytes(df) // (4 * file_bytes)))
    with B.small_tasks(df.sparkSession):
        df.repartition(4 * files, F.xxhash64(key)).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    return file_stream(B.table(spark, sf, "events"), "event_id")


def stream_upsert(spark: SparkSession, sf: str, compacted: bool = False) -> DataFrame:
    entries = event_stream(spark, sf).select(
        F.concat(F.lit("user/"), F.col("user_id")).alias("feedly_id"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("updated_at"),
        F.col("ts").alias("published_at"),
        F.col("event_id").alias("id"),
        B.json_of(title=F.col("event_type")).alias("payload"),
    )
    log, checkpoint = shared_dir(spark, "entries"), shared_dir(spark, "checkpoint")
    order = ("updated_at", "id")
    ingest_entries(entries, log, checkpoint, order).awaitTermination()
    # The first two batches are compacted, the others folded into them.
    early = current_entries(spark, log, order=order) if compacted else None
    rows = current_entries(spark, log, order=order)
    if compacted:
        first = spark.read.parquet(log).where("batch_id < 2").drop("batch_id")
        base = materialize(M.latest_by_key(first, ["feedly_id"], order, ["created_at"]), shared_dir(spark, "base"))
        rows = compact(spark, log, shared_dir(spark, "table"), base, after=1, order=order)
        rows = rows.join(early.select("feedly_id"), "feedly_id", "left_semi")
    return rows.select(
        "feedly_id", second("created_at"), second("updated_at"), json_text(F.col("payload"), "title").alias("title")
    )


def stream_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = event_stream(spark, sf).select(
        F.col("event_id").alias("feedly_id"), F.col("ts").alias("published_at"), F.col("event_type").alias("topic_label")
    )
    log, checkpoint = shared_dir(spark, "counts"), shared_dir(spark, "checkpoint")
    count_increments(rows, "topic_label", log, checkpoint).awaitTermination()
    return show_period(roll_up(daily_counts(spark, log, "topic_label"), "topic_label", "week"))


def stream_board(spark: SparkSession, sf: str) -> DataFrame:
    """The month board of suppliers from day counts that a stream has folded."""
    rows = file_stream(B.line_mentions(spark, sf, sectors=False), "feedly_id")
    table = day_table(spark, shared_dir(spark, "days"), ["name"], buckets=16)
    fold_counts(rows, table, ["name"], shared_dir(spark, "checkpoint"), BOARD_ZONE).awaitTermination()
    return show_period(board_of_days(table.read(), "name", "month"))


def register_tables(spark: SparkSession, sf: str) -> DataFrame:
    """All register tables as folders of CSV files with line breaks and quotes
    in their fields, loaded with their types."""
    supplier = B.table(spark, sf, "supplier")
    note = F.concat(F.lit('He said "'), F.col("s_name"), F.lit('",\nthen left'))
    key = F.col("s_suppkey").cast("string")
    shown = {
        "category_groups": ("id", "name", "category_groups_list"),
        "organizations": ("uuid", "name", "short_description"),
        "organization_descriptions": ("uuid", "name", "description"),
        "organization_categories": ("organization_uuid", "organization_name", "category"),
        "org_parents": ("uuid", "name", "parent_name"),
    }
    out = None
    for name, (first, second_, third) in shown.items():
        rows = supplier.select(key.alias(first), F.col("s_name").alias(second_), note.alias(third), F.col("s_suppkey").alias("rank"))
        path = shared_dir(spark, name)
        conform(rows, schemas.REGISTER[name]).repartition(3).write.option("header", True).option("escape", '"').csv(path)
        read = read_register(spark, path, name)
        rank = F.col("rank") if "rank" in read.columns else F.lit(None)
        read = read.select(F.lit(name).alias("table_name"), F.col(first).alias("key"), F.col(second_).alias("name"),
                           F.col(third).alias("note"), rank.cast("bigint").alias("rank"))
        out = read if out is None else out.unionByName(read)
    return out


def sent_events(spark: SparkSession, sf: str) -> tuple[str, str, DataFrame]:
    """Deliver the events as channel articles; gives the sent and state logs."""
    marks = {1: datetime(2024, 1, 10), 2: datetime(2024, 1, 20)}
    mark = F.when(F.col("id") == 1, moment(marks[1])).otherwise(moment(marks[2]))
    channels = B.seeds(spark)["channels"].withColumn("last_sent_at", mark)
    first = F.col("event_type").isin("view", "click")
    pick = lambda a, b: F.when(first, F.lit(a)).otherwise(F.lit(b))
    none = F.lit(None).cast("string")
    no_names = F.array(none)
    rows = event_stream(spark, sf).select(
        pick(1, 2).cast("bigint").alias("channel_id"),
        pick("Pop Culture", "Sports").alias("channel_name"),
        pick(":tv:", ":trophy:").alias("channel_emoji_icon"),
        F.lit("slack").alias("target"),
        pick("#pop-culture", "#sports-channel").alias("target_id"),
        F.concat(F.lit("event/"), F.col("event_id")).alias("feedly_id"),
        F.col("props").alias("title"),
        none.alias("url"), none.alias("author"), none.alias("site"), none.alias("image_url"),
        no_names.alias("summary_sentences"), no_names.alias("company_names"), no_names.alias("categories"),
        F.array("event_type").alias("topic_labels"),
        F.col("ts").alias("created_at"), F.col("ts").alias("published_at"), F.col("ts").alias("published_at_with_tz"),
        F.lit(None).cast("timestamp_ntz").alias("last_sent_at"),
    )
    sent, state = shared_dir(spark, "sent"), shared_dir(spark, "channels")
    deliver(rows, channels, "slack", sent, state, shared_dir(spark, "checkpoint"), EVENTS_AS_OF).awaitTermination()
    return sent, state, channels


def stream_unsent(spark: SparkSession, sf: str) -> DataFrame:
    sent, _, _ = sent_events(spark, sf)
    return spark.read.parquet(sent).select("channel_id", "feedly_id", second("created_at"), "text")


def batch_parts(spark: SparkSession, sf: str) -> int:
    """Parts of a batch that a task can hold in memory: a batch is a fourth of the articles."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(partitions, -(-B.bounded_buckets(spark, sf, 1) // 4))


def stream_routing(spark: SparkSession, sf: str) -> DataFrame:
    """Analyses of orders arrive as files; rules, topics and sectors run per batch."""
    tables = B.order_tables(spark, sf)
    analyses = file_stream(tables["feedly_entry_text_analyses"], "feedly_id")
    sent, state = shared_dir(spark, "sent"), shared_dir(spark, "channels")
    deliver_analyses(
        analyses, tables["feedly_entries"], tables, "slack", sent, state, shared_dir(spark, "checkpoint"), AS_OF,
        shared_dir(spark, "waiting"), parts=batch_parts(spark, sf),
    ).awaitTermination()
    return spark.read.parquet(sent).select(
        "channel_id", "feedly_id", "text", "headline", joined("captions", "\n")
    )


def stream_routing_early(spark: SparkSession, sf: str) -> DataFrame:
    """Entries and analyses arrive as two streams of files, most of them in
    different batches, some analyses before their entries and some after."""
    tables = B.order_tables(spark, sf)
    entries, analyses = tables["feedly_entries"], tables["feedly_entry_text_analyses"]
    both = arrivals(file_stream(analyses, "feedly_id"), file_stream(entries, "payload"))
    parts = batch_parts(spark, sf)
    table = KeyedTable(spark, shared_dir(spark, "entries"), ["feedly_id"], entries.schema, max(16, parts), dealt=True)
    sent = shared_dir(spark, "sent")
    deliver_analyses(
        both, table, tables, "slack", sent, shared_dir(spark, "channels"), shared_dir(spark, "checkpoint"), AS_OF,
        shared_dir(spark, "waiting"), parts=max(16, parts),
    ).awaitTermination()
    return spark.read.parquet(sent).select(
        "channel_id", "feedly_id", "text", "headline", joined("captions", "\n")
    )


def stream_windowed(spark: SparkSession, sf: str) -> DataFrame:
    """Closed days of the events, with a watermark that no event is later than."""
    rows = event_stream(spark, sf).select(
        F.col("event_id").alias("feedly_id"), F.col("ts").alias("published_at"), F.col("event_type").alias("topic_label")
    )
    out = shared_dir(spark, "windowed")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    counts = windowed_counts(rows, "topic_label", "400 days")
    counts.writeStream.outputMode("update").foreachBatch(keep).option(
        "checkpointLocation", shared_dir(spark, "checkpoint")
    ).trigger(availableNow=True).start().awaitTermination()
    days = spark.read.parquet(out)
    last = days.groupBy("time_period", "topic_label").agg(F.max("count").alias("count"))  # counts only grow
    return show_period(last)


def stream_watermarks(spark: SparkSession, sf: str) -> DataFrame:
    _, state, channels = sent_events(spark, sf)
    return channel_state(spark, channels, state).select("id", second("last_sent_at"))


LANDED = (B.document_entries, B.page_entries, B.part_entries)
BUCKETED = (B.order_entries, B.order_analyses, B.order_articles, topics, entities, resolved)


def land(spark: SparkSession, sf: str) -> None:
    """Write the tables and stored views that queries read, once per application."""
    for make in (*LANDED, *BUCKETED):
        B.stored(spark, sf, make, make in BUCKETED)


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for g in GRAINS:
        for subject, (by, within) in LINE_BOARDS.items():
            q[f"board_{subject}_{g}"] = line_board(by, within, g)
        q[f"board_topic_{g}"] = topic_board(g)
        q[f"period_counts_topic_{g}"] = counted(B.event_mentions, "topic_label", g)
        q[f"period_counts_keyword_{g}"] = counted(doc_keywords, "keyword", g)
        q[f"period_counts_entity_{g}"] = counted(doc_entities, "entity_label", g)
    q["top_companies_last_month"] = line_top("name", "last-month")
    q["top_companies_month"] = line_top("name", "month")
    q["top_categories_week"] = lambda spark, sf: show_period(
        top_mentions(B.line_mentions(spark, sf), "category", "week", datetime(1998, 6, 17, 12)))
    q["top_groups_last_week"] = lambda spark, sf: show_period(
        top_mentions(B.line_mentions(spark, sf), "category_group", "last-week", datetime(1998, 6, 17, 12)))
    q["top_topics_yesterday"] = topic_top("yesterday")
    q["top_topics_day"] = topic_top("day")
    q.update(
        entry_details=entry_details,
        page_articles=page_articles,
        host_of=sites,
        document_soundex=document_soundex,
        articles_dedup=articles_dedup,
        json_fields=json_fields,
        entries_from_json=feed_items,
        common_topics=common_topics,
        topic_list=topic_list,
        feed_entities=feed_entities,
        entity_list=lambda spark, sf: A.entity_list(doc_entities(spark, sf)),
        keywords=lambda spark, sf: doc_keywords(spark, sf).select("feedly_id", "keyword"),
        keyword_list=lambda spark, sf: A.keyword_list(doc_keywords(spark, sf)),
        summary_sentences=summary_sentences,
        sentence_lists=sentence_lists,
        priorities=priorities,
        entities_by_topics=entities_by_topics,
        entities_by_keywords=entities_by_keywords,
        cooccurrence=cooccurrence,
        article_rankings=article_rankings,
        analysis_topics=analysis_topics,
        analysis_categories=analysis_categories,
        analysis_text=analysis_text,
        analysis_entities=analysis_entities,
        companies=companies,
        uncovered_types=uncovered_types,
        matching_labels=lambda spark, sf: N.matching_labels(stored_topics(spark, sf)),
        canonical_labels=labels,
        matching_words=matching_words,
        topics_with_labels=topics_with_labels,
        subject_topics=subject_topics,
        company_articles=company_articles,
        article_sectors=sector_sets(None),
        strong_article_sectors=sector_sets(D.TOP_MIN_SCORE),
        latest_digest=digest(D.latest_digest),
        top_digest=digest(D.top_digest),
        digest_headline=digest_headline,
        org_categories=lambda spark, sf: R.org_categories(B.organizations(spark, sf)),
        org_category_groups=lambda spark, sf: R.org_category_groups(B.organizations(spark, sf)),
        category_map=lambda spark, sf: R.category_map(B.category_groups(spark, sf)),
        category_list=lambda spark, sf: R.category_list(B.category_groups(spark, sf)),
        group_list=lambda spark, sf: R.group_list(B.category_groups(spark, sf)),
        read_register=register_file,
        match_rules=match_rules,
        route=route,
        channel_details=channel_details,
        unsent=unsent,
        unsent_always=unsent_always,
        outbox=outbox,
        advance_watermarks=advance_watermarks,
        upsert=upsert,
        update_existing=update_existing,
        merge_analyses=merge_analyses,
        analysis_backlog=analysis_backlog,
        refresh_batches=refresh_batches,
        check_unique=check_unique,
        check_not_null=check_not_null,
        check_fk=check_fk,
        as_json=as_json,
        materialize=materialized,
        view_articles=view_articles,
        feed_numbers=feed_numbers,
        all_alternates=all_alternates,
        seed_files=seed_files,
        null_sets=null_sets,
        digest_messages=digest_messages,
        ordered_board=ordered_rows,
        refresh=refreshed,
        check_tables=check_model,
        stream_routing=stream_routing,
        stream_routing_early=stream_routing_early,
        ordered_unsent=ordered_unsent,
        upsert_buckets=upsert_buckets,
        defaults=defaults,
        refresh_changes=refresh_changes,
        stream_board=stream_board,
        register_tables=register_tables,
        unsent_documents=unsent_documents,
        stream_windowed=stream_windowed,
        stream_compact=lambda spark, sf: stream_upsert(spark, sf, compacted=True),
        stream_upsert=stream_upsert,
        stream_counts=stream_counts,
        stream_unsent=stream_unsent,
        stream_watermarks=stream_watermarks,
    )
    for theme in N.THEMES:
        q[f"themed_mentions_{theme}"] = themed(theme)
    q["view_article_rankings"] = view_rankings
    for name in VIEWS:
        q[view_name(name)] = shown_view(name)
    return q
