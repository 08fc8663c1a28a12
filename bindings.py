"""The given tables in the roles of the engine's inputs.

Feed and analysis documents are made by Spark from whole tables, so queries
over them run the real JSON path and grow with the data:

* ``documents`` and ``pages`` become feed entries,
* ``orders`` become entries whose ``lineitem`` rows are the entity mentions of
  the analysis document,
* ``supplier`` is the company register, ``part`` the category list.

The name tables only rename values of low-cardinality columns, so that the
engine's own topic patterns, themes and rules have something to match.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newsboard.functions.text import map_labels
from newsboard.functions.time import moment
from newsboard.operators.articles import entry_details
from newsboard.plans.storage import path_bytes, shared_dir
from newsboard.sources import schemas as S
from newsboard.sources.feed import parse_analyses, parse_entries
from newsboard.sources.seeds import conform, default_seeds, small_table

TYPE_NAMES = {
    "ECONOMY": "SportsTeam",
    "LARGE": "SoccerClub",
    "PROMO": "TelevisionShow",
    "MEDIUM": "University",
    "STANDARD": "Venue",
    "SMALL": "Software",
}
TOPIC_NAMES = {
    "1-URGENT": "Virtual reality headset",
    "2-HIGH": "Virtual reality headsets",
    "3-MEDIUM": "Machine learning",
    "4-NOT SPECIFIED": "Reality television",
    "5-LOW": "Sport",
    "F": "Virtual machines",
    "O": "Virtual reality",
    "P": "Augmented reality",
}
# Marks and concepts of the two seed channels.
CHANNEL_ICONS = {1: ":tv:", 2: ":trophy:"}
CHANNEL_MARKS = {1: datetime(1998, 1, 1), 2: datetime(2000, 6, 1)}
CHANNEL_CONCEPTS = ((1, 1), (1, 3), (2, 12), (2, 4))

# Orders and lines, in bytes of their files, whose articles make one bucket: some 30,000 orders.
BUCKET_BYTES = 2_500_000

FIRST_HOUR_MS = 1577836800000  # 2020-01-01 00:00 UTC
HOUR_MS = 3600000

_PARTITIONS = "spark.sql.shuffle.partitions"
# What a task that lands rows reads of files, and of shuffles that are merged, at most.
_TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": 32 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 32 << 20,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_STORED: dict[tuple[str, str, str], str] = {}


def bounded_buckets(spark: SparkSession, sf_dir: str, least: int) -> int:
    """Number of buckets of articles that a task can hold in memory, at least ``least``."""
    size = sum(path_bytes(spark, f"{sf_dir}/{name}.parquet") for name in ("orders", "lineitem"))
    return max(least, -(-size // BUCKET_BYTES))


def article_buckets(spark: SparkSession, sf_dir: str) -> int:
    """Number of buckets of the article tables: as many as a shuffle has partitions,
    and more of a table whose buckets a task could not hold in memory."""
    return bounded_buckets(spark, sf_dir, int(spark.conf.get(_PARTITIONS)))


def small_tasks(spark: SparkSession):
    """Tasks that read files are small, shuffles have as many partitions as ever."""
    return _landing(spark, int(spark.conf.get(_PARTITIONS)))


@contextmanager
def _landing(spark: SparkSession, buckets: int) -> Iterator[None]:
    """Shuffles of the steps inside have as many partitions as there are buckets, and
    tasks are small: with many partitions a task sorts what it shuffles in memory.
    The session's own values come back; smaller ones stay."""
    before = {name: spark.conf.get(name) for name in (_PARTITIONS, *_TASK_BYTES)}
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    spark.conf.set(_PARTITIONS, str(buckets))
    for name, most in _TASK_BYTES.items():
        spark.conf.set(name, str(min(most, in_bytes(before[name]))))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def stored(
    spark: SparkSession, sf_dir: str, make: Callable[[SparkSession, str], DataFrame], bucketed: bool = False
) -> DataFrame:
    """An input table made by ``make``, written once per application.

    The engine reads its documents as JSON text from a table, so the documents
    are landed like an ingest would, and every query parses them from there.
    Landing is a step of its own (``registry.land``); a query that is run
    without it lands what it needs first.

    ``bucketed`` tables lie in ``article_buckets`` buckets of the article id: what
    joins or groups their rows by the article finds them together and shuffles
    nothing.  A task writes one bucket, of a bounded number of articles.
    """
    key = (spark.sparkContext.applicationId, sf_dir, make.__name__)
    if key not in _STORED:
        path = shared_dir(spark, make.__name__)
        rows = make(spark, sf_dir)
        if bucketed:
            buckets = article_buckets(spark, sf_dir)
            writer = rows.repartition(buckets, "feedly_id").write.bucketBy(buckets, "feedly_id").option("path", path)
        else:
            writer = rows.write
        # Files of a bounded number of rows, so that readers share the parsing.
        writer = writer.format("parquet").option("maxRecordsPerFile", 20_000).option("compression", "zstd")
        name = path.rpartition("/")[2].replace("-", "_")
        if bucketed:
            with _landing(spark, buckets):
                writer.saveAsTable(name)
        else:
            writer.save(path)
        _STORED[key] = name if bucketed else path
    return spark.table(_STORED[key]) if bucketed else spark.read.parquet(_STORED[key])


def is_stored(spark: SparkSession, sf_dir: str, make: Callable[[SparkSession, str], DataFrame]) -> bool:
    """Whether this application has landed the table made by ``make``."""
    return (spark.sparkContext.applicationId, sf_dir, make.__name__) in _STORED


def forget_stored() -> None:
    """Land anew from here on; the files stay until ``storage.clear_shared``."""
    _STORED.clear()


def json_of(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def _entry(df: DataFrame, feedly_id: Column, created: Column, published: Column, payload: Column) -> DataFrame:
    return df.select(
        created.alias("created_at"),
        created.alias("updated_at"),
        published.alias("published_at"),
        feedly_id.alias("feedly_id"),
        payload.alias("payload"),
    )


def _hour(n: Column) -> Column:
    base = moment(datetime(2020, 1, 1))
    return base + F.make_dt_interval(hours=n.cast("int"))


def hrefs(urls: Column) -> Column:
    return F.transform(urls, lambda u: F.struct(u.alias("href")))


def document_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entry per document: title = first line, keywords = words,
    summary = lines, entities = distinct words, topics = language and source."""
    docs = table(spark, sf_dir, "documents")
    lines = F.split("text", "\n")
    words = F.split("text", " ")
    names = F.array_distinct(F.filter(words, lambda w: w != ""))
    topic = lambda kind, salience: F.struct(
        F.concat(F.lit(f"{kind}/"), F.col(kind)).alias("id"),
        F.col(kind).alias("label"),
        (F.col("n_chars") / 1000).alias("score"),
        F.lit(salience).alias("salienceLevel"),
    )
    part = lambda kind: F.struct(F.lit(kind).alias("id"), F.col(kind).alias("label"))
    millis = F.lit(FIRST_HOUR_MS) + F.col("doc_id") * HOUR_MS
    payload = json_of(
        id=F.concat(F.lit("doc/"), F.col("doc_id")),
        title=F.get(lines, F.lit(0)),
        author=F.col("lang"),
        fingerprint=F.md5("text"),
        alternate=hrefs(F.array(F.concat(F.lit("https://www."), F.col("source"), F.lit(".example.com/"), F.col("doc_id")))),
        published=millis,
        crawled=millis + HOUR_MS,
        engagement=F.col("n_chars"),
        engagementRate=F.col("n_chars") / 1000,
        commonTopics=F.array(topic("lang", "about"), topic("source", "mention")),
        entities=F.transform(
            names,
            lambda w: F.struct(F.lower(w).alias("id"), w.alias("label"), F.col("lang").alias("salienceLevel")),
        ),
        keywords=words,
        leoSummary=F.struct(
            F.transform(
                lines,
                lambda x, i: F.struct(x.alias("text"), i.alias("position"), F.length(x).alias("score")),
            ).alias("sentences")
        ),
        priorities=F.array(
            F.struct(
                F.col("source").alias("id"),
                F.col("lang").alias("label"),
                F.struct(F.array(part("lang"), part("source")).alias("parts")).alias("searchTerms"),
            )
        ),
    )
    at = _hour(F.col("doc_id"))
    return _entry(docs, F.concat(F.lit("doc/"), F.col("doc_id")), at, at, payload)


def page_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entry per web page, with links as enclosures and a string-encoded visual."""
    pages = table(spark, sf_dir, "pages")
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    lang = F.regexp_extract("url", "/([a-z][a-z])/", 1)
    millis = F.lit(FIRST_HOUR_MS) + F.col("page_id") * HOUR_MS
    payload = json_of(
        id=F.concat(F.lit("page/"), F.col("page_id")),
        title=F.regexp_extract("html", "<title>([^<]*)</title>", 1),
        author=F.when(lang != "en", lang),
        fingerprint=F.md5("html"),
        originId=F.col("url"),
        canonicalUrl=F.when(F.col("url").endswith(".html"), F.col("url")),
        alternate=hrefs(F.array("url")),
        visual=json_of(url=F.when(F.col("url").startswith("https"), F.lit("none")).otherwise(F.get(links, F.lit(0)))),
        enclosure=hrefs(links),
        content=F.struct(F.col("html").alias("content")),
        published=millis,
        crawled=millis + HOUR_MS,
        engagement=F.when(lang != "fr", F.length("html")),
        engagementRate=F.length("url") / 10,
    )
    at = _hour(F.col("page_id"))
    return _entry(pages, F.concat(F.lit("page/"), F.col("page_id")), at, at, payload)


def part_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entry per part: entities = brand and type, topics and keywords = name words."""
    parts = table(spark, sf_dir, "part")
    words = F.split("p_name", " ")
    entity = lambda c: F.struct(F.lower(c).alias("id"), F.col(c).alias("label"))
    payload = json_of(
        id=F.concat(F.lit("part/"), F.col("p_partkey")),
        title=F.col("p_name"),
        entities=F.array(entity("p_brand"), entity("p_type")),
        keywords=words,
        commonTopics=F.transform(words, lambda w: F.struct(F.upper(w).alias("id"), w.alias("label"))),
    )
    at = _hour(F.col("p_size"))
    return _entry(parts, F.concat(F.lit("part/"), F.col("p_partkey")), at, at, payload)


def _by_order(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows dealt out by their article id, which is made of the key where they arrive:
    the short columns travel, not the text that is made of them.  The number is named,
    as small shuffles may be merged to few tasks, which make long texts of them."""
    article = F.concat(F.lit("order/"), F.col(key))
    return df.repartition(buckets, article).withColumn("feedly_id", article)


def order_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entry per order: title = priority, site by customer, rate from the price."""
    orders = _by_order(table(spark, sf_dir, "orders"), "o_orderkey", article_buckets(spark, sf_dir))
    payload = json_of(
        id=F.concat(F.lit("order/"), F.col("o_orderkey")),
        title=F.col("o_orderpriority"),
        author=F.concat(F.lit("customer "), F.col("o_custkey")),
        alternate=hrefs(F.array(F.concat(F.lit("https://www.c"), F.col("o_custkey"), F.lit(".example.com/"), F.col("o_orderkey")))),
        engagement=F.floor(F.col("o_totalprice") / 10000),
        engagementRate=F.floor(F.col("o_totalprice") / 1000) / 1000,
        leoSummary=F.struct(
            F.array(
                F.struct(F.col("o_orderpriority").alias("text"), F.lit(2).alias("position")),
                F.struct(F.col("o_orderstatus").alias("text"), F.lit(1).alias("position")),
            ).alias("sentences")
        ),
    )
    at = F.col("o_orderdate")
    return _entry(orders, F.col("feedly_id"), at, at, payload)


def order_analyses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analysis rows of the orders: lines are entity mentions, priority and
    status are topics.  An order has few lines, which bounds each document."""
    buckets = article_buckets(spark, sf_dir)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    entity = F.struct(
        F.array(F.lit("Company"), map_labels(F.col("p_type"), TYPE_NAMES)).alias("type"),
        F.col("s_name").alias("entityEnglishId"),
        F.when(F.col("l_returnflag") != "N", F.concat(F.lit("supplier-"), F.col("l_suppkey"))).alias("crunchbaseId"),
        F.concat(F.lit("part/"), F.col("l_partkey")).alias("wikidataId"),
        F.col("p_name").alias("matchedText"),
        F.col("l_linenumber").alias("startingPos"),
        F.array("l_linenumber", F.col("l_linenumber") + 1).alias("matchingTokens"),
        (F.col("l_quantity") / 50).alias("relevanceScore"),
        (F.col("l_extendedprice") / 10000).alias("confidenceScore"),
    )
    # Plain columns travel to the order, where the entities are made of them.
    per_order = _by_order(
        lines.select(
            "l_orderkey", "l_suppkey", "l_partkey", "l_linenumber", "l_returnflag", "l_quantity", "l_extendedprice",
            "s_name", "p_name", "p_type",
        ),
        "l_orderkey", buckets,
    ).groupBy("feedly_id").agg(F.collect_list(entity).alias("entities"))
    topic = lambda pos, c: F.struct(
        F.lit(pos).alias("id"),
        map_labels(F.col(c), TOPIC_NAMES).alias("label"),
        (F.col("o_totalprice") / 500000).alias("score"),
    )
    category = F.struct(
        F.lit(0).alias("id"), F.col("o_orderpriority").alias("label"),
        (F.col("o_totalprice") / 500000).alias("score"), F.col("o_orderstatus").alias("categoryId"),
        F.lit("priority").alias("classifierId"),
    )
    orders = _by_order(table(spark, sf_dir, "orders"), "o_orderkey", buckets)
    joined = orders.join(per_order, "feedly_id", "left")
    payload = json_of(
        cleanedText=F.concat_ws(" ", "o_orderpriority", "o_orderstatus"),
        topics=F.array(topic(0, "o_orderpriority"), topic(1, "o_orderstatus")),
        entities=F.col("entities"),
        categories=F.array(category),
    )
    at = F.col("o_orderdate")
    return joined.select(
        at.alias("created_at"),
        at.alias("updated_at"),
        "feedly_id",
        payload.alias("payload"),
        F.lit(200).alias("status_code"),
        at.alias("status_at"),
        at.alias("parsed_at"),
    )


def organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    rows = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return conform(
        rows.select(
            F.concat(F.lit("org-"), F.col("s_suppkey")).alias("uuid"),
            F.col("s_name").alias("name"),
            F.concat(F.lit("supplier-"), F.col("s_suppkey")).alias("permalink"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("region"),
            F.concat_ws(",", "r_name", "n_name").alias("category_list"),
            F.when(F.col("s_acctbal") < 0, "").otherwise(F.col("r_name")).alias("category_groups_list"),
            F.col("s_acctbal").cast("decimal(18,0)").alias("total_funding"),
        ),
        S.REGISTER["organizations"],
    )


def category_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("name"),
        F.replace("p_name", F.lit(" "), F.lit("-")).alias("permalink"),
        F.concat_ws(",", "p_brand", "p_type").alias("category_groups_list"),
    )


def seeds(spark: SparkSession) -> dict[str, DataFrame]:
    """Default seeds, with icons, marks and concepts for the channels."""
    base = default_seeds(spark)
    icons = F.create_map(*[F.lit(x) for kv in CHANNEL_ICONS.items() for x in kv])
    marks = F.create_map(*[x for ch, at in CHANNEL_MARKS.items() for x in (F.lit(ch), moment(at))])
    channels = base["channels"].withColumns(
        {
            "emoji_icon": icons[F.col("id").cast("int")],
            "last_sent_at": marks[F.col("id").cast("int")],
        }
    )
    links = small_table(spark, "channel_id concept_id", list(CHANNEL_CONCEPTS))
    return {**base, "channels": channels, "channel_concepts": links}


def order_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Input of ``plans.views.build_views`` with orders as entries."""
    return {
        "feedly_entries": stored(spark, sf_dir, order_entries, bucketed=True),
        "feedly_entry_text_analyses": stored(spark, sf_dir, order_analyses, bucketed=True),
        "organizations": organizations(spark, sf_dir),
        "category_groups": category_groups(spark, sf_dir),
        **seeds(spark),
    }


def order_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as articles; orders are no copies of each other, so all stay."""
    return entry_details(parse_entries(stored(spark, sf_dir, order_entries, bucketed=True)))


def order_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_analyses(stored(spark, sf_dir, order_analyses, bucketed=True))


def line_mentions(spark: SparkSession, sf_dir: str, sectors: bool = True) -> DataFrame:
    """Supplier mentions of an order, with part type and brand as its sectors."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    mention = [
        F.col("o_orderkey").alias("feedly_id"),
        F.col("o_orderdate").alias("published_at"),
        F.col("s_name").alias("name"),
    ]
    if not sectors:
        return lines.select(*mention)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        *mention, F.col("p_type").alias("category"), F.col("p_brand").alias("category_group")
    )


def event_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("feedly_id"),
        F.col("ts").alias("published_at"),
        F.col("event_type").alias("topic_label"),
        F.col("value").alias("topic_score"),
    )
