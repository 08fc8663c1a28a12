"""Routing streams: send what was not sent before, then move the marks.

Every batch writes its messages and the marks after it to folders named after
the batch.  A replayed batch starts from the folders before it and writes the
same rows again.  Whether an article was sent is looked up in the log of what
was sent, by channel and article: late articles and articles of the same time
are neither skipped nor sent twice.  The marks that the channels had when the
stream began tell what was sent before it.

The log of what was sent lies in hash buckets of channel and article, and a
batch reads the buckets of its own rows only.  An article needs its entry and
its analysis, which come in either order: an analysis without an entry waits in
a folder that every batch writes anew, and is routed with the batch that finds
the entry.

What a batch needs more than once it writes to a folder of its own, dealt by the
article: documents are shuffled once and parsed once, and no task holds more of
them than its part.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from newsboard.operators import analysis as N
from newsboard.operators import sectors as S
from newsboard.operators.articles import entry_details
from newsboard.operators.joins import spread_join
from newsboard.operators.maintenance import latest_by_key
from newsboard.operators.ranking import dedupe_by_rank
from newsboard.operators.routing import (
    advance_watermarks, channel_details, outbox, recent_articles, route_ids, unsent,
)
from newsboard.plans.keyed import KeyedTable
from newsboard.plans.storage import delete, list_names, shared_dir
from newsboard.sources.feed import parse_analyses, parse_entries

_MARKS = "id bigint, last_sent_at timestamp_ntz"
_SENT = ["channel_id", "feedly_id"]
#: What messages show of an article.
_ARTICLE = [
    "feedly_id", "title", "site", "author", "url", "image_url", "engagement_rate", "engagement", "created_at",
    "updated_at", "published_at", "sentences",
]
#: Buckets of the log of what was sent.
SENT_BUCKETS = 64


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def channel_state(spark: SparkSession, channels: DataFrame, log: str, before: int | None = None) -> DataFrame:
    """Channels with the marks left by the newest batch (``before`` a batch).

    Every batch holds the marks of all channels, so one folder is read.
    """
    if before is None:
        batches = _read(spark, log, f"{_MARKS}, batch_id int")
        newest = batches.agg(F.max("batch_id")).first()[0] if batches is not None else None
    else:
        newest = before - 1 if before > 0 else None
    marks = None if newest is None else _read(spark, f"{log}/batch_id={newest}", _MARKS)
    if marks is None:
        return channels
    marked = channels.join(marks.withColumnRenamed("last_sent_at", "_mark"), "id", "left")
    return marked.withColumn("last_sent_at", F.coalesce("_mark", "last_sent_at")).select(*channels.columns)


def _sent_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*_SENT), F.lit(buckets)).cast("int")


def sent_before(spark: SparkSession, log: str, buckets: Sequence[int], batch_id: int) -> DataFrame | None:
    """(channel_id, feedly_id) of the log in some of its buckets, as far as
    batches before ``batch_id`` wrote them; other buckets are not even listed."""
    there = set(list_names(spark, log))
    paths = [f"{log}/bucket={b}" for b in buckets if f"bucket={b}" in there]
    if not paths:
        return None
    rows = spark.read.schema("channel_id bigint, feedly_id string, bucket int, batch_id int").option("basePath", log)
    return rows.parquet(*paths).where(F.col("batch_id") < batch_id).select(*_SENT)


def _clear_batch(spark: SparkSession, log: str, batch_id: int) -> None:
    """Remove what an earlier attempt of a batch has left in the log."""
    for bucket in list_names(spark, log):
        delete(spark, f"{log}/{bucket}/batch_id={batch_id}")


def _deliver(
    stream: DataFrame,
    rows_of: Callable[[DataFrame, int, list[KeyedTable]], DataFrame],
    channels: DataFrame,
    target: str,
    sent_log: str,
    state_log: str,
    checkpoint: str,
    now: datetime,
    seed: int,
    buckets: int,
) -> StreamingQuery:
    spark = stream.sparkSession
    bucket = _sent_bucket(buckets)

    def send(batch: DataFrame, batch_id: int) -> None:
        _clear_batch(spark, sent_log, batch_id)
        held: list[KeyedTable] = []  # written for the batch
        rows = None
        try:
            rows = rows_of(batch, batch_id, held).where(F.col("target") == target)
            rows = dedupe_by_rank(rows, _SENT, [F.col("created_at").asc_nulls_last()]).persist()
            touched = [r[0] for r in rows.select(bucket).distinct().collect()]  # at most ``buckets``
            earlier = sent_before(spark, sent_log, touched, batch_id)
            fresh = rows if earlier is None else rows.join(earlier, _SENT, "left_anti")
            messages = outbox(fresh, target, now, seed).withColumns({"bucket": bucket, "batch_id": F.lit(batch_id)})
            dealt = messages.repartition("bucket") if touched else messages
            dealt.write.mode("append").partitionBy("bucket", "batch_id").parquet(sent_log)
        finally:
            if rows is not None:
                rows.unpersist()
            for table in held:
                table.drop()
        # Read back what was written, so that marks and messages agree.
        written = _batch_of(spark, sent_log, batch_id, touched)
        state = channel_state(spark, channels, state_log, before=batch_id)
        moved = state if written is None else advance_watermarks(state, written)
        moved.select("id", "last_sent_at").write.mode("overwrite").parquet(f"{state_log}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(send)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _batch_of(spark: SparkSession, log: str, batch_id: int, buckets: Sequence[int]) -> DataFrame | None:
    name = f"batch_id={batch_id}"
    paths = [p for b in buckets if name in list_names(spark, p := f"{log}/bucket={b}")]
    schema = "channel_id bigint, feedly_id string, created_at timestamp_ntz"
    return spark.read.schema(schema).parquet(*[f"{p}/{name}" for p in paths]) if paths else None


def deliver(
    stream: DataFrame,
    channels: DataFrame,
    target: str,
    sent_log: str,
    state_log: str,
    checkpoint: str,
    now: datetime,
    seed: int = 0,
    buckets: int = SENT_BUCKETS,
) -> StreamingQuery:
    """Send the unsent rows of a stream of channel articles.

    The stream has the columns of ``operators.routing.unsent``; its
    ``last_sent_at`` is replaced by the mark of the channel in ``channels``.
    ``buckets`` of the log must stay what they were when the log began.
    """
    marks = channels.select(F.col("id").alias("channel_id"), "last_sent_at")

    def newer(batch: DataFrame, batch_id: int, held: list[KeyedTable]) -> DataFrame:
        marked = spread_join(batch.drop("last_sent_at"), marks, ["channel_id"])
        return marked.where(F.col("created_at") > F.col("last_sent_at"))

    return _deliver(stream, newer, channels, target, sent_log, state_log, checkpoint, now, seed, buckets)


def waiting_analyses(spark: SparkSession, waiting: str, schema, before: int | None = None) -> DataFrame:
    """Analyses whose entry had not come when the newest batch (``before`` a
    batch) was through."""
    numbers = [int(n.partition("=")[2]) for n in list_names(spark, waiting)]
    known = [n for n in numbers if before is None or n < before]
    return spark.read.schema(schema).parquet(f"{waiting}/batch_id={max(known)}") if known else spark.createDataFrame([], schema)


def arrivals(analyses: DataFrame, entries: DataFrame) -> DataFrame:
    """One stream of two: analyses, and entries, which wake those that wait."""
    as_row = lambda df, kind: df.select(F.lit(kind).alias("arrived"), F.struct(*df.columns).alias(kind))
    return as_row(analyses, "analysis").unionByName(as_row(entries, "entry"), allowMissingColumns=True)


def deliver_analyses(
    stream: DataFrame,
    entries: DataFrame | KeyedTable,
    tables: Mapping[str, DataFrame],
    target: str,
    sent_log: str,
    state_log: str,
    checkpoint: str,
    now: datetime,
    waiting: str,
    seed: int = 0,
    buckets: int = SENT_BUCKETS,
    order: Sequence[str] = ("updated_at",),
    parts: int | None = None,
) -> StreamingQuery:
    """Route a stream of text analyses by the rules and send what matches.

    An article is routed when both its entry and its analysis are there, in
    whichever order they come.  Analyses without an entry wait in the folder
    ``waiting``: a batch reads what waited after the batch before it and writes
    what still waits, so it is repeated like the logs, and the folder before
    the last one is deleted.  What waits costs a batch its ids' lookup only.

    ``entries`` is the entry table.  As a :class:`KeyedTable` it is read in its
    newest version by each batch, and only in the buckets of the ids that the
    batch looks for.  With ``stream`` from :func:`arrivals` the entries of a
    batch are stored in that table first (newest by ``order``), so entries
    release analyses without a batch of analyses.  A DataFrame of files is what
    it was when it was made.

    ``tables`` holds organizations, concept_entity_rules, concepts,
    channel_concepts and channels.  Of analyses of one id in a batch the newest
    is routed, and one without an id is left out.  Analyses of articles that
    are older than all marks are not parsed.

    A batch is dealt into ``parts`` buckets, which a task should hold in memory;
    as many as the entry table has, if it is dealt, or else as a shuffle has.
    """
    spark, channels = stream.sparkSession, tables["channels"]
    both = "arrived" in stream.columns
    if parts is None:
        dealt = isinstance(entries, KeyedTable) and entries.dealt
        parts = entries.buckets if dealt else int(spark.conf.get("spark.sql.shuffle.partitions"))
    if both and not isinstance(entries, KeyedTable):
        raise TypeError("a stream of entries needs a KeyedTable to store them in")
    schema = stream.schema["analysis"].dataType if both else stream.schema

    def entries_of(ids: DataFrame) -> DataFrame:
        if isinstance(entries, KeyedTable):
            return entries.matching(ids)
        return entries.join(ids, "feedly_id", "left_semi").select(*entries.columns)

    def routed(batch: DataFrame, batch_id: int, held: list[KeyedTable]) -> DataFrame:
        def written(name: str, rows: DataFrame) -> DataFrame:
            table = KeyedTable(spark, shared_dir(spark, name), ["feedly_id"], rows.schema, parts, dealt=True)
            held.append(table)
            table.change(range(parts), lambda _: rows)
            return table.read()

        if both:
            arrived = batch.where("arrived = 'entry'").select("entry.*")
            entries.upsert(arrived, order, ["created_at"])
            batch = batch.where("arrived = 'analysis'").select("analysis.*")
        due = batch.unionByName(waiting_analyses(spark, waiting, schema, batch_id)).dropna(subset=["feedly_id"])
        by = [c for c in order if c in due.columns]
        due = written("due", latest_by_key(due.repartition(parts, "feedly_id"), ["feedly_id"], by))
        known = entries_of(due.select("feedly_id"))
        folder = f"{waiting}/batch_id={batch_id}"
        due.join(known.select("feedly_id"), "feedly_id", "left_anti").select(*due.columns).write.mode("overwrite").parquet(folder)
        for name in list_names(spark, waiting):  # a replay needs the one before it
            if int(name.partition("=")[2]) < batch_id - 1:
                delete(spark, f"{waiting}/{name}")
        # Each of these is read by several steps, and their joins and groups would
        # otherwise all hold memory in the tasks of one stage.
        articles = written("articles", entry_details(parse_entries(recent_articles(known, channels))).select(*_ARTICLE))
        parsed = parse_analyses(due.join(articles.select("feedly_id"), "feedly_id", "left_semi"))
        parsed = written("parsed", parsed.select("feedly_id", "topics", "entities"))
        topics = written("topics", N.analysis_topics(articles, parsed))
        entities = written("entities", N.analysis_entities(articles, parsed))
        companies = written("companies", N.resolve_companies(entities, tables["organizations"]))
        ids = route_ids(
            entities, N.subject_topics(topics, distinct_topics=True), tables["concept_entity_rules"],
            tables["concepts"], tables["channel_concepts"], channels,
        )
        return unsent(articles, channel_details(ids, S.article_sectors(topics, companies), articles), channels)

    return _deliver(stream, routed, channels, target, sent_log, state_log, checkpoint, now, seed, buckets)
