"""Counts per day and label over a stream.

:func:`count_increments` keeps no state and loses no late row: each batch adds
its own day counts, and a day's total is the sum over batches.
:func:`windowed_counts` is the stateful form with a watermark, for sinks that
need closed days; rows later than the delay are not counted there.
:func:`fold_counts` keeps one total per day and label: a batch reads and writes
the days that it has rows of, and readers add up nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from newsboard.operators.counting import add_up, day_counts, period_counts
from newsboard.plans.keyed import KeyedTable


def count_increments(
    stream: DataFrame,
    label: str,
    log: str,
    checkpoint: str,
    ts: str = "published_at",
    key: str = "feedly_id",
) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        counts = period_counts(batch, label, "day", ts, key, min_freq=1)
        counts.write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def daily_counts(spark: SparkSession, log: str, label: str) -> DataFrame:
    """Day counts over all batches; ``operators.counting.roll_up`` takes these."""
    return (
        spark.read.parquet(log)
        .groupBy("time_period", label)
        .agg(F.sum("count").alias("count"))
    )


def day_table(
    spark: SparkSession, path: str, labels: Sequence[str], id_type: str = "string", buckets: int = 64
) -> KeyedTable:
    """A table of day counts for :func:`fold_counts`; a day lies in one bucket."""
    columns = ", ".join(f"{c} {id_type}" for c in labels)
    return KeyedTable(spark, path, ["time_period"], f"time_period timestamp_ntz, {columns}, count bigint", buckets)


def fold_counts(
    stream: DataFrame,
    table: KeyedTable,
    labels: Sequence[str],
    checkpoint: str,
    zone: str | None = None,
    series: str = "stream",
    ts: str = "published_at",
    key: str = "feedly_id",
) -> StreamingQuery:
    """Add the rows of a stream to the day counts in ``table``.

    The number of the batch is stored with the totals, so a replayed batch adds
    nothing; streams that feed one table need a ``series`` each.  A late row
    changes its day, however old.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        counts = day_counts(batch, labels, zone, ts, key).select(*table.schema.names).persist()
        try:
            add = lambda old: add_up(old.unionByName(counts), labels)
            table.change(table.touched(counts), add, (series, batch_id))
        finally:
            counts.unpersist()

    return (
        stream.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def windowed_counts(
    stream: DataFrame,
    label: str,
    delay: str = "7 days",
    ts: str = "published_at",
    key: str = "feedly_id",
) -> DataFrame:
    """Streaming frame of day counts, final once the watermark passed the day."""
    # A watermark needs an instant: the stored UTC wall time becomes one, and the
    # window start turns back, whatever the session's zone.
    zone = F.current_timezone()
    instant = F.from_utc_timestamp(F.col(ts).cast("timestamp"), zone)
    timed = stream.withColumn(ts, instant).withWatermark(ts, delay)
    start = F.to_utc_timestamp(F.col("w.start"), zone).cast("timestamp_ntz")
    return (
        timed.groupBy(F.window(ts, "1 day").alias("w"), label)
        .agg(F.count(key).alias("count"))
        .select(start.alias("time_period"), label, "count")
    )
