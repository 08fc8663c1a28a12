"""Entries arriving as files: keyed upsert without rewriting the table.

Each micro-batch is reduced to one row per entry and written to a folder named
after the batch, so a replayed batch overwrites itself.  Ingest cost follows
the batch, not the table; readers fold the log, and :func:`compact` stores the
fold as the new base from time to time.  Within a batch, across batches and
against the base the same ``order`` decides, so the result does not depend on
how rows were cut into batches or which came first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from newsboard.operators.maintenance import latest_by_key
from newsboard.plans.storage import materialize

KEYS = ["feedly_id"]


def ingest_entries(
    stream: DataFrame, log: str, checkpoint: str, order: tuple[str, ...] = ("updated_at",)
) -> StreamingQuery:
    """Write the available entries of ``stream`` to the log, batch by batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = latest_by_key(batch, KEYS, order, ["created_at"])
        newest.write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_entries(
    spark: SparkSession,
    log: str,
    base: DataFrame | None = None,
    after: int = -1,
    order: tuple[str, ...] = ("updated_at",),
) -> DataFrame:
    """Entries as of the last batch: the log folded into ``base``.

    ``after`` is the last batch that ``base`` already holds.  Only rows of
    ``base`` whose entry occurs in the log are compared; the others pass through.
    """
    changes = spark.read.parquet(log).where(F.col("batch_id") > after).drop("batch_id")
    newest = latest_by_key(changes, KEYS, order, ["created_at"])
    if base is None:
        return newest
    old = base.select(*newest.columns)
    touched = old.join(newest.select(*KEYS), KEYS, "left_semi").select(*newest.columns)
    merged = latest_by_key(newest.unionByName(touched), KEYS, order, ["created_at"])
    return old.join(newest.select(*KEYS), KEYS, "left_anti").select(*newest.columns).unionByName(merged)


def compact(
    spark: SparkSession,
    log: str,
    path: str,
    base: DataFrame | None = None,
    after: int = -1,
    order: tuple[str, ...] = ("updated_at",),
) -> DataFrame:
    """Store the folded entries as the new version of the table at ``path``."""
    return materialize(current_entries(spark, log, base, after, order), path)
