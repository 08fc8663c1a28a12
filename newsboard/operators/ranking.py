"""Ranking, top rows and numbering that hold up when one group is huge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsboard.operators.joins import spread_join


def dedupe_by_rank(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key by ``order``.

    Spark turns the rank filter into a group limit before the shuffle, so each
    task sends at most one row per key, whatever the size of the group.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def rank_levels(df: DataFrame, scope: Sequence[str], value: str) -> DataFrame:
    """Distinct values per scope with dense rank (descending), top and bottom value.

    The window runs over distinct values, not rows.  For counts that bounds a
    scope: d distinct counts need at least d*(d+1)/2 counted rows, so even 10^12
    mentions in one period leave under 1.5 million levels.
    """
    levels = df.select(*scope, value).distinct()
    by_scope = Window.partitionBy(*scope)
    return levels.select(
        *scope,
        value,
        F.dense_rank().over(by_scope.orderBy(F.col(value).desc_nulls_first())).alias("rank"),
        F.max(value).over(by_scope).alias(f"max_{value}"),
        F.min(value).over(by_scope).alias(f"min_{value}"),
    )


def rank_within(df: DataFrame, scope: Sequence[str], value: str) -> DataFrame:
    """Dense rank, top and bottom of ``value`` for every row of its scope.

    Ranks are worked out on distinct values and joined back, so rows of one
    scope never meet in a single task; a value that most rows have is split by
    adaptive execution.
    """
    return spread_join(df, rank_levels(df, scope, value), [*scope, value])


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows; the last key of ``order`` should be unique."""
    return df.orderBy(*order).limit(k)


def number_rows(df: DataFrame, order: Sequence[str], name: str = "rn") -> DataFrame:
    """Consecutive numbers from 1 over the whole table, without one big window.

    Rows are range-partitioned on ``order`` and sorted, and each range starts
    after the number of rows in the ranges before it.  The ranged rows are
    checkpointed first: the range bounds come from a sample, and a range that
    was computed anew after an executor loss could otherwise cut elsewhere.
    Needs a checkpoint directory (see ``plans.storage.ensure_checkpoint_dir``).
    """
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .checkpoint()
        # The id holds the partition in its upper 31 bits and counts below.
        .withColumn("_part", F.shiftright("_id", 33))
        .withColumn("_pos", F.col("_id").bitwiseAND((1 << 33) - 1))
    )
    # One row per partition: a window over all of them is a few thousand rows.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    return (
        # As many rows as partitions, so the numbered rows need not move again.
        ranged.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_pos") + 1)
        .drop("_part", "_pos", "_id", "_start")
    )
