"""Counts per label and per period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from newsboard.functions.time import bucket


def count_by(
    df: DataFrame, keys: Sequence[str], col: str, min_freq: int = 2, name: str = "freq"
) -> DataFrame:
    """Non-NULL count of ``col`` per key, from ``min_freq`` upwards."""
    counts = df.groupBy(*keys).agg(F.count(col).alias(name))
    return counts.where(F.col(name) >= min_freq) if min_freq > 0 else counts


def period_counts(
    df: DataFrame,
    label: str,
    grain: str,
    ts: str = "published_at",
    key: str = "feedly_id",
    min_freq: int = 2,
) -> DataFrame:
    """Rows per period and label, without a zone shift."""
    periods = df.select(bucket(F.col(ts), grain).alias("time_period"), label, key)
    return count_by(periods, ["time_period", label], key, min_freq, "count").select(
        F.lit(grain).alias("time_period_label"), "time_period", label, "count"
    )


def day_counts(
    df: DataFrame, labels: Sequence[str], zone: str | None = None, ts: str = "published_at", key: str = "feedly_id"
) -> DataFrame:
    """Rows per day, of a zone if one is given, and labels, from 1 upwards: the
    partials that week and month counts and boards add up.  Rows without a time
    belong to no day."""
    day = bucket(F.col(ts), "day", zone) if zone else bucket(F.col(ts), "day")
    days = df.dropna(subset=[ts]).select(day.alias("time_period"), *labels, key)
    return count_by(days, ["time_period", *labels], key, 1, "count")


def add_up(counts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Partials of the same day and labels as one row."""
    return counts.groupBy("time_period", *labels).agg(F.sum("count").alias("count"))


def roll_up(daily: DataFrame, label: str, grain: str, min_freq: int = 2) -> DataFrame:
    """Day counts (kept from 1 upwards) to week or month counts."""
    return (
        daily.groupBy(bucket(F.col("time_period"), grain).alias("time_period"), label)
        .agg(F.sum("count").alias("count"))
        .where(F.col("count") >= min_freq)
        .select(F.lit(grain).alias("time_period_label"), "time_period", label, "count")
    )
