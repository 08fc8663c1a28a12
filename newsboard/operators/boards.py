"""Ranked leaderboards per day, week or month."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from newsboard.functions.captions import BOARD_TITLES, rank_line
from newsboard.functions.text import histogram, ratio
from newsboard.functions.time import (
    BOARD_ZONE, CALENDAR_ZONE, bucket, in_period, moment, resolve_period,
)
from newsboard.operators.counting import count_by
from newsboard.operators.ranking import rank_within, top_k

TOPIC_MIN_SCORE = 0.35


def leaderboard(
    mentions: DataFrame,
    by: str,
    grain: str,
    zone: str = BOARD_ZONE,
    within: str | None = None,
    min_freq: int = 2,
    score: str | None = None,
    min_score: float = TOPIC_MIN_SCORE,
    ts: str = "published_at",
    key: str = "feedly_id",
) -> DataFrame:
    """Names ranked by mentions in each period (and in each ``within`` value).

    Adds the dense rank, the largest and smallest count of the period, the
    share of the largest and a text bar.  Rows without a time or a ``within``
    value belong to no board and are left out.
    """
    if score is not None:
        mentions = mentions.where(F.col(score) >= min_score)
    extra = [within] if within else []
    # Publishing time and category are never NULL in the data model, so plain
    # equality is enough to join the ranks back.
    rows = mentions.dropna(subset=[ts, *extra]).select(
        bucket(F.col(ts), grain, zone).alias("time_period"), *extra, by, key
    )
    counts = count_by(rows, ["time_period", *extra, by], key, min_freq)
    return _board(counts, by, grain, extra)


def board_of_days(
    daily: DataFrame, by: str, grain: str, within: str | None = None, min_freq: int = 2
) -> DataFrame:
    """:func:`leaderboard` from stored day counts (``counting.day_counts`` in
    the zone of the board): weeks and months add up their days, so no mention is
    read again."""
    extra = [within] if within else []
    rows = daily.dropna(subset=extra) if extra else daily
    period = bucket(F.col("time_period"), grain).alias("time_period")
    counts = rows.groupBy(period, *extra, by).agg(F.sum("count").alias("freq")).where(F.col("freq") >= min_freq)
    return _board(counts, by, grain, extra)


def _board(counts: DataFrame, by: str, grain: str, extra: list[str]) -> DataFrame:
    ranked = rank_within(counts, ["time_period", *extra], "freq")
    return ranked.select(
        F.lit(grain).alias("time_period_label"),
        "time_period",
        *extra,
        by,
        "freq",
        "rank",
        "max_freq",
        "min_freq",
        ratio(F.col("freq"), F.col("max_freq")).alias("pct"),
        histogram(F.col("freq"), F.col("max_freq")).alias("histogram"),
    )


def ordered_board(board: DataFrame, by: str, within: str | None = None) -> DataFrame:
    """A board in its final order: newest period first, then by rank and name."""
    extra = [F.col(within).asc_nulls_last()] if within else []
    return board.orderBy(F.col("time_period").desc(), *extra, F.col("rank").asc(), F.col(by).asc_nulls_last())


def top_of_period(
    board: DataFrame,
    by: str,
    period: str,
    as_of: datetime,
    k: int = 10,
    zone: str = CALENDAR_ZONE,
) -> DataFrame:
    """First ``k`` lines of a stored board for a named period, ties by name."""
    grain, start = resolve_period(period, as_of, zone)
    rows = board.where(
        (F.col("time_period_label") == grain) & (F.col("time_period") == moment(start))
    )
    top = top_k(rows, [F.col("rank").asc(), F.col(by).asc_nulls_last()], k)
    return top.withColumn("line", rank_line(F.col("rank"), F.col(by), F.col("freq")))


def top_mentions(
    mentions: DataFrame,
    by: str,
    period: str,
    as_of: datetime,
    k: int = 10,
    zone: str = BOARD_ZONE,
    calendar: str = CALENDAR_ZONE,
    ts: str = "published_at",
    **board_options,
) -> DataFrame:
    """:func:`top_of_period` straight from mentions, reading only that period."""
    grain, start = resolve_period(period, as_of, calendar)
    rows = mentions.where(in_period(F.col(ts), grain, start, zone))
    board = leaderboard(rows, by, grain, zone, ts=ts, **board_options)
    return top_of_period(board, by, period, as_of, k, calendar)


def board_title(subject: str, period: str, as_of: datetime, zone: str = CALENDAR_ZONE) -> tuple[str, str]:
    """Title and date line of a board message, for the caller to post."""
    grain, start = resolve_period(period, as_of, zone)
    word = grain.title()
    return f"{BOARD_TITLES[subject]} by {word}*", f"*{word}*: {start.strftime('%b %d, %Y')}"
