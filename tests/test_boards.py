from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import plan_of, rows, ts
from newsboard.operators.boards import board_title, leaderboard, top_mentions, top_of_period

SCHEMA = "feedly_id long, name string, published_at timestamp_ntz, category string, score double"


def mentions(spark, counts, at="2020-03-18T12:00:00", category="c", score=1.0):
    data = [(i, n, ts(at), category, score) for n, k in counts.items() for i in range(k)]
    return spark.createDataFrame(data, SCHEMA)


def test_board(spark):
    board = leaderboard(mentions(spark, {"a": 4, "b": 4, "c": 2, "d": 1}), "name", "day")
    assert rows(board) == [
        ("day", ts("2020-03-18"), "a", 4, 1, 4, 2, 1.0, "#" * 20),
        ("day", ts("2020-03-18"), "b", 4, 1, 4, 2, 1.0, "#" * 20),
        ("day", ts("2020-03-18"), "c", 2, 2, 4, 2, 0.5, "#" * 10),
    ]


def test_board_zone_score_and_scope(spark):
    early = mentions(spark, {"a": 2}, "2020-07-01T03:00:00")
    assert rows(leaderboard(early, "name", "day"), "time_period") == [(ts("2020-06-30"),)]
    assert rows(leaderboard(early, "name", "month"), "time_period") == [(ts("2020-06-01"),)]
    weak = mentions(spark, {"a": 2}).unionByName(mentions(spark, {"b": 3}, score=0.2))
    assert rows(leaderboard(weak, "name", "day", score="score"), "name") == [("a",)]
    two = mentions(spark, {"a": 2, "b": 5}).unionByName(mentions(spark, {"a": 3}, category="k"))
    assert rows(leaderboard(two, "name", "day", within="category"), "category", "name", "rank", "max_freq") == [
        ("c", "a", 2, 5), ("c", "b", 1, 5), ("k", "a", 1, 3),
    ]


def test_board_keeps_a_null_name(spark):
    assert rows(leaderboard(mentions(spark, {None: 2}), "name", "day"), "name", "freq") == [(None, 2)]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.sampled_from("abcdefgh")), min_size=1, max_size=80))
def test_board_properties(spark, draws):
    data = [(i, n, ts("2020-03-16T12:00:00") + timedelta(days=d), "c", 1.0) for i, (d, n) in enumerate(draws)]
    board = leaderboard(spark.createDataFrame(data, SCHEMA), "name", "day").collect()
    for period in {r["time_period"] for r in board}:
        lines = [r for r in board if r["time_period"] == period]
        freqs = sorted({r["freq"] for r in lines}, reverse=True)
        for r in lines:
            assert r["rank"] == freqs.index(r["freq"]) + 1
            assert (r["max_freq"], r["min_freq"]) == (freqs[0], freqs[-1])
            assert len(r["histogram"]) == (40 * r["freq"] + freqs[0]) // (2 * freqs[0])
        assert max(r["pct"] for r in lines) == 1.0


def test_ranks_run_over_distinct_counts_and_share_the_count_shuffle(spark):
    board = leaderboard(mentions(spark, {"a": 4, "b": 2}), "name", "day")
    board.collect()
    plan = plan_of(board)
    assert "ReusedExchange" in plan and "CartesianProduct" not in plan


def test_top_of_period(spark):
    rows_in = mentions(spark, {"b": 3, "a": 3, "c": 2}).unionByName(mentions(spark, {"z": 9}, "2020-03-09T12:00:00"))
    as_of = ts("2020-03-18T15:00:00")
    board = leaderboard(rows_in, "name", "week")
    for top in (top_of_period(board, "name", "week", as_of, 2), top_mentions(rows_in, "name", "week", as_of, 2)):
        assert [r["line"] for r in top.collect()] == [" 1 | *a* (3)", " 1 | *b* (3)"]
    assert [r["name"] for r in top_mentions(rows_in, "name", "last-week", as_of).collect()] == ["z"]
    assert board_title("companies", "last-week", as_of) == (
        ":100: *Top Mentioned Companies in XR by Week*", "*Week*: Mar 09, 2020"
    )


def test_top_mentions_pushes_the_period_to_the_scan(spark, shared):
    mentions(spark, {"a": 2}).write.parquet(f"{shared}/mentions")
    top = top_mentions(spark.read.parquet(f"{shared}/mentions"), "name", "month", ts("2020-03-18T15:00:00"))
    plan = top._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(published_at,2020-03-01T05:00)" in plan
    assert "LessThan(published_at,2020-04-01T05:00)" in plan


def test_unknown_period(spark):
    with pytest.raises(ValueError):
        top_mentions(mentions(spark, {"a": 2}), "name", "decade", ts("2020-03-18"))
