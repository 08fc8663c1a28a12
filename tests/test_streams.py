import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import NOW, analysis_rows, entry_rows, rows, ts
from newsboard.operators.boards import board_of_days, leaderboard
from newsboard.operators.counting import period_counts, roll_up
from newsboard.operators.maintenance import upsert
from newsboard.sources.schemas import CHANNELS, REGISTER
from newsboard.sources.seeds import conform, default_seeds, small_table
from newsboard.streaming.counts import count_increments, daily_counts, day_table, fold_counts, windowed_counts
from newsboard.streaming.ingest import compact, current_entries, ingest_entries
from newsboard.plans.keyed import KeyedTable
from newsboard.sources.schemas import ANALYSES, ENTRIES
from newsboard.streaming.routing import arrivals, channel_state, deliver, deliver_analyses, sent_before, waiting_analyses

ENTRY = "created_at timestamp_ntz, updated_at timestamp_ntz, published_at timestamp_ntz, feedly_id string, payload string"
BASE = ts("2020-03-01")


def entry(day, key, payload):
    at = BASE + timedelta(days=day)
    return (at, at, at, key, payload)


BATCHES = [
    [entry(0, "a", "a0"), entry(1, "a", "a1"), entry(1, "b", "b1")],
    [entry(2, "a", "a2"), entry(2, "c", "c2")],
    [entry(3, "b", "b3"), entry(3, "d", "d3"), entry(4, "d", "d4")],
]


def land(spark, folder, batches, schema):
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{folder}/f{i}")


def stream(spark, folder, schema):
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)
    )


def test_ingest_equals_batch_upserts(spark, shared):
    land(spark, f"{shared}/in", BATCHES, ENTRY)
    log = f"{shared}/log"
    ingest_entries(stream(spark, f"{shared}/in", ENTRY), log, f"{shared}/cp").awaitTermination()
    got = current_entries(spark, log)
    want = spark.createDataFrame([], ENTRY)
    for batch in BATCHES:
        want = upsert(want, spark.createDataFrame(batch, ENTRY), ["feedly_id"])
    cols = ("feedly_id", "created_at", "updated_at", "payload")
    assert rows(got, *cols) == rows(want, *cols)
    assert spark.read.parquet(log).select("batch_id").distinct().count() == 3

    # A second run finds nothing new; a replay from the start overwrites the same folders.
    ingest_entries(stream(spark, f"{shared}/in", ENTRY), log, f"{shared}/cp").awaitTermination()
    assert rows(current_entries(spark, log), *cols) == rows(want, *cols)
    ingest_entries(stream(spark, f"{shared}/in", ENTRY), log, f"{shared}/cp2").awaitTermination()
    assert rows(current_entries(spark, log), *cols) == rows(want, *cols)

    base = compact(spark, log, f"{shared}/table")
    assert rows(base, *cols) == rows(want, *cols)
    assert rows(current_entries(spark, log, base, after=1), *cols) == rows(want, *cols)


def test_count_increments_lose_no_late_row(spark, shared):
    late = [*BATCHES[::-1], [entry(-60, "z", "a0"), entry(-60, "y", "a0")]]
    land(spark, f"{shared}/in", late, ENTRY)
    log = f"{shared}/counts"
    count_increments(stream(spark, f"{shared}/in", ENTRY), "payload", log, f"{shared}/cp").awaitTermination()
    everything = spark.createDataFrame([r for b in late for r in b], ENTRY)
    for grain in ("day", "week", "month"):
        got = roll_up(daily_counts(spark, log, "payload"), "payload", grain)
        assert rows(got) == rows(period_counts(everything, "payload", grain))


def test_windowed_counts(spark, shared):
    land(spark, f"{shared}/in", BATCHES, ENTRY)
    counts = windowed_counts(stream(spark, f"{shared}/in", ENTRY), "feedly_id", "1 day", key="payload")
    query = (
        counts.writeStream.format("memory").queryName("windowed").outputMode("complete")
        .option("checkpointLocation", f"{shared}/cp").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rows(spark.table("windowed").where("feedly_id = 'd'")) == [
        (BASE + timedelta(days=3), "d", 1), (BASE + timedelta(days=4), "d", 1)]


ROW = """channel_id long, channel_name string, channel_emoji_icon string, target string, target_id string,
    feedly_id string, title string, url string, author string, site string, image_url string,
    summary_sentences array<string>, company_names array<string>, topic_labels array<string>,
    categories array<string>, created_at timestamp_ntz, published_at timestamp_ntz,
    published_at_with_tz timestamp_ntz, last_sent_at timestamp_ntz"""


def routed_row(channel, key, day):
    at = BASE + timedelta(days=day)
    return (channel, f"C{channel}", None, "slack", "#c", key, "t", "u", None, None, None, None, None, ["x"], None, at, at, at, None)


def test_deliver_is_exactly_once(spark, shared):
    channels = conform(
        spark.createDataFrame([(1, BASE), (2, BASE + timedelta(days=2)), (3, None)], "id long, last_sent_at timestamp_ntz"), CHANNELS)
    batches = [
        [routed_row(1, "a", 1), routed_row(2, "b", 1), routed_row(3, "n", 9)],
        [routed_row(1, "late", 1), routed_row(1, "c", 2), routed_row(2, "d", 3)],
    ]
    land(spark, f"{shared}/in", batches, ROW)
    run = lambda cp: deliver(
        stream(spark, f"{shared}/in", ROW), channels, "slack", f"{shared}/sent", f"{shared}/state", f"{shared}/{cp}", NOW
    ).awaitTermination()
    want = [(1, "a"), (1, "c"), (1, "late"), (2, "d")]
    marks = [(1, BASE + timedelta(days=2)), (2, BASE + timedelta(days=3)), (3, None)]
    for cp in ("cp", "cp", "cp2"):  # first run, nothing new, replay of both batches
        run(cp)
        assert rows(spark.read.parquet(f"{shared}/sent"), "channel_id", "feedly_id") == want
        assert rows(channel_state(spark, channels, f"{shared}/state"), "id", "last_sent_at") == marks


def test_a_batch_reads_the_buckets_of_its_rows_only(spark, shared):
    channels = conform(spark.createDataFrame([(1, BASE)], "id long, last_sent_at timestamp_ntz"), CHANNELS)
    batches = [[routed_row(1, f"a{n}-{i}", 1) for i in range(30)] for n in range(3)] + [[routed_row(1, "a0-0", 1), routed_row(1, "new", 2)]]
    land(spark, f"{shared}/in", batches, ROW)
    deliver(
        stream(spark, f"{shared}/in", ROW), channels, "slack", f"{shared}/sent", f"{shared}/state", f"{shared}/cp", NOW, buckets=16
    ).awaitTermination()
    assert spark.read.parquet(f"{shared}/sent").count() == 91  # a0-0 was sent before
    everything = sent_before(spark, f"{shared}/sent", range(16), 3).inputFiles()
    one = sent_before(spark, f"{shared}/sent", [5], 3).inputFiles()
    assert 0 < len(one) <= 4 and len(everything) > 20 and all("/bucket=5/" in f for f in one)
    assert sent_before(spark, f"{shared}/none", [5], 3) is None


def article(key):
    return {"id": key, "title": f"Title {key}", "alternate": [{"href": f"https://{key}.example.com/"}]}


def analysis(at):
    team = {"type": ["SportsTeam"], "entityId": "E", "entityEnglishId": "E", "relevanceScore": 0.9, "confidenceScore": 9}
    return {"topics": [{"id": 0, "label": "Machine learning", "score": 0.9}], "entities": [team], "cleanedText": at}


def routing_tables(spark):
    seeds = default_seeds(spark)
    seeds["channels"] = seeds["channels"].withColumn("last_sent_at", F.lit(BASE).cast("timestamp_ntz"))
    links = small_table(spark, "channel_id concept_id", [(1, 12), (2, 12)])
    return {**seeds, "channel_concepts": links, "organizations": spark.createDataFrame([], REGISTER["organizations"])}


@pytest.mark.parametrize("order", [[(["a", "b"], []), (["c"], ["a"]), ([], ["c", "z"]), (["z"], []), ([], ["b"])]])
def test_analyses_and_entries_in_either_order(spark, shared, order):
    """Each step is a run: analyses first, entries first, entries alone."""
    table = KeyedTable(spark, f"{shared}/entries", ["feedly_id"], ENTRIES, 4)
    done, sent = set(), []
    seen = ([], [])
    for n, (analysed, entered) in enumerate(order):
        if analysed:
            analysis_rows(spark, {k: analysis(k) for k in analysed}).coalesce(1).write.mode("append").parquet(f"{shared}/analyses")
        if entered:
            entry_rows(spark, [article(k) for k in entered]).coalesce(1).write.mode("append").parquet(f"{shared}/arrived")
        if n == 0:
            spark.createDataFrame([], ENTRIES).coalesce(1).write.mode("append").parquet(f"{shared}/arrived")
        read = lambda name, schema: spark.readStream.schema(schema).parquet(f"{shared}/{name}")
        deliver_analyses(
            arrivals(read("analyses", ANALYSES), read("arrived", ENTRIES)), table, routing_tables(spark), "slack",
            f"{shared}/sent", f"{shared}/state", f"{shared}/cp", NOW, f"{shared}/waiting",
        ).awaitTermination()
        seen[0].extend(analysed)
        seen[1].extend(entered)
        done = set(seen[0]) & set(seen[1])
        sent = spark.read.parquet(f"{shared}/sent") if done else None
        assert {r["feedly_id"] for r in sent.collect()} == done if done else True
        assert {r["feedly_id"] for r in waiting_analyses(spark, f"{shared}/waiting", ANALYSES).collect()} == set(seen[0]) - done
    assert done == {"a", "b", "c", "z"} and sent.count() == 8
    assert rows(table.read(), "feedly_id") == [("a",), ("b",), ("c",), ("z",)]


def test_a_stream_of_entries_needs_a_table(spark, shared):
    frame = spark.createDataFrame([], ENTRIES)
    both = arrivals(spark.createDataFrame([], ANALYSES), frame)
    with pytest.raises(TypeError):
        deliver_analyses(both, frame, {"channels": frame}, "slack", "s", "t", "c", NOW, "w")


def test_folded_days_give_the_boards_and_count_a_batch_once(spark, shared):
    late = [*BATCHES, [entry(-60, "z", "a0"), entry(-60, "y", "a0"), entry(1.95, "x", "a1"), entry(1.95, "v", "a1")]]
    land(spark, f"{shared}/in", late, ENTRY)
    table = day_table(spark, f"{shared}/days", ["payload"], buckets=8)
    for cp in ("cp", "cp", "cp2"):  # first run, nothing new, replay of all batches
        fold_counts(stream(spark, f"{shared}/in", ENTRY), table, ["payload"], f"{shared}/{cp}", "-05:00").awaitTermination()
    assert table.done("stream") == 3 and table.read().groupBy("time_period", "payload").count().where("count > 1").isEmpty()
    everything = spark.createDataFrame([r for b in late for r in b], ENTRY)
    for grain in ("day", "week", "month"):
        got, want = board_of_days(table.read(), "payload", grain), leaderboard(everything, "payload", grain, "-05:00")
        assert rows(got) == rows(want) and got.columns == want.columns
    before = table.folders()
    fold_counts(stream(spark, f"{shared}/in", ENTRY), table, ["payload"], f"{shared}/cp3", "-05:00", "other").awaitTermination()
    assert table.read().agg(F.sum("count")).first()[0] == 2 * everything.count() and set(before) == set(table.folders())
