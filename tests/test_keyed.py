import threading
from datetime import timedelta

from helpers import rows, ts
from newsboard.plans.keyed import KeyedTable
from newsboard.plans.storage import current, list_names, materialize, publish, read_text

SCHEMA = "feedly_id string, created_at timestamp_ntz, updated_at timestamp_ntz, payload string"
BASE = ts("2020-03-01")


def batch(spark, *items):
    """Rows from (key, day, payload)."""
    at = lambda day: BASE + timedelta(days=day)
    return spark.createDataFrame([(k, at(d), at(d), p) for k, d, p in items], SCHEMA)


def entries(spark, path, buckets=8):
    return KeyedTable(spark, path, ["feedly_id"], SCHEMA, buckets)


def upsert(table, df):
    table.upsert(df, ("updated_at",), ("created_at",))


def test_upsert_writes_only_the_buckets_it_touches(spark, shared):
    table = entries(spark, f"{shared}/t")
    assert table.read().count() == 0 and table.folders() == {}
    upsert(table, batch(spark, *[(f"k{i}", 1, "one") for i in range(60)]))
    before = table.folders()
    assert set(before) == set(range(8))
    change = batch(spark, ("k3", 2, "two"), ("k3", 0, "late"))
    touched = table.touched(change)
    assert len(touched) == 1
    upsert(table, change)
    after = table.folders()
    assert {b for b in before if before[b] != after[b]} == set(touched)
    assert rows(table.matching(change), "feedly_id", "created_at", "payload") == [("k3", BASE, "two")]
    files = {f.rpartition("/")[0] for f in table.matching(change).inputFiles()}
    assert len(files) == 1 and files.pop().endswith(after[touched[0]])
    assert table.read().count() == 60
    again = entries(spark, f"{shared}/t", buckets=99)  # the number of buckets is stored
    assert again.buckets == 8 and rows(again.read()) == rows(table.read())


def test_order_of_batches_and_repeats_do_not_matter(spark, shared):
    batches = [batch(spark, ("a", 1, "a1"), (None, 1, "n1")), batch(spark, ("a", 3, "a3"), ("b", 2, "b2")), batch(spark, ("a", 2, "a2"), (None, 5, "n5"))]
    for name, order in (("x", (0, 1, 2)), ("y", (2, 1, 0)), ("z", (1, 0, 2, 0, 1))):
        table = entries(spark, f"{shared}/{name}", 4)
        for k in order:
            upsert(table, batches[k])
        assert rows(table.read(), "feedly_id", "created_at", "payload") == [
            ("a", BASE + timedelta(days=1), "a3"), ("b", BASE + timedelta(days=2), "b2")]


def test_replace_and_vacuum(spark, shared):
    table = entries(spark, f"{shared}/t", 4)
    many = batch(spark, ("a", 1, "1"), ("a", 1, "2"), ("b", 1, "3"), (None, 1, "4"))
    table.replace(many, many)
    gone = batch(spark, ("a", 1, ""), (None, 1, ""), ("new", 1, ""))
    table.replace(gone, batch(spark, ("new", 2, "5")))
    assert rows(table.read(), "feedly_id", "payload") == [("b", "3"), ("new", "5")]
    table.replace(batch(spark, ("b", 1, "")), batch(spark).limit(0))
    table.vacuum(keep=1)
    assert rows(table.read(), "feedly_id", "payload") == [("new", "5")]
    upsert(entries(spark, f"{shared}/t"), batch(spark, ("b", 1, "6")))
    assert rows(table.read(), "feedly_id", "payload") == [("b", "6"), ("new", "5")]


def run_all(jobs):
    failed = []

    def guarded(job):
        try:
            job()
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=guarded, args=(j,)) for j in jobs]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed, failed


def test_two_writers_lose_nothing(spark, shared):
    upsert(entries(spark, f"{shared}/t", 2), batch(spark, ("k", 0, "first")))
    jobs = [
        lambda i=i: [upsert(entries(spark, f"{shared}/t"), batch(spark, (f"w{i}-{n}", 1, "x"), ("k", i * 10 + n, f"{i}-{n}"))) for n in range(3)]
        for i in range(2)
    ]
    run_all(jobs)
    got = rows(entries(spark, f"{shared}/t").read(), "feedly_id", "payload")
    assert got == [("k", "1-2")] + [(f"w{i}-{n}", "x") for i in range(2) for n in range(3)]


def test_two_writers_of_versions_take_different_numbers(spark, shared):
    path = f"{shared}/v"
    run_all([lambda i=i: materialize(spark.range(i, i + 1), path, keep=9) for i in range(4)])
    names = list_names(spark, f"{path}/versions")
    assert [int(n) for n in names] == [0, 1, 2, 3]
    assert {spark.read.parquet(read_text(spark, f"{path}/versions/{n}")).first()[0] for n in names} == {0, 1, 2, 3}
    materialize(spark.range(7), path, keep=2)
    assert current(spark, path).count() == 7 and len(list_names(spark, f"{path}/versions")) == 2
    assert not publish(spark, f"{path}/versions/{names[-1]}", "taken")
    assert current(spark, f"{shared}/none") is None
