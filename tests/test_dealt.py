from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import NOW, analysis_rows, entry_rows, plan_of, rows, ts
from newsboard.operators import analysis as N
from newsboard.plans.incremental import IncrementalViews
from newsboard.plans.keyed import KeyedTable
from newsboard.plans.storage import list_names
from newsboard.sources.schemas import ANALYSES, ENTRIES, REGISTER
from newsboard.sources.seeds import default_seeds, small_table
from newsboard.streaming.routing import deliver_analyses, waiting_analyses

SCHEMA = "feedly_id string, created_at timestamp_ntz, updated_at timestamp_ntz, payload string"
BASE = ts("2020-03-01")


def batch(spark, *items):
    at = lambda day: None if day is None else BASE + timedelta(days=day)
    return spark.createDataFrame([(k, at(c), at(u), p) for k, c, u, p in items], SCHEMA)


@pytest.fixture
def sorted_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def shuffles(df):
    """The shuffles of the plan that ran, one line each."""
    df.collect()
    final = plan_of(df).split("== Physical Plan ==")[1].split("== Initial Plan ==")[0]
    return [line for line in final.splitlines() if "Exchange hashpartitioning" in line]


BATCHES = [
    [("a", 1, 1, "a1"), ("a", 0, 1, "a0"), ("b", 1, None, "b1"), ("c", None, 2, None), (None, 1, 1, "n"), ("same", 5, 5, "x")],
    [("a", 3, 3, "a3"), ("b", 0, None, "b0"), ("c", 4, 2, "c2"), ("d", 1, 1, "d1"), ("same", 4, 5, "x")],
    [("a", 2, 2, "a2"), ("b", None, 0, None), ("d", None, None, "d0"), ("e", 1, 1, "e"), (None, 9, 9, "n9")],
]


@pytest.mark.parametrize("turn", [(0, 1, 2), (2, 1, 0), (1, 0, 2, 0)])
def test_dealt_tables_keep_what_others_keep(spark, shared, turn):
    got = []
    for dealt in (False, True):
        table = KeyedTable(spark, f"{shared}/{dealt}", ["feedly_id"], SCHEMA, 4, dealt=dealt)
        for k in turn:
            table.upsert(batch(spark, *BATCHES[k]), ("updated_at",), ("created_at",))
        again = KeyedTable(spark, f"{shared}/{dealt}", ["feedly_id"], SCHEMA, 9)
        assert (again.dealt, again.buckets) == (dealt, 4)
        again.replace(batch(spark, ("b", 1, 1, ""), ("new", 1, 1, "")), batch(spark, ("new", 1, 1, "1"), ("new", 2, 2, "2")))
        got.append((rows(again.read()), rows(again.matching(batch(spark, ("a", 0, 0, ""), ("new", 0, 0, ""))))))
        again.replace(batch(spark, ("a", 1, 1, ""), (None, 1, 1, "")), batch(spark, (None, 1, 1, "none")))
        got[-1] += (rows(again.read()),)
    assert got[0] == got[1] and len(got[0][0]) > 5


def test_rows_of_dealt_tables_meet_where_they_lie(spark, shared, sorted_joins):
    tables = [KeyedTable(spark, f"{shared}/{n}", ["feedly_id"], SCHEMA, 6, dealt=True) for n in "xy"]
    for n, table in enumerate(tables):
        table.upsert(batch(spark, *[(f"k{i}", 1, 1, f"{n}") for i in range(40)]))
        table.upsert(batch(spark, *[(f"k{i}", 1, 2, f"{n} new") for i in range(7)]))
    x, y = (t.read() for t in tables)
    assert shuffles(x.join(y.select("feedly_id", F.col("payload").alias("p")), "feedly_id").groupBy("feedly_id", "p").count()) == []
    assert shuffles(tables[0].matching(tables[1].read())) == []
    one = tables[0].touched(batch(spark, ("k3", 1, 1, "")))
    assert len(tables[0].read(one).inputFiles()) < len(x.inputFiles())


def test_a_table_that_keeps_one_version_deletes_the_others(spark, shared):
    table = KeyedTable(spark, f"{shared}/t", ["feedly_id"], SCHEMA, 4, dealt=True, keep=1)
    for n in range(3):
        table.upsert(batch(spark, *[(f"k{i}", 1, n, f"{n}") for i in range(20)]))
    assert list_names(spark, f"{shared}/t/versions") == [f"{2:020d}"]
    kept = [f for d in list_names(spark, f"{shared}/t/data") for f in list_names(spark, f"{shared}/t/data/{d}")]
    assert len(kept) == len(table.folders()) and rows(table.read(), "payload") == [("2",)] * 20


def test_a_change_moves_no_documents_and_leaves_no_notes(spark, shared, sorted_joins, monkeypatch):
    """Entries and analyses that lie dealt by their id are stored and looked up there."""
    views = IncrementalViews(spark, f"{shared}/v", spark.createDataFrame([], REGISTER["organizations"]), 4, keep=1)
    moved = []
    write = KeyedTable._write

    def watched(self, parts, data):
        if self.path.rpartition("/")[2] in ("entries", "analyses", "details", "articles"):
            for p in parts:
                moved.extend(x for x in shuffles(self.deal(p)) if "ENSURE_REQUIREMENTS" not in x or "payload" in x)
        write(self, parts, data)

    source = [KeyedTable(spark, f"{shared}/{n}", ["feedly_id"], df.schema, 4, dealt=True)
              for n, df in (("e", entry_rows(spark, [{}])), ("a", analysis_rows(spark, {})))]
    ids = [f"k{i}" for i in range(20)]
    source[0].upsert(entry_rows(spark, [{"id": k, "title": k} for k in ids]))
    source[1].upsert(analysis_rows(spark, {k: {"topics": [{"label": "x"}]} for k in ids}))
    monkeypatch.setattr(KeyedTable, "_write", watched)
    for n in range(2):
        views.apply(f"c{n}", *(t.read() for t in source))
        assert list_names(spark, f"{shared}/v/changes/c{n}") == ["done"]
    assert moved == []
    assert views.stored()["vw_article_nlp_topics"].count() == views.stored()["articles"].count() > 0
    assert all(len(list_names(spark, f"{shared}/v/{t}/versions")) == 1 for t in ("entries", "details", "articles"))


def order_article(key, day):
    doc = {"id": key, "title": f"Title {key}", "alternate": [{"href": f"https://{key}.example.com/"}]}
    return doc, BASE + timedelta(days=day)


def routed(spark, shared, days, buckets, monkeypatch, **options):
    """Route one batch of analyses; gives what was sent, and what was written for the batch with its rows."""
    seeds = default_seeds(spark)
    seeds["channels"] = seeds["channels"].withColumn("last_sent_at", F.lit(BASE).cast("timestamp_ntz"))
    links = small_table(spark, "channel_id concept_id", [(1, 12), (2, 12)])
    tables = {**seeds, "channel_concepts": links, "organizations": spark.createDataFrame([], REGISTER["organizations"])}
    team = {"type": ["SportsTeam"], "entityEnglishId": "E", "relevanceScore": 0.9, "confidenceScore": 9}
    doc = {"topics": [{"id": 0, "label": "Machine learning", "score": 0.9}], "entities": [team]}
    entries = KeyedTable(spark, f"{shared}/entries", ["feedly_id"], ENTRIES, buckets, dealt=True)
    entries.upsert(entry_rows(spark, [order_article(k, d) for k, d in days.items()]))
    analysis_rows(spark, {k: doc for k in [*days, "early"]}).write.parquet(f"{shared}/analyses")
    seen, change = {}, KeyedTable.change

    def watched(self, touched, combine, step=None):
        change(self, touched, combine, step)
        name = self.path.rpartition("/")[2].rpartition("-")[0]
        seen[name] = (self.path, self.buckets, {r[0] for r in self.read().select("feedly_id").collect()})

    monkeypatch.setattr(KeyedTable, "change", watched)
    stream = spark.readStream.schema(ANALYSES).option("maxFilesPerTrigger", 99).parquet(f"{shared}/analyses")
    deliver_analyses(
        stream, entries, tables, "slack", f"{shared}/sent", f"{shared}/state", f"{shared}/cp", NOW, f"{shared}/waiting", **options
    ).awaitTermination()
    return spark.read.parquet(f"{shared}/sent"), seen


def test_a_batch_is_dealt_and_parsed_once_and_its_folders_go(spark, shared, monkeypatch):
    parsed, parse = [], N.analysis_entities
    monkeypatch.setattr(N, "analysis_entities", lambda *a, **k: parsed.append(1) or parse(*a, **k))
    sent, seen = routed(spark, shared, {f"k{i}": i - 3 for i in range(12)}, 5, monkeypatch)
    recent = {f"k{i}" for i in range(4, 12)}
    assert rows(sent, "channel_id", "feedly_id") == sorted((c, k) for c in (1, 2) for k in recent)
    assert {r["feedly_id"] for r in waiting_analyses(spark, f"{shared}/waiting", ANALYSES).collect()} == {"early"}
    # Buckets are those of the entry table; articles older than all marks are not parsed.
    assert parsed == [1] and {n for _, n, _ in seen.values()} == {5}
    assert seen["due"][2] == {"early", *(f"k{i}" for i in range(12))}
    assert all(seen[name][2] == recent for name in ("articles", "parsed", "topics", "entities"))
    for path, *_ in seen.values():
        folder, _, name = path.rpartition("/")
        assert name not in list_names(spark, folder)


def test_the_number_of_parts_changes_no_message(spark, shared, monkeypatch):
    some = {f"k{i}": i - 3 for i in range(12)}
    got = [routed(spark, f"{shared}/{n}", some, 4, monkeypatch, parts=n) for n in (1, 7)]
    assert rows(got[0][0]) == rows(got[1][0]) and {n for _, n, _ in got[1][1].values()} == {7}
