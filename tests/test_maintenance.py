import csv
import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import NOW, analysis_rows, entry_rows, rows, ts
from newsboard.operators import checks as K
from newsboard.operators import maintenance as M
from newsboard.operators.articles import entry_details
from newsboard.operators.ranking import number_rows
from newsboard.plans.storage import current, ensure_checkpoint_dir, materialize, shared_dir
from newsboard.sources.feed import parse_entries
from newsboard.sources.register import read_register
from newsboard.sources.seeds import default_seeds, read_seeds

T1, T2, T3 = ts("2020-01-01"), ts("2020-02-01"), ts("2020-03-01")
SCHEMA = "created_at timestamp_ntz, updated_at timestamp_ntz, published_at timestamp_ntz, feedly_id string, payload string"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_upsert(spark):
    base = frame(spark, [(T1, T1, T1, "a", "a1"), (T1, T1, T1, "b", "b1"), (None, T1, T1, "n", "n1")])
    batch = frame(spark, [(T2, T2, T2, "a", "a2"), (T3, T3, T3, "a", "a3"), (T3, T3, T3, "c", None), (T2, T2, T2, "n", "n2")])
    got = M.upsert(base, batch, ["feedly_id"])
    want = [("a", T1, T3, T3, "a3"), ("b", T1, T1, T1, "b1"), ("c", T3, T3, T3, None), ("n", None, T2, T2, "n2")]
    cols = ("feedly_id", "created_at", "updated_at", "published_at", "payload")
    assert rows(got, *cols) == want
    assert rows(M.upsert(got, batch, ["feedly_id"]), *cols) == want
    assert got.columns == base.columns


def test_update_existing_ignores_unknown_ids_and_may_set_null(spark):
    base = frame(spark, [(T1, T1, T1, "a", "a1"), (T1, T1, T1, "b", "b1")])
    batch = frame(spark, [(T2, T2, T2, "a", None), (T2, T2, T2, "x", "x")])
    got = M.update_existing(base, batch, ["feedly_id"], ["payload", "updated_at"])
    assert rows(got, "feedly_id", "updated_at", "published_at", "payload") == [("a", T2, T1, None), ("b", T1, T1, "b1")]


def test_merge_analyses(spark):
    base = analysis_rows(spark, {"old": {"v": 1}, "bad": {"v": 2}, "kept": {"v": 3}})
    results = spark.createDataFrame([("new", "{}"), ("old", "{}"), ("miss", None), ("bad", None)], "feedly_id string, payload string")
    got = M.merge_analyses(base, results, T3)
    assert rows(got, "feedly_id", "status_code", "payload", "created_at", "parsed_at") == [
        ("bad", 400, '{"v": 2}', NOW, None), ("kept", 200, '{"v": 3}', NOW, NOW), ("miss", 404, None, T3, None),
        ("new", 200, "{}", T3, T3), ("old", 200, "{}", NOW, T3),
    ]


def test_merge_analyses_folds_repeated_runs_in_order(spark):
    runs = [("x", "p1", 1), ("x", None, 2), ("y", None, 1), ("y", "p2", 2), ("z", None, 1), ("z", None, 2)]
    results = spark.createDataFrame(runs, "feedly_id string, payload string, seq int")
    got = M.merge_analyses(analysis_rows(spark, {"o": {}}), results, T3).where("feedly_id != 'o'")
    assert rows(got, "feedly_id", "status_code", "payload") == [("x", 400, "p1"), ("y", 200, "p2"), ("z", 400, None)]


def test_backlog(spark):
    docs = [({"id": "none", "originId": "u0"}, T1), ({"id": "null", "originId": "u1"}, T2),
            ({"id": "404", "originId": "u2"}, T3), ({"id": "late", "originId": "u3"}, T3)]
    analyses = spark.createDataFrame([("null", None), ("404", 404)], "feedly_id string, status_code int")
    got = M.analysis_backlog(entry_rows(spark, docs), analyses)
    assert [tuple(r) for r in got.collect()] == [("late", "u3"), ("null", "u1"), ("none", "u0")]
    assert [r[0] for r in M.analysis_backlog(entry_rows(spark, docs), analyses, 1).collect()] == ["late"]


def test_number_rows_is_consecutive(spark):
    ensure_checkpoint_dir(spark)
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("g"))
    got = number_rows(df.select("g", "k"), ["g", "k"])
    pairs = [(r["rn"], (r["g"], r["k"])) for r in got.collect()]
    assert sorted(pairs) == [(i, key) for i, key in enumerate(sorted(k for _, k in pairs), 1)]


def test_refresh_batches(spark):
    ensure_checkpoint_dir(spark)
    day = 86400000
    docs = [({"id": f"e{i:03d}", "crawled": 1577836800000 + i * day // 10}, T1) for i in range(40)]
    details = entry_details(parse_entries(entry_rows(spark, docs)))
    got = rows(M.refresh_batches(details, ts("2020-01-02T09:00:00"), 12))
    assert [b for b, _ in got] == [0, 1, 2]
    assert [i for _, ids in got for i in ids] == [f"e{i:03d}" for i in range(10, 40)]


def test_as_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert df.select(M.as_json("a", "b")).first()[0] == '{"a":1,"b":null}'


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("c", 3)], "k string, r int")
    assert rows(K.check_unique(df, ["k"])) == [("a", 2)]
    assert rows(K.check_unique(df.unionByName(df), ["r"])) == [(1, 4), (3, 2)]
    assert rows(K.check_not_null(df, ["k", "r"])) == [("r", 1)]
    ref = spark.createDataFrame([(3,)], "id int")
    assert rows(K.check_fk(df, ref, {"r": "id"})) == [(1, 2)]
    icons = K.check_not_null(default_seeds(spark)["concepts"], ["name", "emoji_icon"])
    assert rows(icons) == [("emoji_icon", 13)]


def test_materialize_switches_versions(spark, shared):
    assert current(spark, f"{shared}/t") is None
    first = materialize(spark.range(3), f"{shared}/t")
    materialize(current(spark, f"{shared}/t").where("id > 0"), f"{shared}/t")
    assert current(spark, f"{shared}/t").count() == 2
    assert first.count() == 3


def test_shared_dir_is_below_the_session_setting(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_read_register(spark, shared):
    path = f"{shared}/org_parents.csv"
    header = "uuid,name,type,permalink,cb_url,rank,created_at,updated_at,parent_uuid,parent_name".split(",")
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerow(["u", 'A "quoted", Inc', "organization", "a", "", "7", "2010-05-01 10:00:00", "", "p", "line one\nline two"])
    got = read_register(spark, path, "org_parents").collect()
    assert len(got) == 1
    assert (got[0]["name"], got[0]["rank"], got[0]["created_at"], got[0]["parent_name"]) == (
        'A "quoted", Inc', 7, ts("2010-05-01T10:00:00"), "line one\nline two")
    assert got[0]["updated_at"] is None


def test_read_seeds_numbers_rows_by_file_order(spark, shared):
    files = {
        "channels": "name,description,target,target_id\nB,d,slack,#b\nA,d,slack,#a\n",
        "concepts": "name\nZ\nY\n",
        "concept_entity_rules": '"concept_id","entity_type","entity_confidence_score_threshold",'
        '"entity_relevance_score_threshold","topic_score_threshold"\n2,"T",1,0.2,0.2\n1,U,1.0,0.2,0.2\n',
    }
    for name, text in files.items():
        with open(os.path.join(shared, f"{name}.csv"), "w") as f:
            f.write(text)
    seeds = read_seeds(spark, shared)
    assert rows(seeds["channels"], "id", "name", "emoji_icon", "last_sent_at") == [(1, "B", None, None), (2, "A", None, None)]
    assert rows(seeds["concepts"], "id", "name") == [(1, "Z"), (2, "Y")]
    assert rows(seeds["concept_entity_rules"], "id", "concept_id", "entity_type") == [(1, 2, "T"), (2, 1, "U")]
    assert seeds["concept_entity_rules"].dtypes == default_seeds(spark)["concept_entity_rules"].dtypes


def test_check_tables(spark):
    seeds = default_seeds(spark)
    assert rows(K.check_tables(seeds)) == [
        ("channels", "emoji_icon not null", 2), ("concept_entity_rules", "emoji_icon not null", 115),
        ("concepts", "emoji_icon not null", 13),
    ]
    links = spark.createDataFrame([(1, 1), (9, 1), (None, 99)], "channel_id long, concept_id long")
    twice = seeds["concepts"].where("id = 1").unionByName(seeds["concepts"].where("id = 1")).withColumn("emoji_icon", F.lit("x"))
    assert rows(K.check_tables({"channels": seeds["channels"].fillna("x"), "concepts": twice, "channel_concepts": links})) == [
        ("channel_concepts", "channel_id in channels", 1), ("channel_concepts", "channel_id not null", 1),
        ("channel_concepts", "concept_id in concepts", 1), ("concepts", "unique (name)", 1),
    ]


def test_defaults_survive_a_rerun(spark):
    ensure_checkpoint_dir(spark)
    schema = "feedly_id string, created_at timestamp_ntz, updated_at timestamp_ntz, payload string"
    at = NOW - timedelta(days=9)
    first = M.with_defaults(spark.createDataFrame([("b", None, None, None), ("a", at, at, "x")], schema),
                          spark.createDataFrame([], "id long, feedly_id string, created_at timestamp_ntz"), "feedly_id", NOW)
    assert rows(first) == [(1, "a", at, at, "x"), (2, "b", NOW, NOW, "{}")]
    later = NOW + timedelta(days=1)
    again = [("c", None, None, "y"), ("b", None, None, "z"), ("0", None, at, None)]
    second = lambda: rows(M.with_defaults(spark.createDataFrame(again, schema), first, "feedly_id", later))
    assert second() == second() == [(2, "b", NOW, later, "z"), (3, "0", later, at, "{}"), (4, "c", later, later, "y")]
    ids = spark.createDataFrame([("a", None), ("a", None), (None, "a")], "x string, y string").select(M.digest_uuid(F.col("x"), F.col("y")))
    assert [len(set(r[0] for r in ids.collect())), len(ids.first()[0])] == [2, 36]
