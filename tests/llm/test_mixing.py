import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from newsboard.llm import mixing as M

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, source string, key string, copies string, copy string"


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Shares by weight, what is over a cap shared again until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > cap * sizes[s]}
        if not over:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            out[s] = cap * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", "c", "y") for r in rows], SCHEMA)


def check(rows, mix):
    """rows: (id, text, source); mix: rows of mix_sources."""
    size = lambda t: len(re.findall(r"[^ \t-\r]+", t or ""))
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    want = targets(sizes)
    assert Counter((r["id"], r["source"], r["size"]) for r in mix for _ in range(r["rows"])) == Counter(
        (i, s, size(t)) for i, t, s in rows
    )
    taken, largest = defaultdict(int), defaultdict(int)
    for r in mix:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        taken[r["source"]] += r["taken"] * r["rows"]
        largest[r["source"]] = max(largest[r["source"]], r["size"] * r["rows"])
    for s in want:
        assert abs(taken[s] - want[s]) <= largest[s] + 1e-6


def sample(seed, n=500):
    rng = random.Random(seed)
    rows = [(i, "w " * rng.choice([0, 1, 3, 10, 200]), rng.choice(["a", "B", "é", None, "big", "big", "big"])) for i in range(n)]
    return rows + [(None, None, None), (None, "x y", "z"), (7, "same", "a"), (7, "same", "a"), (8, "", ""), (9, " ", "")]


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    check([tuple(r) for r in docs.collect()], M.mix_sources(docs).collect())
    query = entry_point.queries()["op8_pivotal_mix"]
    one, two = query(spark, SF).collect(), query(spark, SF).collect()
    assert sorted(one) == sorted(two) and len(one) == docs.count()


@pytest.mark.parametrize("fan_in", [2, 5, 64])
def test_targets_and_rounding(spark, monkeypatch, fan_in):
    monkeypatch.setattr(M.pivotal_rounding, "__defaults__", (fan_in,))
    rows = sample(fan_in)
    check(rows, M.mix_sources(frame(spark, rows)).collect())


def test_units_keep_their_probability(spark):
    units = spark.range(400).select(
        F.lit("g").alias("g"), F.unhex(F.md5(F.col("id").cast("string"))).alias("key"),
        (F.col("id") % 7 + 1).cast("double").alias("mass"), F.lit(0.3).alias("p"),
    )
    ups = Counter()
    for seed in range(12):
        for r in M.pivotal_rounding(units, "g", seed).collect():
            ups[bytes(r["key"])] += r["up"]
    mean = sum(ups.values()) / 400 / 12
    assert 0.25 < mean < 0.35 and max(ups.values()) < 12 and len(ups) == 400


def test_copies_of_rows(spark):
    rows = sample(3, 60)
    df = frame(spark, rows)
    mix = M.mix_sources(df)
    out = M.apply_mix(df, mix)
    assert out.columns == df.columns
    want = Counter()
    for r in mix.collect():
        want[r["id"], r["source"], r["size"]] += r["copies"] * r["rows"]
    size = M.word_count(F.col("text"))
    got = Counter((r["doc_id"], r["source"], r["size"]) for r in out.withColumn("size", size).collect())
    assert got == +want


def test_no_rows(spark):
    assert M.mix_sources(frame(spark, [])).count() == 0
    assert [r["taken"] for r in M.mix_sources(frame(spark, [(1, None, None)])).collect()] == [0]
