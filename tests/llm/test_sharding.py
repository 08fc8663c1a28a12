import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import verify
from newsboard.llm import sharding as S

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, source string, SHARD string, _draw string, _rank int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", "d", 1) for r in rows], SCHEMA)


def sample(n=400):
    rng = random.Random(5)
    rows = [(i, "w" * rng.choice([0, 1, 50]), rng.choice(["hot", "hot", "hot", "a", "B", None, f"rare {i}"])) for i in range(n)]
    return rows + [(None, None, None), (None, "", "a"), rows[0], rows[0], (0, None, "hot"), (1, "long " * 50_000, "a")]


def test_query(spark):
    assert verify.compare(spark, verify.connect(SF), "op12_shards", SF).startswith("ok")


@pytest.mark.parametrize("n", [1, 3, 16, 500])
def test_every_shard_matches_the_mixture(spark, n):
    rows = sample()
    df = frame(spark, rows)
    out = S.interleave(df, n_shards=n).collect()
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in out) == Counter(rows)
    assert set(out[0].asDict()) == {"doc_id", "text", "source", "shard", "slot", "_draw", "_rank"}
    shards = Counter(r["shard"] for r in out)
    assert set(shards) <= set(range(n)) and max(shards.values()) - min(shards.values(), default=0) <= 1
    assert len(shards) == min(n, len(rows))
    assert Counter((r["shard"], r["slot"]) for r in out) == Counter((k, s) for k in shards for s in range(shards[k]))
    sources = Counter(r["source"] for r in out)
    of = Counter((r["source"], r["shard"]) for r in out)
    for s in sources:
        for k in range(n):
            # cuts are at equal counts, which equal fractions miss by a row per source at most
            assert abs(of[s, k] - sources[s] / n) < 2 + len(sources) * sources[s] / len(rows)
    if n == 16:
        assert all(abs(of["hot", k] - sources["hot"] / n) < 3 for k in range(n))


def test_order_of_input_and_seed(spark):
    rows = list(dict.fromkeys(sample()))
    one = S.interleave(frame(spark, rows)).collect()
    other = S.interleave(frame(spark, random.Random(1).sample(rows, len(rows))).repartition(7)).collect()
    key = lambda r: (r["doc_id"], r["text"], r["source"], r["shard"], r["slot"])
    assert set(map(key, one)) == set(map(key, other))
    assert set(map(key, one)) != set(map(key, S.interleave(frame(spark, rows), seed=1).collect()))


def test_no_rows_and_files(spark, shared):
    assert S.interleave(frame(spark, [])).count() == 0
    dealt = S.interleave(frame(spark, sample()), n_shards=4)
    S.write_shards(dealt, f"{shared}/shards")
    back = spark.read.parquet(f"{shared}/shards")
    assert Counter((r["shard"], r["slot"], r["text"]) for r in back.collect()) == Counter(
        (r["shard"], r["slot"], r["text"]) for r in dealt.collect()
    )
    files = back.select("shard", "slot", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    ordered = files.orderBy("shard", "f", "i").collect()
    assert [(r["shard"], r["slot"]) for r in ordered] == sorted((r["shard"], r["slot"]) for r in ordered)
