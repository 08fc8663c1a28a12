import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import verify
from newsboard.llm import resampling as R

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, id string, row string, rank string, score string, place string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "i", "r", "k", "s", "p") for r in rows], SCHEMA)


def features(text, longest):
    low = "".join(c.lower() if c < "\x80" else c for c in text or "")
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return ws, [" ".join(ws[i : i + k]) for k in range(1, longest + 1) for i in range(len(ws) - k + 1)]


def brute(rows, target, least=20, percent=25, buckets=10_000, longest=2):
    bags = [[zlib.crc32(f.encode()) % buckets for f in features(t, longest)[1]] for _, t in rows]
    corpus = np.bincount([b for bag in bags for b in bag], minlength=buckets)
    wanted = [zlib.crc32(f.encode()) % buckets for t in target for f in features(t, longest)[1]]
    gain = R.gains(corpus, np.bincount(wanted, minlength=buckets))
    out = []
    for (i, t), bag in zip(rows, bags, strict=True):
        weight = sum(int(gain[b]) for b in bag) // len(bag) if bag else 0
        out.append((i, len(bag), weight, weight + R.gumbel(7, i), len(features(t, longest)[0]) >= least))
    pool = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = len(pool) * percent // 100
    return sorted(map(repr, [(*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(pool)] + [(*r[:4], None) for r in out if not r[4]]))


def got(df):
    return sorted(repr(tuple(r)) for r in df.select("id", "n_features", "weight", "score", "rank").collect())


def sample(n=150):
    rng = random.Random(8)
    pool = ["The", "the", "é9", "x", "日本", "A-b", "z's", "\x00", "longer"]
    rows = [(i * 7 - 300, " ".join(rng.choices(pool, k=rng.choice([0, 3, 19, 20, 25, 60])))) for i in range(n)]
    return rows + [(None, "the x " * 30), (10**7, "the x " * 30), (5, None), (6, ""), rows[4], rows[4], (1, "w " * 200_000)]


def test_query(spark):
    assert verify.compare(spark, verify.connect(SF), "op13_resample", SF).startswith("ok")


@pytest.mark.parametrize(("options", "bits"), [({}, 11), ({"percent": 100, "least": 3}, 8), ({"longest": 3, "buckets": 64, "percent": 50}, 16), ({"longest": 1}, 11)])
def test_ranks_match_brute_force(spark, options, bits):
    rows, target = sample(), ["the x longer", "é9 é9", None, ""]
    given = {{"least": "least_words"}.get(k, k): v for k, v in options.items()}
    items = spark.createDataFrame([(t,) for t in target], "text string")
    ranks = R.importance_ranks(frame(spark, rows).repartition(5), items, block_rows=16, digit_bits=bits, **given)
    assert got(ranks) == brute(rows, target, **options)


def test_ties_go_to_the_smaller_id(spark, monkeypatch):
    rows = [(i, "same words " * 10) for i in random.Random(1).sample(range(-200, 200), 120)]
    monkeypatch.setattr(R, "gumbel", lambda seed, doc_id: 0)
    scored = spark.createDataFrame([(i, t, "a") for i, t in rows], "doc_id bigint, text string, x string").repartition(4)
    ranked = R.radix_sort(
        R.landed(scored.selectExpr("doc_id + 200 as k", "cast(doc_id % 3 + 2 as long) as s", "monotonically_increasing_id() as place"), "t"),
        [("s", 3), ("k", 9)], "place", block_rows=8, digit_bits=2,
    ).collect()
    assert [(r["s"], r["k"]) for r in sorted(ranked, key=lambda r: r["place"])] == sorted((r["s"], r["k"]) for r in ranked)
    assert sorted(r["place"] for r in ranked) == list(range(120))


def test_wide_ids_no_rows_and_no_target(spark):
    edge = [(-(2**63), "a b " * 12), (2**63 - 1, "a b " * 12), (0, "b c " * 12), (None, "c d " * 12)]
    none = spark.createDataFrame([], "text string")
    ranks = R.importance_ranks(frame(spark, edge), none, percent=100).collect()
    assert sorted(r["rank"] for r in ranks) == [1, 2, 3, 4]
    assert got(R.importance_ranks(frame(spark, edge), none, percent=100)) == brute(edge, [], percent=100)
    assert R.importance_ranks(frame(spark, []), none).count() == 0
    assert [r["rank"] for r in R.importance_ranks(frame(spark, [(1, "few words")]), none).collect()] == [None]
    with pytest.raises(TypeError):
        R.importance_ranks(frame(spark, edge), none, id_col="id")


def test_pieces_of_a_long_text(monkeypatch):
    data = ("ab c " * 50 + "d  é " * 9).encode()
    whole = {k: Counter(np.concatenate([f for _, f in R.feature_buckets(data, 997, k)]).tolist()) for k in (1, 2, 3)}
    for size in (1, 2, 3, 11):
        monkeypatch.setattr(R, "_BYTES_AT_ONCE", size)
        for k, want in whole.items():
            assert Counter(np.concatenate([f for _, f in R.feature_buckets(data, 997, k)]).tolist()) == want


def test_drawn_documents(spark):
    rows = sample()
    docs = frame(spark, rows)
    ranks = R.importance_ranks(docs, docs.limit(3), percent=60).cache()
    out = R.drawn_documents(docs, ranks).collect()
    want = Counter(r["id"] for r in ranks.collect() if r["rank"] is not None)
    assert Counter(r["doc_id"] for r in out) == want and sorted(r["rank"] for r in out) == list(range(1, len(out) + 1))
    assert set(docs.columns) == set(out[0].asDict())
