import math

import numpy as np
from pyspark.sql import functions as F

import verify
from newsboard.llm import search as S

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<double>, id string, v string, `row` string"


def brute(rows, k):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(ok):
        if i % 10 == 0:
            fit = lambda s: max(-(2**63), min(2**63 - 1, s))
            scores = [(-fit(sum(x * y for x, y in zip(q, v))), j) for b, (j, v) in enumerate(ok) if a != b]
            for rank, (s, j) in enumerate(sorted(scores)[:k], 1):
                out.append((i, rank, j, -s))
    return sorted(out)


def run(spark, rows, k=10, **kw):
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)
    return sorted(map(tuple, S.top_k(df, F.col("vec_id") % 10 == 0, k=k, **kw).collect()))


def test_query_matches_sql(spark):
    assert verify.compare(spark, verify.connect(SF), "op4_top_k", SF).startswith("ok")


def test_shards_groups_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "SHARDS_AT_ONCE", 3)
    monkeypatch.setattr(S, "QUERIES_AT_ONCE", 7)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(400)]
    assert run(spark, rows, shard_rows=30) == brute(rows, 10)


def test_ties_nulls_repeats_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, float(i % 3)]) for i in range(60)]
    rows += [(0, [1.0, 0.0]), (0, [0.0, 5.0]), (70, None), (None, [9.0, 9.0]), (80, [1.0, None]), (90, [nan, 1.0]), (100, [inf, 1.0])]
    rows += [(110, [2.0]), (111, []), (120, [])]
    assert run(spark, rows, shard_rows=16) == brute(rows, 10)


def test_few_candidates_none_and_huge_values(spark):
    assert run(spark, [(0, [1.0]), (10, [2.0])]) == brute([(0, [1.0]), (10, [2.0])], 10)
    assert run(spark, [(0, [1.0])]) == [] and run(spark, []) == [] and run(spark, [(1, [1.0]), (2, [1.0])]) == []
    rows = [(i, [10.0**12 * (i + 1), -(10.0**11) * i]) for i in range(20)]
    assert run(spark, rows) == brute(rows, 10)


def test_boxes_prune(monkeypatch):
    rng = np.random.default_rng(2)
    points = rng.integers(-1000, 1000, (4096, 2))
    tree = S.Tree(np.arange(4096), np.arange(4096), points)
    popped = []
    real = S.heapq.heappop
    monkeypatch.setattr(S.heapq, "heappop", lambda h: popped.append(1) or real(h))
    best = []
    tree.search(np.array([3, 1]), -1, best, 5)
    want = sorted(((int(p @ [3, 1]), -i) for i, p in enumerate(points)), reverse=True)[:5]
    assert sorted(((s, i) for s, i, _ in best), reverse=True) == want and len(popped) < 40


def corners(n, seed):
    """Clusters at the corners of a cube: each median split halves them."""
    rng = np.random.default_rng(seed)
    return [(i, [float(rng.normal(s * 8, 0.05)) for s in rng.choice([-1, 1], 3)]) for i in range(n)]


def test_only_pairs_that_boxes_let_meet_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(S, "SHARDS_AT_ONCE", 1)
    monkeypatch.setattr(S, "QUERIES_AT_ONCE", 12)
    frames, real = {}, S.landed
    monkeypatch.setattr(S, "landed", lambda df, name: frames.setdefault(name, real(df, name)))
    rows = corners(960, 4)
    assert run(spark, rows, shard_rows=60) == brute(rows, 10)
    shards, blocks = frames["trees"].count(), frames["begun"].select("block").distinct().count()
    met = frames["reached"].agg(F.count("*"), F.sum("n")).first()
    assert shards >= 16 and blocks >= 8
    assert met[0] <= shards * blocks / 3 and met[1] <= 96 * shards / 3  # all pairs would be these products


def test_copies_of_one_vector_fill_many_bounded_shards(spark, monkeypatch):
    frames, real = {}, S.landed
    monkeypatch.setattr(S, "landed", lambda df, name: frames.setdefault(name, real(df, name)))
    rng = np.random.default_rng(6)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else rng.normal(size=3).tolist()) for i in range(600)]
    assert run(spark, rows, shard_rows=40) == brute(rows, 10)
    assert frames["trees"].count() >= 600 / 40
    import pickle

    assert max(len(pickle.loads(r["tree"]).ids) for r in frames["trees"].collect()) <= 80


def test_cells_hold_what_their_cuts_say():
    rng = np.random.default_rng(7)
    points = rng.integers(-50, 50, (3000, 4))
    cuts = S.Cuts(points, 16)
    sizes = np.bincount(cuts.cell(points), minlength=cuts.cells)
    assert cuts.cells == 16 and sizes.sum() == 3000 and sizes.min() > 100 and sizes.max() < 300
    assert S.Cuts(np.ones((9, 2), np.int64), 8).cells == 1 and S.Cuts(np.empty((0, 3), np.int64), 8).cells == 1
