import random
import re

import numpy as np
import xxhash

import __spark_entry__ as entry_point
from newsboard.llm import simhash as S
from newsboard.llm.components import components

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, fp string, `key` string"


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[ \t-\r]+", words) if w]
    shingles = [words] if 0 < len(words) < 4 else [words[i : i + 4] for i in range(len(words) - 3)]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """{index: indexes reachable} over links of at most 4 bits."""
    left, out = set(range(len(fps))), {}
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            i = todo.pop()
            group.add(i)
            near = {j for j in left if (fps[i] ^ fps[j]).bit_count() <= 4}
            left -= near
            todo += near
        out |= dict.fromkeys(group, group)
    return out


def test_fingerprints_match_brute_force():
    rng = random.Random(1)
    texts = [None, "", " \n", "One", "a b c", "a b c d", "É É\x85x \x1fq R", "x " * 70000]
    texts += [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 60))) for _ in range(50)]
    for t in texts:
        assert S.simhash(t and t.encode()) % 2**64 == brute_fingerprint(t)


def test_every_close_pair_shares_an_anchor():
    rng = np.random.default_rng(3)
    for _ in range(300):
        x = int(rng.integers(0, 2**63))
        y = x
        for b in rng.choice(64, 4, replace=False):
            y ^= 1 << int(b)
        slot, fp, home = S.replicas(np.array([x, y], np.uint64).view(np.int64))
        first = fp == np.uint64(x).astype(np.int64)
        assert set(slot[first & home]) & set(slot[~first])
        assert len(set(zip(slot.tolist(), fp.tolist()))) == len(slot)


def test_query_matches_brute_force(spark):
    got = entry_point.queries()["op7_simhash"](spark, SF).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(docs)
    fps = [brute_fingerprint(docs[i]) for i in ids]
    groups = brute_components(fps)
    want = {i: (f"{fps[k]:016x}", min(ids[j] for j in groups[k])) for k, i in enumerate(ids)}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == want
    assert len(got) == len(docs) and len({v[1] for v in want.values()}) < len(docs)


def test_dense_balls_and_chains(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    fps = {base ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)}
    chain = rng.getrandbits(64)
    for _ in range(40):
        fps.add(chain)
        for b in rng.sample(range(64), 4):
            chain ^= 1 << b
    fps |= {rng.getrandbits(64) for _ in range(300)}
    fps = sorted(fps)
    signed = [int(np.uint64(x).astype(np.int64)) for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    got = {r["node"]: r["root"] for r in components(S.fingerprint_links(df)).collect()}
    groups = brute_components(fps)
    for k, x in enumerate(signed):
        assert got.get(x, x) == min(signed[j] for j in groups[k])


def test_nulls_repeats_empty_and_clashing_names(spark):
    rows = [(1, "a b c d e", "x", "k"), (1, "a b c d e", "x", "k"), (None, "a b c d e", None, None),
            (None, "other words stand in here now", None, None), (4, None, "y", "k"), (3, "", "y", "k")]
    got = S.near_duplicates(spark.createDataFrame(rows, SCHEMA), "doc_id").collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got) == [
        (0, 0), (0, 1), (1, 1), (1, 1), (3, 3), (4, 3)
    ]
    assert S.near_duplicates(spark.createDataFrame([], SCHEMA), "doc_id").count() == 0


def test_a_key_called_like_a_result_column_is_renamed(spark):
    from newsboard.llm import simhash

    df = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e")], "Component bigint, text string")
    found = simhash.near_duplicates(df, "Component")
    assert found.columns == ["_Component", "fp", "component", "component_id"]
    assert {(r["_Component"], r["component_id"]) for r in found.collect()} == {(1, 1), (2, 1)}
