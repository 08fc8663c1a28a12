import random
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from newsboard.llm import units as U

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, row string, kept string, cuts string, digest string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "r", "k", "c", "d") for r in rows], SCHEMA)


def brute(rows, unit, least, hashed):
    """{(id, start, cut, n_words, kept_id, kept_start)} by comparing words, not digests."""
    places = {}
    for i, t in set(rows):
        spans, at = [], 0
        for gap in U.BREAKS[unit].finditer(t or ""):
            spans.append((at, gap.start()))
            at = gap.end()
        spans.append((at, len(t or "")))
        units = [(a, ws) for a, b in spans if (ws := U.normalised((t or "")[a:b]))]
        n, before = len(units), [0, *accumulate(len(ws) for _, ws in units)]
        total = lambda i, j: before[j] - before[i]
        shortest = set()
        for u in range(n):  # the first end that is far enough, and the last begin
            end, begin = bisect_left(before, before[u] + hashed), bisect_right(before, before[u + 1] - hashed) - 1
            shortest |= {(u, end)} if end <= n else set()
            shortest |= {(begin, u + 1)} if begin >= 0 else set()
        for k, j in shortest:
            seq = tuple(tuple(ws) for _, ws in units[k:j])
            cut = units[j][0] if j < n else len(t)
            places.setdefault(seq, []).append((i is None, i or 0, total(0, k), t, total(k, j), units[k][0], cut, i))
    repeats = {}
    for found in places.values():
        found.sort()
        for p in found[1:]:
            repeats.setdefault((p[7], p[3]), []).append((p[2], p[2] + p[4], p[5], p[6], found[0][7], found[0][5]))
    out = set()
    for (i, _), spans in repeats.items():
        runs = []
        for a, b, start, cut, ki, ks in sorted(spans, key=lambda s: s[:2]):
            if runs and a <= runs[-1][1]:
                runs[-1][1], runs[-1][3] = max(b, runs[-1][1]), max(cut, runs[-1][3])
            else:
                runs.append([a, b, start, cut, ki, ks])
        out |= {(i, s, c, b - a, ki, ks) for a, b, s, c, ki, ks in runs if b - a >= least}
    return out


def got(df):
    return {(r["id"], r["start"], r["cut"], r["n_words"], r["kept_id"], r["kept_start"]) for r in df.collect()}


def sample(seed):
    rng = random.Random(seed)
    pool = ["a b c", "A  B\tc ", "x y.", "é f Ég h", "", " ", "one", "q r! s\x0bt", "\n"]
    rows = [(i, rng.choice(["\n", " "]).join(rng.choices(pool, k=rng.randint(1, 12)))) for i in range(50)]
    return rows + [(None, "a b c\nnew words here"), (None, "x y. q r! s"), (90, None), (91, ""), rows[3], rows[3]]


@pytest.mark.parametrize(("unit", "least", "hashed"), [("line", 3, 3), ("line", 1, 1), ("paragraph", 4, 2), ("word", 5, 3)])
def test_matches_brute_force(spark, unit, least, hashed):
    rows = sample(least)
    df = frame(spark, rows)
    removed = U.repeated_units(df, unit=unit, least_words=least, hashed_words=hashed)
    want = brute(rows, unit, least, hashed)
    assert got(removed) == want and want
    clean = U.remove_units(df, removed).collect()
    assert len(clean) == len(rows)
    cuts = {}
    for r in removed.collect():
        cuts.setdefault(r["id"], set()).add((r["start"], r["cut"]))
    originals = {i: t for i, t in rows if i is not None}
    for r in clean:
        if r["doc_id"] is None:
            continue
        text, kept, at = originals[r["doc_id"]], "", 0
        for a, c in sorted(cuts.get(r["doc_id"], [])):
            kept, at = kept + text[at:a], c
        assert r["text"] == (None if text is None else kept + text[at:])
        assert "".join(text[s["start"] : s["end"]] for s in r["kept_spans"]) == (r["text"] or "")


def test_query_matches_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = entry_point.queries()["op2_unit_dedup"](spark, SF).collect()
    assert {tuple(r) for r in rows} == brute(docs, "word", U.LEAST_WORDS, U.HASHED_WORDS) and rows


def test_a_passage_inside_other_text_is_found(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    prose = lambda n: " ".join(word() + (". " + word().title() if k % 9 == 8 else "") for k in range(n))
    passage = "Begins " + prose(60) + "."
    hosts = [(i, f"{prose(80)} {passage} {prose(80)}") for i in range(5)]
    clean = [(100 + i, prose(150)) for i in range(20)] + [(200 + i, f"{prose(60)}\nAll rights reserved.") for i in range(9)]
    found = U.repeated_units(frame(spark, hosts + clean)).collect()
    assert sorted(r["id"] for r in found) == [1, 2, 3, 4] and {r["kept_id"] for r in found} == {0}
    texts = dict(hosts)
    for r in found:
        assert texts[r["id"]][r["start"] : r["cut"]].strip() == passage
    left = U.remove_units(frame(spark, hosts), U.repeated_units(frame(spark, hosts)))
    assert left.filter(F.contains("text", F.lit(passage))).count() == 1


def test_one_word_units_are_no_evidence(spark):
    rng = random.Random(2)
    rows = [(i, "!! ".join(rng.choices(["AB", "CD", "EF", "GH", "IJ", "KL", "MN", "OP"], k=60))) for i in range(40)]
    assert U.repeated_units(frame(spark, rows), hashed_words=20).count() == 0


def test_no_rows_and_long_units(spark):
    assert U.repeated_units(frame(spark, [])).count() == 0
    long = "w " * 100_000
    found = U.repeated_units(frame(spark, [(2, long), (1, f"x\n{long}")]), unit="line").collect()
    assert [(r["id"], r["kept_id"], r["kept_start"], r["n_words"]) for r in found] == [(2, 1, 2, 100_000)]


def test_a_passage_whose_edges_are_cut_by_its_surroundings_is_found(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage = " ".join(f"{prose(9)}. Then" for _ in range(3)) + " " + prose(21)
    caseless = prose(51)  # no break but spaces
    hosts = [(i, f"{prose(7)} {p} {prose(7)}") for i, p in enumerate([passage, passage, caseless, caseless])]
    found = {r["id"]: r for r in U.repeated_units(frame(spark, hosts)).collect()}
    assert sorted(found) == [1, 3]
    for i, p in ((1, passage), (3, caseless)):
        assert hosts[i][1][found[i]["start"] : found[i]["cut"]].strip() == p


def test_hot_sequences_and_small_holdings_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(U, "_AT_ONCE", 60)  # travels with the tasks' functions
    monkeypatch.setattr(U, "_HOT", 2)
    rng = random.Random(6)
    hot = "one two three four five six seven"
    rows = [(rng.choice([i, i % 7, None]), " ".join([*rng.choices(["x", "é", "Y"], k=rng.randint(0, 9)), hot, *rng.choices("abc", k=5)])) for i in range(90)]
    # ids are given once, but for copies
    rows = list({i: (i, t) for i, t in rows if i is not None}.values()) + rows[:1] * 2
    rows = [r for r in rows if r[0] is not None]
    want = brute(rows, "word", 5, 3)
    assert got(U.repeated_units(frame(spark, rows), least_words=5, hashed_words=3)) == want and len(want) > 30
    lines = [(i, t.replace(" a", "\na")) for i, t in rows]
    assert got(U.repeated_units(frame(spark, lines), unit="line", least_words=2, hashed_words=2)) == brute(lines, "line", 2, 2)


def test_a_column_called_like_the_spans_is_replaced(spark):
    rows = [(i, "one two three four five six", "old") for i in (1, 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, KEPT_spans string")
    left = U.remove_units(docs, U.repeated_units(docs, least_words=3, hashed_words=2))
    assert left.columns == ["doc_id", "text", "kept_spans"]
    assert {(r["doc_id"], r["text"], len(r["kept_spans"])) for r in left.collect()} == {(1, rows[0][1], 1), (2, "", 0)}


def by_words(rows, least, hashed):
    """As ``brute`` gives for clauses, in linear time: a unit is a word."""
    first, out = {}, set()
    for i, t in sorted(set(rows)):
        at = [(m.start(), U.normalised(m[0])[0]) for m in re.finditer(r"[^ \t-\r]+", t or "")]
        cuts, runs = [*(a for a, _ in at), len(t or "")], []
        for k in range(len(at) - hashed + 1):
            kept = first.setdefault(tuple(w for _, w in at[k : k + hashed]), (i, at[k][0]))
            if kept == (i, at[k][0]):
                continue
            if runs and k <= runs[-1][1]:
                runs[-1][1] = k + hashed
            else:
                runs.append([k, k + hashed, *kept])
        out |= {(i, cuts[a], cuts[b], b - a, ki, ks) for a, b, ki, ks in runs if b - a >= least}
    return out


def test_query_leaves_no_repeated_passage(spark):
    rows = [(i, t) for i, t in sample(7) if i is not None and t is not None and i != 3]
    assert by_words(rows, 5, 3) == brute(rows, "word", 5, 3)
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = entry_point.queries()["op2_unit_dedup"](spark, SF).collect()
    assert {tuple(r) for r in found} == by_words(docs, U.LEAST_WORDS, U.HASHED_WORDS) and found


@pytest.mark.parametrize("kind", ["bigint", "int", "string", "decimal(20,0)"])
def test_ids_that_name_their_documents_alone_and_others(spark, kind):
    rng = random.Random(8)
    rows = [(7 - 3 * i, " ".join(rng.choices(["x", "é", "Yy", "z"], k=rng.randint(0, 30)))) for i in range(60)]
    for given in (rows, [*rows, rows[5]], [*rows, (None, rows[9][1])]):
        df = frame(spark, given)
        found = U.repeated_units(df.withColumn("doc_id", F.col("doc_id").cast(kind)), least_words=6, hashed_words=4)
        assert found.schema["id"].dataType.simpleString() == kind
        if kind == "string":  # text order is another rank: only the set of documents with repeats is compared
            assert found.count()
            continue
        as_numbers = found.withColumn("id", F.col("id").cast("bigint")).withColumn("kept_id", F.col("kept_id").cast("bigint"))
        assert got(as_numbers) == brute(given, "word", 6, 4)
        left = U.remove_units(df.withColumn("doc_id", F.col("doc_id").cast(kind)), found)
        assert left.count() == len(given) and left.filter("size(kept_spans) = 0 or text != ''").count() == len(given)


def test_packed_ids_and_places_come_back():
    import numpy as np
    import pyarrow as pa

    for values, kind in (([5, 9, 2**62, -(2**62), None], pa.int64()), ([1, 2], pa.int32()), ([], pa.int64()), (["b", None], pa.string())):
        ids = pa.array(values, kind)
        assert U._unpack_ids(U._pack_ids(ids), len(ids), bool(ids.null_count), kind).equals(ids)
    rng = np.random.default_rng(1)
    first = np.array([0, 5, 2**30, 3, 700_000_000])
    places = [first, np.full(5, 8), np.array([0, 40, 2**31 - 9, 3, 9]), np.array([7, 90, 2**31 - 1, 5, 2**31 - 2]), rng.integers(0, 2**31, 5), np.arange(5)]
    for n in (4, 6):
        assert (U._unpack(U._pack(*places[:n]), 5, n) == np.array(places[:n])).all()
