import random

import verify
from newsboard.llm import decontaminate as D

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, row string, items string, id string"
ITEMS = "item_id bigint, text string, words string"


def brute(docs, items, size=10):
    out = []
    for doc_id, text in docs:
        ws = D.words_of((text or "").encode())
        hit, found = set(), set()
        for item, t in items:
            iw = D.words_of((t or "").encode())
            if not iw:
                continue
            n = min(size, len(iw))
            for i in range(len(iw) - n + 1):
                for s in range(len(ws) - n + 1):
                    if ws[s : s + n] == iw[i : i + n]:
                        hit |= set(range(s, s + n))
                        found |= set() if item is None else {str(item)}
        out.append((doc_id, len(ws), len(hit), sorted(found)))
    return sorted(out, key=repr)


def run(spark, docs, items, **kw):
    d = spark.createDataFrame([(*x, "r", "i", "d") for x in docs], DOCS)
    i = spark.createDataFrame([(*x, "w") for x in items], ITEMS)
    rows = D.find_windows(d, i, **kw).collect()
    for r in rows:
        assert r["n_hit"] == sum(s["end"] - s["first"] for s in r["spans"])
    return sorted(((r["id"], r["n_words"], r["n_hit"], r["items"]) for r in rows), key=repr)


def sample(seed):
    rng = random.Random(seed)
    words = ["a", "b", "C", "é", "9"]
    text = lambda n: rng.choice([" ", "-", "\n"]).join(rng.choices(words, k=n))
    items = [(i, text(rng.randint(1, 14))) for i in range(12)] + [(3, "a b"), (40, ""), (41, None), (None, "a b c")]
    docs = [(i, text(rng.randint(0, 60))) for i in range(40)] + [(None, items[0][1]), (5, None), (5, ""), (5, items[1][1])]
    docs += [(90, "zz " + items[0][1] + " zz " + items[0][1])]
    return docs, items


def test_query_matches_sql(spark):
    assert verify.compare(spark, verify.connect(SF), "op3_decontaminate", SF).startswith("ok")


def test_matches_brute_force(spark):
    for seed in (1, 2):
        docs, items = sample(seed)
        assert run(spark, docs, items) == brute(docs, items)
        assert run(spark, docs, items, size=3) == brute(docs, items, 3)


def test_blocks_of_windows_give_the_same(spark):
    docs, items = sample(3)
    assert run(spark, docs, items, size=3, block=20) == brute(docs, items, 3)


def test_long_and_dense_text(spark, monkeypatch):
    monkeypatch.setattr(D, "_PAIRS_AT_ONCE", 50)
    docs = [(1, "a " * 3000), (2, "a " * 9)]
    assert run(spark, docs, [(1, "a " * 11), (2, "a")]) == [(1, 3000, 3000, ["1", "2"]), (2, 9, 9, ["2"])]


def test_no_benchmark_and_no_documents(spark):
    assert run(spark, [(1, "a b")], []) == [(1, 2, 0, [])]
    assert run(spark, [], [(1, "a b")]) == []


def test_items_without_an_id_hit_but_are_not_listed(spark):
    passage = " ".join(f"w{k}" for k in range(12))
    docs, items = [(1, f"x {passage} y"), (2, "w0 w1")], [(None, passage), (7, "w3 w4")]
    assert run(spark, docs, items) == brute(docs, items) == [(1, 14, 12, ["7"]), (2, 2, 0, [])]
    assert run(spark, docs, items[:1], block=1) == [(1, 14, 12, []), (2, 2, 0, [])]


def test_items_without_an_id_are_dropped_from_documents_too(spark):
    docs = spark.createDataFrame([(1, "x a b c y", "r", "i", "d"), (2, "x a y", "r", "i", "d")], DOCS)
    items = spark.createDataFrame([(None, "a b c", "w"), (7, "q", "w")], ITEMS)
    assert [r["doc_id"] for r in D.drop_contaminated(docs, items).collect()] == [2]
