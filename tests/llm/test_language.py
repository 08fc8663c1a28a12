import math
import zlib

import numpy as np

import __spark_entry__ as entry_point
from newsboard.llm import language as L

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, lang_id string, score string, ambiguous string"


def test_codewords_are_far_apart():
    for n in (2, 3, 4, 7):
        code = L.codewords(n)
        far = [(code[a] != code[b]).sum() for a in range(n) for b in range(a)]
        assert min(far) >= 2 ** (n - 2) and len({tuple(c) for c in code.T}) == code.shape[1]
    code = L.codewords(40)
    assert min((code[a] != code[b]).sum() for a in range(40) for b in range(a)) >= 15


def test_a_wrong_bit_is_corrected():
    code = L.codewords(4)
    for k in range(4):
        margins = code[k].copy()
        margins[0] *= -0.5
        loss = np.logaddexp(0, -4 * code * margins).mean(axis=1)
        assert loss.argmin() == k


def test_held_out_accuracy(spark):
    rows = entry_point.queries()["op6_language"](spark, SF).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 150
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held]) > 0.99


def test_labels_of_held_out_documents_are_not_read(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    one = {r["doc_id"]: r["lang_id"] for r in L.identify_languages(docs).collect()}
    from pyspark.sql import functions as F

    other = docs.withColumn("lang", F.when(L.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    assert {r["doc_id"]: r["lang_id"] for r in L.identify_languages(other).collect()} == one


def test_nulls_no_letters_and_no_labels(spark):
    texts = [None, "", " 12 %% \n", "½ ²", "the cat and the dog", "日本語", "Ωμέγα", "le chat et le chien " * 60_000]
    rows = [(i, t, None, "x", "y", "z") for i, t in enumerate(texts)]
    learned = [(1000 + i, f"the dog and the cat {i}", "en", "x", "y", "z") for i in range(9)]
    learned += [(2000 + i, f"le chat et le chien {i}", "fr", "x", "y", "z") for i in range(9)] + [(None, "the", "fr", "", "", "")]
    df = spark.createDataFrame(rows + learned, SCHEMA)
    got = {r["doc_id"]: r["found"] for r in L.identify_languages(df, out="found").collect()}
    assert [got[i]["lang"] for i in range(5)] == ["und"] * 4 + ["en"] and got[7]["lang"] == "fr"
    assert got[5]["lang"] in ("en", "fr") and got[None]["lang"] == "en"
    kept = L.drop_undetermined(df)
    assert kept.columns == df.columns and kept.count() == df.count() - 4
    alone = L.identify_languages(spark.createDataFrame(rows, SCHEMA), out="found").collect()
    assert {r["found"]["lang"] for r in alone} == {"und"}
    assert L.identify_languages(spark.createDataFrame([], SCHEMA), out="found").count() == 0


def test_rare_languages_beyond_128_are_learned(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(140):
        words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 5)) for _ in range(6)]
        for i in range(2 if k >= 128 else 4):
            rows.append((len(rows), " ".join(rng.choice(words, 40)), f"l{k:03}", "", "", ""))
    df = spark.createDataFrame(rows, SCHEMA)
    model = L.learn(df, "text", "lang")
    assert len(model.languages) == 140 and model.code.shape[1] <= 15 * 8
    assert np.mean([model.predict(r[1])[0] == r[2] for r in rows if r[2] >= "l128"]) > 0.9


def test_texts_stay_if_no_language_was_learned(spark):
    texts = ["the cat", "12 34", None, "", "日本語"]
    df = spark.createDataFrame([(i, t, None, "x", "y", "z") for i, t in enumerate(texts)], SCHEMA)
    assert sorted(r["doc_id"] for r in L.drop_undetermined(df).collect()) == [0, 4]


def plain_shares(text):
    """N-grams of a text by bucket, one after the other."""
    body = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in text.lower().encode())
    data, counts = b" " + b" ".join(body.split()) + b" ", {}
    for size, shift in ((2, 0), (3, 1 << 24)):
        for a in range(len(data) - size + 1):
            gram = int.from_bytes(data[a : a + size], "big") + shift
            bucket = gram * 2654435761 % 2**32 >> 18
            counts[bucket] = counts.get(bucket, 0) + 1
    total = max(1, sum(counts.values()))
    return {b: n / total for b, n in counts.items()}


def plain_model(rows):
    """The same classifiers, odds and borders in plain Python, for up to seven languages."""
    sums, n = {}, {}
    for doc_id, text, lang in rows:
        if text is None or lang is None or zlib.crc32(str(doc_id).encode()) % 4 == 2 or not any(map(str.isalpha, text)):
            continue
        n[lang] = n.get(lang, 0) + 1
        mean = sums.setdefault(lang, {})
        for b, s in plain_shares(text).items():
            mean[b] = mean.get(b, 0.0) + s
    names = sorted(sums)
    means = [{b: s / n[x] for b, s in sums[x].items()} for x in names]
    bits = []
    for split in range(1, 2 ** (len(names) - 1)):
        side = [split >> k & 1 for k in range(len(names))]
        on, off = [m for m, s in zip(means, side) if s], [m for m, s in zip(means, side) if not s]
        mean_of = lambda group, b: sum(m.get(b, 0.0) for m in group) / len(group)
        odds = [math.log(mean_of(on, b) + 0.5 / 2**14) - math.log(mean_of(off, b) + 0.5 / 2**14) for b in range(2**14)]
        scores = [sum(s * odds[b] for b, s in m.items()) for m in means]
        border = (min(x for x, s in zip(scores, side) if s) + max(x for x, s in zip(scores, side) if not s)) / 2
        spread = sum(abs(x - border) for x in scores) / len(scores) or 1.0
        bits.append(([1 if s else -1 for s in side], [(o - border) / spread for o in odds]))
    return names, bits


def plain_prediction(names, bits, text):
    if text is None or not any(map(str.isalpha, text)):
        return "und", 0.0
    shares = plain_shares(text)
    margins = [sum(s * weights[b] for b, s in shares.items()) for _, weights in bits]
    near = [4.0 / 2 * sum(side[k] * m for (side, _), m in zip(bits, margins)) / len(bits) for k in range(len(names))]
    each = [math.exp(4.0 * (x - max(near))) for x in near]
    best = max(range(len(names)), key=lambda k: each[k])
    return names[best], each[best] / sum(each)


def test_query_matches_brute_force(spark):
    small = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    names, bits = plain_model(docs)
    assert 2 <= len(names) <= 7
    want = {i: plain_prediction(names, bits, t) for i, t, _ in docs}
    got = {r["doc_id"]: r for r in entry_point.queries()["op6_language"](spark, small).collect()}
    assert got.keys() == want.keys()
    for i, (lang, score) in want.items():
        assert got[i]["lang_pred"] == lang and abs(got[i]["score"] - score) < 1e-3


def test_codewords_of_many_languages_are_measured():
    code = L.codewords(1500)
    assert len({tuple(c) for c in code}) == 1500
    alike = code[:700] @ code[700:].T
    assert (code.shape[1] - alike.max()) / 2 >= code.shape[1] / 6


def test_a_column_called_like_the_result_is_replaced(spark):
    df = spark.createDataFrame([(1, "the cat", "en", "old")], "doc_id bigint, text string, lang string, LANG_id string")
    got = L.identify(df, L.learn(df, "text", "lang"))
    assert got.columns == ["doc_id", "text", "lang", "lang_id"] and got.first()["lang_id"]["lang"] == "en"


def test_sums_of_many_tasks_make_the_same_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    one, many = L.learn(docs.coalesce(1), "text", "lang"), L.learn(docs.repartition(70), "text", "lang")
    assert one.languages == many.languages and (one.code == many.code).all()
    assert np.allclose(one.weights, many.weights, rtol=1e-4, atol=1e-4)
