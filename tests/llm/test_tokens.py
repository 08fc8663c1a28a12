import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
from newsboard.llm import tokens as T

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, id string, path string, n_ids string"
ODD = ["", " ", "don't we'll it's ''s", "É\x85x y é́ İı ſ ŉ", "<|endoftext|>a<|startoftext|>", "½ ² 12३4 ⅷ", "a_b__c--d",
       "\x00\x1c\x1fz", "Σας ΟΔΟΣ", "日本語 テスト", "«¿Qué?» l’été…", "x" * 500, "🙂🙂 a🙂b", "ª º µ × ÷ ¨ \xad", "ǅ ﬁ ß ẞ"]


@pytest.fixture(scope="module")
def encoder():
    return T.WordEncoder(T.vocabulary_path(T.VOCABULARY))


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(T.vocabulary_path(T.VOCABULARY))


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode(text), "<u4").tolist()


def test_ids_are_those_of_the_tokenizer(encoder, plain):
    rng = random.Random(2)
    chars = list("abcXYZ 0189'’_-.,!?\n\t éÉßñÑ«»…") + [chr(rng.randrange(1, 0x2FFF)) for _ in range(300)]
    texts = ODD + [" ".join(ODD)] + ["".join(rng.choices(chars, k=rng.randint(1, 60))) for _ in range(3000)]
    for t in texts:
        assert ids_of(encoder, t) == plain.encode(t, add_special_tokens=False).ids, repr(t)


def test_every_plain_character_alone_and_in_words(encoder, plain):
    for c in map(chr, range(1, 0x2100)):
        for t in (c, f"a{c}b {c}{c} 1{c}"):
            if not 0xD800 <= ord(c) < 0xE000:
                assert ids_of(encoder, t) == plain.encode(t, add_special_tokens=False).ids, repr(t)


def test_a_full_cache_changes_nothing(monkeypatch, plain):
    monkeypatch.setattr(T, "CACHED_PIECES", 3)
    encoder = T.WordEncoder(T.vocabulary_path(T.VOCABULARY))
    text = "one two three four five one two three six"
    assert ids_of(encoder, text) == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 31, 32])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1001).astype("<u4")
    data = T.pack(ids, bits)
    assert len(data) == -(-1001 * bits // 8)
    assert (T.unpack(data, 1001, bits) == ids).all()


def test_random_access_over_blocks(tmp_path):
    rng = np.random.default_rng(0)
    docs = [(None if i == 2 else i, rng.integers(0, 1 << 11, n).astype("<u4")) for i, n in enumerate([0, 5, 700, 1, 0, 64, 63, 65, 0])]
    path = f"{tmp_path}/x/a.ids"
    f = T.IdFile(path, 11, block_ids=64)
    for doc_id, ids in docs:
        f.add(doc_id, ids)
    f.close()
    starts = np.cumsum([0] + [len(x) for _, x in docs]).tolist()
    for a in range(len(docs)):
        for b in range(a + 1, len(docs) + 1):
            got = list(T.read_docs(path, a, b))
            assert [(d, s, i.tolist()) for d, s, i in got] == [(docs[k][0], starts[k], docs[k][1].tolist()) for k in range(a, b)]


def test_query_matches_brute_force(spark, plain):
    got = {r["doc_id"]: r for r in entry_point.queries()["op10_token_ids"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    start = 0
    for r in docs:
        ids = plain.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        g = got.pop(r["doc_id"])
        assert (g["start"], g["n_tokens"], g["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not got


def test_small_files_and_chunks_give_the_same(spark):
    rows = [(i, f"word{i} again and again {i * i}", "i", "p", "n") for i in range(60)] + [(None, "null id", "i", "p", "n")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    one = T.read_ids(T.write_ids(docs)).collect()
    index = T.write_ids(docs, file_ids=50, chunk_ids=10)
    assert index.select("path").distinct().count() > 4
    assert sorted(map(tuple, T.read_ids(index).collect()), key=lambda r: r[1]) == sorted(map(tuple, one), key=lambda r: r[1])


def test_nulls_repeats_and_empty(spark):
    rows = [(2, None, "", "", ""), (1, "", "", "", ""), (1, "a", "", "", ""), (None, "b", "", "", ""), (1, "a", "", "", "")]
    got = sorted(T.read_ids(T.write_ids(spark.createDataFrame(rows, SCHEMA))).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 1, 1, 1, 2]
    assert sorted(r["n_tokens"] for r in got) == [1, 1, 2, 2, 2]
    assert got[-1]["start"] == 7
    assert T.read_ids(T.write_ids(spark.createDataFrame([], SCHEMA))).count() == 0


def test_another_way_to_prepare_texts_goes_to_the_tokenizer(spark, plain, tmp_path):
    import json

    definition = T.read_definition(T.vocabulary_path(T.VOCABULARY))
    assert T.words_apart(definition)
    other = json.loads(definition)
    other["normalizer"]["normalizers"] = other["normalizer"]["normalizers"][:2]  # capitals stay
    added = json.loads(definition)
    added["added_tokens"].append({**added["added_tokens"][0], "id": 49408, "content": "magic"})
    docs = spark.createDataFrame([(i, x, "", "", "") for i, x in enumerate([*ODD[:9], "UPPER magic Word"])], SCHEMA)
    for k, parts in enumerate((other, added)):
        path = tmp_path / f"{k}.json"
        path.write_text(json.dumps(parts))
        assert not T.words_apart(path.read_text())
        tokenizer = Tokenizer.from_file(str(path))
        got = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in T.read_ids(T.write_ids(docs, vocabulary=str(path))).collect()}
        assert got == {r["doc_id"]: [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 2] for r in docs.collect()}
    assert tokenizer.encode("UPPER magic Word").ids != plain.encode("UPPER magic Word").ids


def test_equal_ids_are_ordered_alike_in_every_run(spark):
    rows = [(5, f"text {i % 40}", "", "", "") for i in range(300)] + [(None, "copy", "", "", "")] * 400
    runs = []
    for parts in (2, 7):
        docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        got = sorted(map(tuple, T.read_ids(T.write_ids(docs, file_ids=200)).collect()), key=lambda r: r[1])
        runs.append([(r[0], r[1], r[2], bytes(r[3])) for r in got])
    assert runs[0] == runs[1] and len(runs[0]) == 700 and [r[0] for r in runs[0]] == [None] * 400 + [5] * 300
