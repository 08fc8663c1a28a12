import zlib
from collections import Counter

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from newsboard.llm import decontaminate, language, mixing, simhash, tokens

SF = "/root/testdata/sf0.001"


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = [D for D in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = set()
    for item in benchmark:
        ws = decontaminate.words_of(item["text"].encode())
        windows |= {tuple(ws[i : i + 10]) for i in range(max(1, len(ws) - 9))}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_dedup", "decontaminate", "mix", "token_ids"]
    before = [tuple(r) for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        after = [tuple(r) for r in out.collect()]
        if name == "language_id":
            assert sorted(after) == sorted(r for r in before if language.has_letter(r[1]))
        if name == "near_dedup":
            fps = {r[0]: simhash.simhash(r[1].encode()) % 2**64 for r in before}
            left, want = sorted(fps), []
            while left:
                group, todo = {left[0]}, [left[0]]
                while todo:
                    x = todo.pop()
                    near = {y for y in left if y not in group and (fps[x] ^ fps[y]).bit_count() <= 4}
                    group |= near
                    todo += near
                want.append(min(group))
                left = [y for y in left if y not in group]
            assert sorted(r[0] for r in after) == sorted(want)
        if name == "decontaminate":
            def leaks(text):
                ws = decontaminate.words_of(text.encode())
                return any(tuple(ws[i : i + n]) in windows for n in {len(w) for w in windows} for i in range(len(ws)))

            assert sorted(after) == sorted(r for r in before if not leaks(r[1])) and len(after) < len(before)
        if name == "mix":
            want = {r["id"]: r["copies"] for r in mixing.mix_sources(docs).collect()}
            assert Counter(r[0] for r in after) == +Counter(want)
        docs, before = documents(spark, after), after
    got = sorted(map(tuple, corpus_pipeline.token_ids(spark, docs, SF).collect()), key=lambda r: r[1])
    plain, start = Tokenizer.from_file(tokens.vocabulary_path(tokens.VOCABULARY)), 0
    for doc_id, _, _, _, _ in sorted(before):
        text = next(r[1] for r in before if r[0] == doc_id)
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert got.pop(0) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not got


def test_run_is_the_stages_one_after_the_other(spark):
    one = sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert sorted(map(tuple, docs.collect())) == one and one


def test_nulls_repeats_and_no_rows(spark):
    long = " ".join(f"word{i}" for i in range(30))
    rows = [(1, long, "en", "a", 1), (1, long, "en", "a", 1), (None, long + " x", None, None, None), (None, None, None, None, None),
            (2, "", "en", "a", 0), (3, "12 34", "en", "b", 5), (4, "other text of its own that stays", None, None, 3),
            (None, "a lonely null id beside the others", "en", None, None)]
    for given in (rows, []):
        docs = documents(spark, given)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            if name == "near_dedup" and given:
                assert sorted(str(r["doc_id"]) for r in docs.collect()) == ["1", "4", "None"]
        assert (docs.count() > 0) == bool(given)
