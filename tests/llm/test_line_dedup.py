import random
import re
from collections import Counter

import pytest

import verify
from newsboard.llm import line_dedup as D

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, t string, f string, ls string, k string, n string"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in re.sub(r"^[ \t-\r]+|[ \t-\r]+$", "", line))


def brute(texts, least, chars):
    docs = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for t in texts:
        ls = (t or "").split("\n")
        kept = [x for x in ls if len(key(x)) < chars or docs[key(x)] < least]
        out.append((len(ls), len(ls) - len(kept), "\n".join(kept)))
    return sorted(out)


def run(spark, texts, least, chars):
    df = spark.createDataFrame([(i % 5 or None, t, "a", "b", "c", "d", "e") for i, t in enumerate(texts)], SCHEMA)
    out = D.drop_common_lines(df, min_docs=least, min_chars=chars)
    assert out.columns[: len(df.columns)] == df.columns
    return sorted((r["n_lines"], r["n_dropped"], r["kept_text"]) for r in out.collect())


def test_query_matches_sql(spark):
    assert verify.compare(spark, verify.connect(SF), "op9_line_dedup", SF).startswith("ok")


@pytest.mark.parametrize(("least", "chars"), [(3, 1), (4, 0), (5, 2)])
def test_matches_brute_force(spark, least, chars):
    rng = random.Random(least)
    pool = ["A", " a", "a\t", "B b", "b B", "É", "é", "", " ", "\x0b", "x\x85", "unique %d", "İ", " a"]
    texts = ["\n".join(x % i if "%" in x else x for x in rng.choices(pool, k=rng.randint(1, 8))) for i in range(60)]
    texts += [None, None, "", "", texts[0], texts[0], texts[0], "a\n" * 3000, "\n".join(map(str, range(4000)))]
    assert run(spark, texts, least, chars) == brute(texts, least, chars)


def test_no_rows_and_taken_names(spark):
    assert run(spark, [], 2, 1) == []
    with pytest.raises(ValueError, match="exist"):
        D.drop_common_lines(spark.createDataFrame([("a", 1)], "text string, N_lines int"))
