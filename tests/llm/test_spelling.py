import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import verify
from newsboard.llm import spelling as S

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, word string, n string, form string, side string"


def near(a, b):
    """One code point inserted, deleted or replaced."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(counts, ratio):
    """{word: (n, n_near, form, form_n, root)} by comparing all words."""
    found = {}
    for w, n in counts.items():
        others = sorted((-m, v) for v, m in counts.items() if v != w and near(v, w))
        form = others[0][1] if others and -others[0][0] >= ratio * n else None
        found[w] = (n, len(others), form, counts[form] if form else None)

    def root(w):
        return w if found[w][2] is None else root(found[w][2])

    return {w: (*x, root(w)) for w, x in found.items()}


def got(df):
    rows = df.select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: tuple(r)[1:] for r in rows}


def words(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def test_query(spark):
    assert verify.compare(spark, verify.connect(SF), "op11_spelling", SF).startswith("ok")


@pytest.mark.parametrize(("letters", "n", "group_words"), [("ab", 90, 1 << 15), ("abé𝄞", 300, 40), ("aab", 120, 7)])
def test_groups_match_brute_force(spark, letters, n, group_words):
    """Small groups split the words of one key into cells."""
    rng = random.Random(n)
    counts = {"".join(rng.choices(letters, k=rng.randint(6, 10))): rng.choice([1, 5, 5, 30, 200, 2000]) for _ in range(n)}
    counts |= {"a" * k: 5**k for k in range(6, 12)}  # a chain, and letters that repeat
    want = brute(counts, 5)
    assert got(S.variant_groups(words(spark, counts), group_words=group_words)) == want
    assert any(x[4] != x[2] for x in want.values() if x[2])
    pairs = S.near_words(words(spark, counts), group_words=group_words).collect()
    assert len(pairs) == len(set(pairs)) == sum(x[1] for x in want.values())


def test_a_key_that_most_words_share(spark):
    rng = random.Random(3)
    counts = {"con" + "".join(rng.choices("abcd", k=rng.randint(3, 5))) + "ing": rng.randint(1, 99) for _ in range(300)}
    assert got(S.variant_groups(words(spark, counts), group_words=16)) == brute(counts, 5)


def test_few_words_and_long_words(spark):
    assert S.variant_groups(words(spark, {"single": 9}).filter("n < 0")).count() == 0
    assert got(S.variant_groups(words(spark, {"single": 9}))) == {"single": (9, 0, None, None, "single")}
    long = "ab" * 5000
    counts = {long: 50, long + "a": 5, "x" + long[1:]: 7, "a" * 9000: 6, "a" * 9001: 90}
    assert got(S.variant_groups(words(spark, counts))) == brute(counts, 5)


def by_hand(rows, one_in=199):
    counts = Counter()
    for i, text in rows:
        run = ""
        for ch in (text or "") + " ":
            if "a" <= ch <= "z" or "A" <= ch <= "Z" or "À" <= ch <= "ÿ":
                run += ch.lower() if ch < "\x80" else ch
                continue
            if run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                at = h % len(run)
                counts[run if h % one_in else run[:at] + run[at + 1 :]] += 1
            run = ""
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def test_vocabulary(spark, monkeypatch):
    rng = random.Random(4)
    pool = ["Ärgerlich", "straße", "STRAßE", "naïveté", "abcdef", "abcdefg", "abcde", "x", "9", "日本語", "l'esprit", ""]
    rows = [(i % 40, " -\n"[i % 3].join(rng.choices(pool, k=rng.randint(0, 40)))) for i in range(200)]
    rows += [(None, "abcdef " * 9), (1, None), (2, ""), rows[0], rows[0]]
    docs = spark.createDataFrame([(*r, "w", "n", "f", "s") for r in rows], SCHEMA)
    got = lambda **o: {r["word"]: r["n"] for r in S.vocabulary(docs, **o).collect()}
    assert got() == by_hand(rows) and got(one_in=3) == by_hand(rows, 3)
    counts = Counter()
    monkeypatch.setattr(S, "_CHARS_AT_ONCE", 7)  # pieces cut no run
    for i, t in rows:
        S.add_words(counts, i, t or "", 6, 3)
    assert {w: n for w, n in counts.items() if n >= 5} == by_hand(rows, 3)
    assert S.vocabulary(docs.filter(F.lit(False))).count() == 0
