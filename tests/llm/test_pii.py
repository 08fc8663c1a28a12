import hashlib
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from newsboard.llm import common, pii as P

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, base string, terms string, key string"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+".replace(r"\x20-", r"\x20\-"),
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 8 <= len(digits) <= 15


def brute_base(text):
    return [(k, m.start(), m.end(), m[0]) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if holds(k, m[0])]


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def is_term(w):
    return len(w) >= 3 and not re.search("[0-9]", w)


def brute_terms(texts):
    """{term: disclosure} over all texts (one per document)."""
    pairs, docs_of = defaultdict(lambda: [set(), 0]), defaultdict(int)
    for t in texts:
        ws = [(m.start(), m.end(), lower(m[0])) for m in WORD.finditer(t)]
        for w in {w for _, _, w in ws}:
            docs_of[w] += 1
        seen = set()
        for kind, a, b, value in brute_base(t):
            entity = (kind, re.sub("[^0-9]", "", value) if kind in ("card", "phone") else lower(value))
            lo, hi = max(0, a - P.REACH), b + P.REACH
            for region, cut_first, cut_last in ((t[lo:a], a > P.REACH, False), (t[b:hi], False, len(t) > hi)):
                found = re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", region)
                found = found[1:] if cut_first else found
                found = found[:-1] if cut_last else found
                seen |= {(entity, lower(w)) for w in found if is_term(w)}
        for e, w in seen:
            pairs[e, w][0].add(t)
            pairs[e, w][1] += 1
    out = {}
    for (_, w), (witnesses, joint) in pairs.items():
        if len(witnesses) >= P.LEAST_TEXTS and joint / docs_of[w] >= P.GENERALISE:
            out[w] = max(out.get(w, 0), joint / docs_of[w])
    return out


def brute_term_spans(text, terms):
    base = brute_base(text)
    return [(m.start(), m.end()) for m in WORD.finditer(text)
            if lower(m[0]) in terms and not any(a < m.end() and m.start() < b for _, a, b, _ in base)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "b", "t", "k") for r in rows], SCHEMA)


def test_base_spans_match_brute_force(spark):
    rng = random.Random(4)
    alphabet = list("0123456789") * 3 + list("  ..--@@++()%_abZé🙂\n")
    texts = ["".join(rng.choices(alphabet, k=rng.randint(1, 80))) for _ in range(3000)]
    texts += ["a@b.c_x@d.e", "a@b.c.@d.e", "x@y z@-.-.q", "1.2.3.4.5.6.7.8", "0001.2.3.255", "1.2.3.256", "9" * 400 + ".1.1.1",
              "4111 1111-1111 1111", "4111111111111111 2", "+1 (234) 555-0199.", "+1+12345678", "é+49 30 1234567é", "", "@", "+"]
    texts += ["1 " * 30000, "a" * 50000, "1." * 20000, "x@" * 5000]
    df = frame(spark, list(enumerate(texts)))
    got = {r["doc_id"]: [tuple(s) for s in r["b"]] for r in df.select("doc_id", P.base_spans(F.col("text")).alias("b")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == brute_base(t), t[:200]


def test_query_matches_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    terms = brute_terms(docs.values())
    for r in entry_point.queries()["op5_pii"](spark, SF).collect():
        text = docs.pop(r["doc_id"])
        base = brute_base(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b, _ in base)
        every = [joined] * bool(joined) + [f"term:{a}:{b}" for a, b in brute_term_spans(text, terms)]
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert r["spans"] == ",".join(every)
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(k == s[0] for s in base) for k in PATTERNS]
    assert not docs


def corpus():
    rng = random.Random(8)
    common = ["the", "and", "House", "road", "été"]
    fill = lambda n: " ".join(rng.choices(common, k=n))
    rows = [(i, f"{fill(20)} Zorblat {fill(3)} eve.x@mail.example.org quux, {fill(20)} {i}") for i in range(6)]
    rows += [(i, f"{fill(12)}\n{'Quux ' if i == 20 else ''}{fill(9)} ZORBLAT; {fill(12)}" if i < 22 else fill(30)) for i in range(20, 60)]
    rows += [(100 + i, rows[0][1]) for i in range(4)] + [(None, None), (None, ""), (3, rows[1][1])]
    rows += [(200 + i, f"only twice wibble a{i // 2}@b.cc") for i in range(4)]
    return rows


def test_terms_match_brute_force(spark):
    rows = corpus()
    terms = brute_terms([t or "" for _, t in rows])
    assert {"zorblat", "quux"} <= set(terms) and not {"the", "house", "wibble"} & set(terms)
    got = P.find_personal_data(frame(spark, rows)).collect()
    have = sorted((str(r["id"]), tuple((s["start"], s["end"]) for s in r["terms"])) for r in got)
    assert have == sorted((str(i), tuple(brute_term_spans(t or "", terms))) for i, t in rows)
    for r in got:
        for s in r["terms"]:
            assert abs(s["disclosure"] - terms[s["value"]]) < 1e-9


def test_sanitised_texts(spark):
    docs = {i: t for i, t in corpus()[:46]}
    texts = frame(spark, list(docs.items()))
    found = P.find_personal_data(texts)
    joined = found.join(texts.select(F.col("doc_id").alias("id"), "text"), "id")
    clean = joined.select("id", P.sanitise(F.col("text"), F.col("base"), F.col("terms")).alias("clean")).collect()
    for r in clean:
        assert "eve.x" not in r["clean"] and "orblat" not in r["clean"].lower()
        if r["id"] >= 22:
            assert r["clean"] == docs[r["id"]]
        if r["id"] < 6:
            assert "[EMAIL]" in r["clean"]


def test_no_rows(spark):
    assert P.find_personal_data(frame(spark, [])).count() == 0
    assert P.find_personal_data(frame(spark, [(1, "no data here")])).collect()[0]["terms"] == []


def test_a_term_far_from_its_entity_counts(spark):
    filler = "the road and the house " * 20
    rows = [(i, f"Zorblat wrote {i}. {filler}{filler} signed eve.x@mail.example.org {i}") for i in range(4)]
    rows += [(10 + i, f"{filler} {i}") for i in range(30)]
    got = {r["id"]: {s["value"] for s in r["terms"]} for r in P.find_personal_data(frame(spark, rows)).collect()}
    assert all("zorblat" in got[i] for i in range(4)) and not any(got[10 + i] for i in range(30))
    assert not {"the", "road", "mail", "example"} & set().union(*got.values())


def brute_disclosing(texts):
    """{term: (entity, texts, joint, documents)} with every entity and term of a document paired."""
    documents, pairs = Counter(), defaultdict(Counter)
    for t in texts:
        outside = re.sub(PATTERNS["email"], " ", t)
        words = {lower(m[0]) for m in WORD.finditer(t)}
        documents.update(words)
        for w in {w for w in (lower(m[0]) for m in WORD.finditer(outside)) if is_term(w)}:
            for kind, _, _, value in brute_base(t):
                pairs[w, f"{kind}:{lower(value)}"][t] = 1
    rows = Counter(texts)
    out = {}
    for (w, e), held in pairs.items():
        joint = sum(rows[t] for t in held)
        if len(held) >= P.LEAST_TEXTS and joint / documents[w] >= P.GENERALISE:
            out[w] = min(out.get(w, (0, "")), (-joint, e, len(held), documents[w]))
    return {w: (e, n, -less, d) for w, (less, e, n, d) in out.items()}


def disclosing(spark, texts, monkeypatch=None):
    made = {}
    if monkeypatch:
        real = P.landed
        monkeypatch.setattr(P, "landed", lambda df, name: made.setdefault(name, real(df, name)))
    P.find_personal_data(frame(spark, list(enumerate(texts)))).count()
    return made


def test_terms_of_overlapping_entities_match_brute_force(spark, monkeypatch):
    rng = random.Random(21)
    mails, names = [f"m{i}@x.org" for i in range(12)], [f"name{chr(97 + i)}" for i in range(20)]
    texts = []
    for i in range(150):
        some = rng.sample(range(12), rng.choice([0, 1, 1, 2, 5, 11]))
        with_them = {names[k] for k in some if rng.random() < 0.9} | set(rng.sample(names[8:], 2))
        texts += [" ".join([*(mails[k] for k in some), *sorted(with_them), f"n{i}"])] * rng.choice([1, 1, 1, 4])
    got = {r["term"]: (r["entity"], r["texts"], r["joint"], r["documents"]) for r in disclosing(spark, texts, monkeypatch)["terms"].collect()}
    assert got == brute_disclosing(texts) and len(got) >= 4


def test_a_text_of_many_entities_and_terms_is_not_paired_whole(spark, monkeypatch):
    tag = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    n = 300
    hub = " ".join(f"u{i}@x.org word{tag(i)}" for i in range(n))
    texts = [hub] + [f"u{i}@x.org word{tag(i)} {k}" for i in range(n) for k in range(3)]
    made = disclosing(spark, texts, monkeypatch)
    got = {r["term"]: r["entity"] for r in made["terms"].collect()}
    assert got == {f"word{tag(i)}": f"email:u{i}@x.org" for i in range(n)}
    # one pair per term out of n * n in the hub
    assert made["hopeful"].count() == n


def test_copies_with_many_entities_are_one_set(spark, monkeypatch):
    tag = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    page = " ".join(f"u{i}@x.org word{tag(i)}" for i in range(100))
    made = disclosing(spark, [f"{page} {k}" for k in range(4)], monkeypatch)
    assert made["terms"].count() == 100 and made["hopeful"].count() == 1


def test_wide_hot_rows_are_shuffled_beyond_the_bound(spark, monkeypatch):
    rows = corpus()
    want = sorted(map(str, P.find_personal_data(frame(spark, rows)).collect()))
    monkeypatch.setattr(common, "HOT_BYTES", 0)
    assert sorted(map(str, P.find_personal_data(frame(spark, rows)).collect())) == want


def test_term_spans_at_word_ends_and_beside_other_scripts(spark):
    texts = [f"Zorblat quux{c} {c}zorblat ZORBLAT. x_zorblat-zorblat zorblatquux \U0001F600zorblat zorblat\U0001F600 "
             f"\u212Aim kim été Été e{k}.x@mail.example.org eve.x@mail.example.org" for k, c in enumerate(["", "é", "🙂", "ß"])]
    terms = brute_disclosing(texts)
    assert {"zorblat", "kim", "\u212Aim"} <= set(terms)
    for r in P.find_personal_data(frame(spark, list(enumerate(texts)))).collect():
        assert [(s["start"], s["end"]) for s in r["terms"]] == brute_term_spans(texts[r["id"]], terms)
