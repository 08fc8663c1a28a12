"""Personal data by patterns, and terms that give it away by co-occurrence.

Everything is built from Spark's own functions.  Spans are in code points,
end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsboard.llm.common import ascii_lower, hot_join, landed

#: Kinds in the order of reports.  The guard before a run of characters starts
#: it at its first one or where the last match ended, which selects the same
#: leftmost matches and never tries a long run from each of its characters.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
#: What stands between two words.
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A character of a word.
WORD = BREAK.replace("[", "[^").removesuffix("+")
#: Code points on either side of a span that tests call near; terms count in
#: the whole document.
REACH = 60
#: Distinct texts that must show a term with an entity.
LEAST_TEXTS = 3
#: Share of a term's documents that hold the entity beside it, from which the
#: term is generalised, and from which it is removed.
GENERALISE, REMOVE = 0.75, 0.95

_SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


def _digits(value: Column) -> Column:
    return F.translate(value, "+ ().-", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits' weighted sum, every second one from the right doubled, divides by ten."""
    numbers = F.transform(F.reverse(F.split(digits, "")), lambda d: d.cast("int"))
    doubled = F.transform(
        numbers, lambda d, i: F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))
    )
    return F.aggregate(doubled, F.lit(0), lambda s, d: s + d) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    """Whether a match of the kind's pattern counts."""
    if kind == "ip":
        part = lambda p: F.ltrim(p, F.lit("0"))
        small = lambda p: (F.length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255)
        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        n = F.length(_digits(value))
        return F.when(n.between(16, 19), _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _with(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _matches(text: Column, pattern: Column, kind: str, found: Column) -> Column:
    """Spans of the matches ``found`` of a pattern: the lengths of the matches
    and of what lies between them, added up."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        a = acc["at"] + F.length(x["0"])
        span = F.struct(F.lit(kind).alias("kind"), a.alias("start"), (a + F.length(x["1"])).alias("end"), x["1"].alias("value"))
        return F.struct((a + F.length(x["1"])).alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    between = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    pairs = F.zip_with(between, found, lambda b, m: F.struct(b.alias("0"), m.alias("1")))
    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def _kind_spans(text: Column, kind: str) -> Column:
    """Spans of one kind that count."""
    pattern = F.lit(PATTERNS[kind])

    def spans(found: Column) -> Column:
        every = _matches(text, pattern, kind, found)
        return F.when(F.size(found) > 0, F.filter(every, lambda s: _holds(kind, s["value"]))).otherwise(
            F.array().cast(_SPANS)
        )

    return _with(F.regexp_extract_all(text, pattern, F.lit(0)), spans)


def base_spans(text: Column) -> Column:
    """Spans (kind, start, end, value) of all kinds in their order, then by
    start.  Overlaps of different kinds stay."""
    needs = {"email": "@", "ip": ".", "phone": "+"}
    empty = F.array().cast(_SPANS)
    parts = [
        F.when(F.contains(text, F.lit(needs[k])), _kind_spans(text, k)).otherwise(empty) if k in needs else _kind_spans(text, k)
        for k in PATTERNS
    ]
    return F.concat(*parts)


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased."""
    return F.filter(F.split(ascii_lower(text), BREAK, -1), lambda w: w != "")


def _is_term(word: Column) -> Column:
    return (F.length(word) >= 3) & ~F.rlike(word, F.lit("[0-9]"))


def _terms(text: Column) -> Column:
    """Distinct terms of a text outside of its base spans, of which only e-mail
    addresses have letters."""
    outside = F.regexp_replace(text, F.lit(PATTERNS["email"]), F.lit(" "))
    return F.array_distinct(F.filter(words_of(outside), _is_term))


def _entity(span: Column) -> Column:
    value = F.when(span["kind"].isin("card", "phone"), _digits(span["value"])).otherwise(ascii_lower(span["value"]))
    return F.concat(span["kind"], F.lit(":"), value)


def disclosing_terms(
    based: DataFrame, docs: DataFrame, text: str, least_texts: int = LEAST_TEXTS, threshold: float = GENERALISE
) -> DataFrame:
    """(term, entity, texts, joint, documents, disclosure, bits) of the terms
    that reveal a protected entity.

    ``joint`` counts the documents with the term and the entity, however far
    apart, ``documents`` all documents with the term anywhere: disclosure = joint /
    documents is the probability of the entity given the term.  ``bits`` is the
    pointwise mutual information of both.  Counts are over all documents;
    ``texts`` counts distinct texts, so copies of one text are one witness.
    The entity that a term reveals most is kept.

    A text's entities and terms are not all paired.  Entities of the same texts
    are one, and so are terms; a term meets the entities of as many of its texts,
    those with the fewest entities first, as no entity with enough of its
    documents can miss, and in its other texts only what it met there.
    """
    need = threshold * (1 - 1e-9)  # what rounding may take from a product
    digest = [F.bit_xor(F.xxhash64(F.lit(seed), "key")).alias(name) for seed, name in enumerate("ab")]
    held = based.select("key", "rows", F.explode("entities").alias("entity"))
    # an entity of fewer texts has no term of as many; of entities that stand in
    # the same texts the first speaks for all
    often = landed(
        held.groupBy("entity").agg(F.count("*").alias("of_texts"), F.sum("rows").alias("of_entity"), *digest)
        .filter(F.col("of_texts") >= least_texts)
        .groupBy("of_texts", "a", "b").agg(F.min("entity").alias("entity"), F.first("of_entity").alias("of_entity")),
        "entities",
    )
    mine = hot_join(held, often, "entity", "of_texts").groupBy("key").agg(F.collect_list("entity").alias("mine"))
    # texts by the binary logarithm of their entities' number
    level = F.floor(F.log2(F.size("mine"))).cast("int")
    texts = landed(based.select("key", "rows", "words").join(mine, "key").withColumn("level", level), "entity-texts")
    placed = texts.select("key", "rows", "level", F.explode("words").alias("term"))
    shown = (
        placed.groupBy("term").agg(F.count("*").alias("texts"), F.sum("rows").alias("shown"), *digest)
        .filter(F.col("texts") >= least_texts)
    )
    every = docs.select(F.explode(F.array_distinct(words_of(F.col(text)))).alias("term"))
    counts = every.groupBy("term").agg(F.count("*").alias("documents"))
    # a term that is mostly met without any entity is out; one term per set of texts is compared
    able = landed(shown.join(counts, "term").filter(F.col("shown") >= need * F.col("documents")), "able")
    sets = landed(
        able.groupBy("texts", "a", "b").agg(
            F.min("term").alias("term"), F.first("shown").alias("shown"), F.min("documents").alias("least")
        ),
        "term-sets",
    )
    # the texts that an entity may miss weigh `slack` at most, so it stands in one of
    # any texts that weigh more: those with the fewest entities are paired
    slack = F.col("shown") - need * F.col("least")
    spots = landed(
        hot_join(placed, sets.select("term", "texts", slack.alias("slack"), "least"), "term", "texts"), "spots"
    )
    by_level = spots.groupBy("term", "level").agg(
        F.sum("rows").alias("weight"), F.first("slack").alias("slack"), F.first("least").alias("least"), F.first("texts").alias("texts")
    )
    lower = Window.partitionBy("term").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    up_to = landed(
        by_level.withColumn("before", F.coalesce(F.sum("weight").over(lower), F.lit(0)))
        .groupBy("term").agg(
            F.max(F.when(F.col("before") <= F.col("slack"), F.col("level"))).alias("upto"),
            F.sum(F.when(F.col("before") > F.col("slack"), F.col("weight")).otherwise(0)).alias("beyond"),
            F.first("least").alias("least"), F.first("texts").alias("texts"),
        ),
        "levels",
    )
    leveled = hot_join(spots.drop("slack", "least", "texts"), up_to, "term", "texts")
    entity_of = texts.select("key", F.explode("mine").alias("entity"))
    sums = [F.count("*").alias("texts"), F.sum("rows").alias("joint")]
    paired = leveled.filter(F.col("level") <= F.col("upto")).join(entity_of, "key")
    # what it has so far and all the rest must do
    hopeful = landed(
        paired.groupBy("term", "entity").agg(*sums, F.first("least").alias("least"), F.first("beyond").alias("beyond"))
        .filter(F.col("joint") + F.col("beyond") >= need * F.col("least")),
        "hopeful",
    ).select("term", "entity", "texts", "joint")
    rest = leveled.filter(F.col("level") > F.col("upto")).select("key", "rows", "term")
    rest = rest.join(hopeful.select("term", "entity"), "term").join(entity_of, ["key", "entity"], "left_semi")
    joint = (
        hopeful.unionByName(rest.groupBy("term", "entity").agg(*sums))
        .groupBy("term", "entity").agg(F.sum("texts").alias("texts"), F.sum("joint").alias("joint"))
        .filter(F.col("texts") >= least_texts)
    )
    best = F.min(F.struct((-F.col("joint")).alias("less"), "entity", "texts")).alias("best")
    of_set = sets.join(joint.groupBy("term").agg(best), "term").select(
        "a", "b", F.col("texts").alias("set_texts"), "best.entity", "best.texts", (-F.col("best.less")).alias("joint")
    )
    n = float(docs.count())
    bits = F.log2(F.col("joint") * F.lit(n) / (F.col("documents") * F.col("of_entity")))
    return (
        able.select("term", "a", "b", F.col("texts").alias("set_texts"), "documents")
        .join(of_set, ["a", "b", "set_texts"])
        .withColumn("disclosure", F.col("joint") / F.col("documents"))
        .filter(F.col("disclosure") >= threshold)
        .join(often.select("entity", "of_entity"), "entity")
        .select("term", "entity", "texts", "joint", "documents", "disclosure", bits.alias("bits"))
    )


def term_spans(docs: DataFrame, text: str, terms: DataFrame, copies: DataFrame) -> DataFrame:
    """(key, rows, found) for each distinct text with a disclosing term:
    ``found`` are the terms' spans, ``rows`` the documents with the text, as
    ``copies`` (key, rows) has them."""
    keyed = docs.select(F.md5(F.col(text)).alias("key"), F.col(text).alias("text"))
    # a document without any of the terms ends here
    marked = keyed.select("key", F.explode(F.array_distinct(words_of(F.col("text")))).alias("term"))
    hit = marked.join(terms.select("term", "disclosure"), "term").groupBy("key", "term").agg(F.first("disclosure").alias("disclosure"))
    hit = hit.groupBy("key").agg(F.collect_list(F.struct("term", "disclosure")).alias("mine"))
    hit = landed(copies.join(hit, "key"), "hits")
    # a text with many copies is met where it lies and reduced before it moves
    whole = hot_join(keyed, hit.select("key", "rows"), "key", "rows").groupBy("key").agg(F.first("text").alias("text"))
    # words have no signs of a pattern, and (?i) is about A-Z alone
    pattern = F.concat(
        F.lit(f"(?i)(?<!{WORD})(?:"), F.array_join(F.transform("mine", lambda t: t["term"]), "|"), F.lit(f")(?!{WORD})")
    )
    met = whole.join(hit, "key").withColumn("pattern", pattern)
    spans = _matches(F.col("text"), F.col("pattern"), "term", F.regexp_extract_all("text", "pattern", F.lit(0)))

    def rated(s: Column) -> Column:
        value = ascii_lower(s["value"])
        share = F.element_at(F.map_from_entries("mine"), value)
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), value.alias("value"), share.alias("disclosure"))

    return met.select("key", "rows", F.transform(spans, rated).alias("found"))


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text",
    least_texts: int = LEAST_TEXTS, threshold: float = GENERALISE,
) -> DataFrame:
    """(id, base, terms) for each row of ``docs``: ``base`` are the spans of
    the patterns, ``terms`` those of terms that reveal an entity found by a
    pattern somewhere in the corpus, outside of base spans.

    Terms have at least three code points and no digit.  A term counts by what
    the whole corpus shows, so it is marked in documents that do not name the
    entity as well; a corpus without personal data has no marked terms.

    A NULL text is empty and has no spans.  Rows with equal or NULL ids stay
    rows of their own; exact copies get equal spans, found once.  No rows give
    no rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    given = docs.select(F.col(id_col).alias("id"), body.alias("text"))
    spans = base_spans(F.col("text"))
    none = F.array().cast("array<string>")
    found = given.select("id", F.md5("text").alias("key"), "text", spans.alias("base"))
    based = landed(
        found.select(
            "id", "key", "base", F.array_distinct(F.transform("base", _entity)).alias("entities"),
            F.when(F.size("base") > 0, _terms(F.col("text"))).otherwise(none).alias("words"),
        ),
        "based",
    )
    seen = (
        based.filter(F.size("base") > 0).groupBy("key")
        .agg(F.count("*").alias("rows"), F.first("entities").alias("entities"), F.first("words").alias("words"))
    )
    terms = landed(disclosing_terms(landed(seen, "seen"), given, "text", least_texts, threshold), "terms")
    copies = based.groupBy("key").agg(F.count("*").alias("rows"))
    found = landed(term_spans(given, "text", terms, copies), "term-spans")
    apart = F.filter(
        F.coalesce("found", F.array().cast(found.schema["found"].dataType)),
        lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
    )
    return hot_join(based.select("id", "key", "base"), found, "key", "rows", "left", wide=True).select(
        "id", "base", apart.alias("terms")
    )


def sanitise(text: Column, base: Column, terms: Column, remove: float = REMOVE) -> Column:
    """The text with base spans masked by their kind, terms generalised to
    ``[TERM]`` and those of a disclosure of ``remove`` or more taken out.
    Overlapping spans are one and take the mask of the first."""
    def cut(s: Column, label: Column) -> Column:
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), label.alias("label"))

    def base_label(s: Column) -> Column:
        out = F.lit("[TERM]")
        for kind, label in MASKS.items():
            out = F.when(s["kind"] == kind, F.lit(label)).otherwise(out)
        return out

    cuts = F.array_sort(
        F.concat(
            F.transform(base, lambda s: cut(s, base_label(s))),
            F.transform(terms, lambda s: cut(s, F.when(s["disclosure"] >= remove, F.lit("")).otherwise(F.lit("[TERM]")))),
        )
    )
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, c: Column) -> Column:
        kept = F.substring(text, acc["at"] + 1, c["start"] - acc["at"])
        fresh = F.struct(c["end"].alias("at"), F.concat(acc["out"], kept, c["label"]).alias("out"))
        over = F.struct(F.greatest(acc["at"], c["end"]).alias("at"), acc["out"].alias("out"))
        return F.when(c["start"] >= acc["at"], fresh).otherwise(over)

    rest = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    return F.aggregate(cuts, start, step, rest)


def span_list(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
