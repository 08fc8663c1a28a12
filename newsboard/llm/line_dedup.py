"""Line dedup: lines that many documents share are dropped from all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsboard.llm.common import SPACES, ascii_lower, fresh, hot_join, landed


def line_key(line: Column) -> Column:
    """A line without white space at its ends and with A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def drop_common_lines(
    docs: DataFrame, text: str = "text", min_docs: int = 10, min_chars: int = 1,
    kept: str = "kept_text", n_lines: str = "n_lines", n_dropped: str = "n_dropped",
) -> DataFrame:
    """``docs`` with three more columns: the text without common lines, its
    number of lines and the number dropped.

    A line is common if its key has at least ``min_chars`` code points and
    occurs in at least ``min_docs`` rows; every line with that key goes, the
    others are joined by ``\\n`` in their order.

    Plan: lines are exploded to (digest of the text, position, digest of the
    key).  Each row of ``docs`` counts a key once, by ``array_distinct`` before
    the explode, so the counts need one shuffle with map-side sums.  What is
    dropped from a text depends on the text alone, so flags are made once per
    distinct text, whatever the number of its copies, and reassembly joins the
    positions' flags back.  Lines that hold more than a thousandth of the
    counts meet their flag by a broadcast of at most a thousand keys.  Keys are
    128-bit digests, so texts cross the network once, in that last join; a text
    with many copies is split there by adaptive execution, as nothing above
    needs its rows together.

    NULL and empty texts are one empty line, which is never common unless
    ``min_chars`` is 0.  Rows with equal or NULL ids are rows of their own; no
    id is used.  No rows give no rows.  A result name that ``docs`` already has
    is an error; other columns pass through.
    """
    clash = {c.lower() for c in docs.columns} & {kept.lower(), n_lines.lower(), n_dropped.lower()}
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    digest = lambda c: F.unhex(F.md5(c))
    lines = docs.select(F.coalesce(F.col(text), F.lit("")).alias("t")).select(
        digest(F.col("t")).alias("t"), lines_of(F.col("t")).alias("lines")
    )
    long_enough = lambda k: F.length(k) >= min_chars
    keys = F.filter(F.transform("lines", line_key), long_enough)
    counts = (
        lines.select(F.explode(F.array_distinct(F.transform(keys, F.md5))).alias("k"))
        .groupBy(F.unhex("k").alias("k"))
        .agg(F.count("*").alias("n"))
    )
    common = landed(counts.filter(F.col("n") >= min_docs), "common")
    placed = landed(
        lines.select("t", F.posexplode("lines").alias("pos", "line"))
        .select("t", "pos", line_key(F.col("line")).alias("key"))
        .select("t", "pos", F.when(long_enough(F.col("key")), digest(F.col("key"))).alias("k"))
        .distinct(),
        "placed",
    )
    flags = (
        hot_join(placed, common, "k", "n", "left")
        .groupBy("t")
        .agg(F.sort_array(F.collect_list(F.struct("pos", F.col("n").isNotNull().alias("hot")))).alias("f"))
        .select("t", F.col("f.hot").alias("f"))
        .filter(F.exists("f", lambda x: x))
    )
    t, f, ls = fresh(docs, "t", "f", "ls")
    flags = flags.select(F.col("t").alias(t), F.col("f").alias(f))
    stays = F.filter(F.col(ls), lambda line, i: ~F.coalesce(F.get(F.col(f), i), F.lit(False)))
    return (
        docs.withColumn(t, digest(F.coalesce(F.col(text), F.lit(""))))
        .join(flags, t, "left")
        .withColumn(ls, lines_of(F.col(text)))
        .select(
            *[docs[c] for c in docs.columns],
            F.size(ls).cast("bigint").alias(n_lines),
            (F.size(ls) - F.size(stays)).cast("bigint").alias(n_dropped),
            F.array_join(stays, "\n").alias(kept),
        )
    )
