"""Importance resampling to a target distribution, ranked by a radix sort.

Texts are bags of hashed features: runs of consecutive words, counted in a
fixed number of buckets.  The gain of a bucket compares its share in a target
set with its share in all documents; the gains are one array that every task
holds, and the weight of a document is the mean over its features.  A seeded
Gumbel draw added to the weight makes the highest scores a weighted sample
without replacement.

The ranks come from a distributed radix sort, least significant digit first: a
pass counts the digits of each block of rows, adds up the counts by digit and
block, and so knows where every row goes; rows of one digit and block keep their
order.  A block has a bounded number of rows, so no score is a hot key.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from newsboard.llm.common import fresh, landed
from newsboard.llm.decontaminate import WORD_BYTES

BUCKETS, LONGEST_RUN = 10_000, 2
PERCENT, LEAST_WORDS, SEED = 25, 20, 7
#: Rows of a block, and bits of a digit at most.
BLOCK_ROWS, DIGIT_BITS = 1 << 20, 11
_BYTES_AT_ONCE = 1 << 20


def feature_buckets(data: bytes, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the features that end in these words) of a UTF-8
    text, piece by piece: runs of 1 to ``longest`` words, joined by a space."""
    data = data.translate(WORD_BYTES)
    at, open_runs = 0, [[] for _ in range(longest - 1)]  # crc32 of the last runs of each length
    while at < len(data):
        end = data.find(b" ", at + _BYTES_AT_ONCE)
        end = len(data) if end < 0 else end
        words = data[at:end].split()
        at = end
        if not words:
            continue
        crcs = list(map(zlib.crc32, words))
        found = [crcs]
        spaced = [b" " + w for w in words]
        for k in range(longest - 1):
            before = open_runs[k] + crcs[:-1]  # a run goes on with each word but the first of the text
            open_runs[k] = crcs[-1:]
            crcs = list(map(zlib.crc32, spaced[len(spaced) - len(before) :], before))
            found.append(crcs)
            if not crcs:
                break
        yield len(words), np.fromiter((c for part in found for c in part), np.int64, sum(map(len, found))) % buckets


def bucket_counts(docs: DataFrame, text: str, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> np.ndarray:
    """How many features of all texts fall in each bucket.  Tasks count into an
    array, and what comes to the driver is one row per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for data in batch.column(0):
                for _, found in feature_buckets(data.as_py(), buckets, longest):
                    total += np.bincount(found, minlength=buckets)
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(total[k])], ["bucket", "n"])

    texts = docs.filter(F.col(text).isNotNull()).select(F.col(text).cast("binary"))
    out = np.zeros(buckets, np.int64)
    for r in texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, floored, by bucket."""
    n = len(corpus)
    of_corpus, of_target = float(corpus.sum() + n), float(target.sum() + n)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * of_corpus / ((s + 1) * of_target)))
            for s, t in zip(corpus.astype(float).tolist(), target.astype(float).tolist(), strict=True)
        ],
        np.int64,
    )


def gumbel(seed: int, doc_id: object) -> int:
    """Thousandths of a Gumbel draw, floored; depends on seed and id alone."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_documents(
    docs: DataFrame, weights: np.ndarray, id_col: str, text: str, seed: int, longest: int = LONGEST_RUN
) -> DataFrame:
    """(id, row, n_words, n_features, weight, score) per row of ``docs``, where
    ``row`` is a hash of the text."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket = sent.value
        for batch in batches:
            rows = []
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                n_words = n = total = 0
                for words, found in feature_buckets(data.as_py() or b"", len(by_bucket), longest):
                    n_words, n, total = n_words + words, n + len(found), total + int(by_bucket[found].sum())
                weight = total // n if n else 0
                rows.append((n_words, n, weight, weight + gumbel(seed, doc_id)))
            new = [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else ([],) * 4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *new], ["id", "row", "n_words", "n_features", "weight", "score"]
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("row"), F.col(text).cast("binary").alias("text"))
    return given.mapInArrow(score, f"id {id_type}, row long, n_words long, n_features long, weight long, score long")


def radix_sort(rows: DataFrame, keys: list[tuple[str, int]], place: str, block_rows: int = BLOCK_ROWS,
               digit_bits: int = DIGIT_BITS) -> DataFrame:
    """``rows`` with their rank from 0 in the column ``place``.

    ``keys`` are columns of unsigned integers with their numbers of bits, the
    most significant first.  Each holds the order in ``place`` that rows with
    equal keys keep: any number whose upper 31 bits name a part of the rows that
    one task can hold, as ``monotonically_increasing_id`` gives.  ``rows`` has to
    be a stored table, as every pass stores its own.
    """
    digit, block, n, before = fresh(rows, "_digit", "_block", "_n", "_before")
    now, number = rows, F.shiftright(F.col(place), 33)
    for name, bits in reversed(keys):
        passes = -(-bits // digit_bits)
        for k in range(passes):
            low, high = bits * k // passes, bits * (k + 1) // passes
            cut = F.shiftrightunsigned(F.col(name), low).bitwiseAND(F.lit((1 << (high - low)) - 1))
            now = landed(_counting_pass(now, cut, number, place, digit, block, n, before), "radix")
            number = F.floor(F.col(place) / block_rows)
    return now


def _counting_pass(rows, cut, number, place, digit, block, n, before) -> DataFrame:
    dealt = rows.withColumn(digit, cut).withColumn(block, number)
    counts = landed(dealt.groupBy(digit, block).agg(F.count("*").alias(n)), "digit-counts")
    earlier = (Window.unboundedPreceding, -1)
    # 2 ** DIGIT_BITS rows at most, in one task
    digits = counts.groupBy(digit).agg(F.sum(n).alias(n)).select(
        digit, F.coalesce(F.sum(n).over(Window.orderBy(digit).rowsBetween(*earlier)), F.lit(0)).alias(before)
    )
    inside = F.coalesce(F.sum(n).over(Window.partitionBy(digit).orderBy(block).rowsBetween(*earlier)), F.lit(0))
    starts = counts.select(digit, block, inside.alias(n)).join(F.broadcast(digits), digit).select(
        digit, block, (F.col(n) + F.col(before)).alias(before)
    )
    rank = F.row_number().over(Window.partitionBy(digit, block).orderBy(place)) - 1
    moved = dealt.withColumn(n, rank).join(starts, [digit, block])
    return moved.withColumn(place, F.col(n) + F.col(before)).select(*rows.columns)


def importance_ranks(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", target_text: str = "text",
    percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS,
    longest: int = LONGEST_RUN, block_rows: int = BLOCK_ROWS, digit_bits: int = DIGIT_BITS,
) -> DataFrame:
    """(id, row, n_words, n_features, weight, score, rank) per row of ``docs``.

    ``row`` is a hash of the text.  Of the N documents with ``least_words``
    words or more the floor(percent * N / 100) with the highest scores are
    drawn; ties go to the smaller id, a NULL id being the largest.  ``rank``
    counts the drawn ones from 1 and is NULL for all others.

    Texts that are NULL, empty or without words have no features and a weight
    of 0.  Rows that repeat are documents of their own; where id and score are
    equal they rank in the order in which they are read.  An empty ``target``
    leaves the smoothing only; no documents give no rows.  Ids are integers.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"ids are sorted by their digits and must be integers, not {kind}")
    weights = gains(bucket_counts(docs, text, buckets, longest), bucket_counts(target, target_text, buckets, longest))
    scored = score_documents(docs, weights, id_col, text, seed, longest)
    scored = landed(scored.withColumn("place", F.monotonically_increasing_id()), "scored")
    pool = scored.filter(F.col("n_words") >= least_words)
    least, most, low, high, n = pool.agg(F.min("id"), F.max("id"), F.min("score"), F.max("score"), F.count("*")).first()
    columns = ["id", "row", "n_words", "n_features", "weight", "score"]
    rest = scored.filter(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("long").alias("rank"))
    if not n:
        return rest
    span, ids = (most or 0) - (least or 0) + 1, F.col("id").cast("long")
    if span < 1 << 63:
        id_key, null_key = ids - F.lit(least or 0), F.lit(span).cast("long")
    else:  # the difference is no long: the digits of the id itself, its sign turned
        span, id_key, null_key = (1 << 64) - 1, ids.bitwiseXOR(F.lit(-(1 << 63))), F.lit(-1).cast("long")
    keyed = pool.withColumns({"score_key": F.lit(high) - F.col("score"), "id_key": F.coalesce(id_key, null_key)})
    keys = [("score_key", (high - low).bit_length()), ("id_key", span.bit_length())]
    ranked = radix_sort(keyed, keys, "place", block_rows, digit_bits)
    drawn = F.when(F.col("place") < n * percent // 100, F.col("place") + 1)
    return ranked.select(*columns, drawn.alias("rank")).unionByName(rest)


def drawn_documents(docs: DataFrame, ranks: DataFrame, id_col: str = "doc_id", text: str = "text", rank: str = "rank") -> DataFrame:
    """The rows of ``docs`` that ``importance_ranks`` drew, all their columns,
    with the rank in ``rank`` (a column of that name is replaced).  Rows that
    are equal in id and text stand for each other, so as many of them stay as
    were drawn; they meet in one task."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() == rank.lower()])
    row, ident, nth = fresh(docs, "_row", "_ident", "_nth")
    one = Window.partitionBy(ident, row)
    known = F.coalesce(F.concat(F.lit("="), F.col("id").cast("string")), F.lit("-"))
    won = ranks.filter(F.col("rank").isNotNull()).select(known.alias(ident), F.col("row").alias(row), F.col("rank").alias(rank))
    won = won.withColumn(nth, F.row_number().over(one.orderBy(rank)))
    mine = docs.withColumn(row, F.xxhash64(text)).withColumn(
        ident, F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("-"))
    )
    mine = mine.withColumn(nth, F.row_number().over(one.orderBy(F.lit(1))))
    return mine.join(won, [ident, row, nth]).select(*docs.columns, rank)
