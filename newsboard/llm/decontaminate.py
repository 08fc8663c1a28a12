"""Benchmark decontamination by a prefix-filtered join of word windows.

A window is ``size`` consecutive words of a benchmark item; an item with fewer
words is one window.  A window is contained in a document only if all its
words are, in order, so a prefix of one word is enough: the one that is rarest
in the corpus.  Documents meet windows on that word; its place in the window
bounds where the window would start and end, and what is left is compared
word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from newsboard.llm.common import fresh, landed, row_key

WINDOW = 10
#: Windows that a pass over the documents joins; bounds the broadcast index.
BLOCK_WINDOWS = 100_000
_PAIRS_AT_ONCE = 1 << 20
#: Word characters stay, A-Z are lower-cased, all others end a word.
WORD_BYTES = bytes(
    ord(chr(b).lower()) if b < 128 and chr(b).isalpha() else b if b >= 128 or chr(b).isdigit() else 32
    for b in range(256)
)


def words_of(data: bytes) -> list[bytes]:
    """Words of a UTF-8 text: A-Z lower-cased, runs of 0-9, a-z and all
    characters beyond ASCII."""
    return data.translate(WORD_BYTES).split()


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """Distinct windows (item_id, words) of the items; items without words or
    with a NULL text have none.  Items without an id share a NULL one."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ws = [w.decode() for w in words_of(data.encode())]
                found = [ws[i : i + size] for i in range(max(1, len(ws) - size + 1))] if ws else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(found), pa.string()), pa.array(found, pa.list_(pa.string()))],
                    ["item_id", "words"],
                )

    return (
        items.filter(F.col(text).isNotNull()).select(F.col(item_id).cast("string").alias("item_id"), F.col(text).alias("text"))
        .mapInArrow(cut, "item_id string, words array<string>")
        .distinct()
    )


class WindowIndex:
    """Windows of a block by their rarest word, as arrays."""

    def __init__(self, windows: list[tuple[str | None, list[str]]], counts: dict[str, int]):
        items = sorted({i for i, _ in windows if i is not None})
        number = {i: k for k, i in enumerate(items)}
        texts: dict[tuple[str, ...], set[int]] = {}
        for item, words in windows:
            of = texts.setdefault(tuple(words), set())
            if item is not None:  # windows of items without an id hit, but name no item
                of.add(number[item])
        self.items = items
        self.word = {w.encode(): k + 1 for k, w in enumerate(sorted({w for t in texts for w in t}))}
        rows = []
        for t, of in texts.items():
            at = min(range(len(t)), key=lambda p: (counts.get(t[p], 0), t[p], p))
            rows.append((self.word[t[at].encode()], at, t, sorted(of)))
        rows.sort(key=lambda r: (r[0], r[1], r[2]))
        longest = max((len(t) for t in texts), default=1)
        self.at = np.array([r[1] for r in rows], np.int64)
        self.length = np.array([len(r[2]) for r in rows], np.int64)
        self.words = np.full((len(rows), longest), -1, np.int64)
        for k, r in enumerate(rows):
            self.words[k, : len(r[2])] = [self.word[w.encode()] for w in r[2]]
        self.of = [r[3] for r in rows]
        prefix = np.array([r[0] for r in rows], np.int64)
        self.first = np.searchsorted(prefix, np.arange(len(self.word) + 2))

    def find(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of all occurrences of all windows."""
        ids = np.fromiter(map(self.word.get, words, repeat(0)), np.int64, len(words))
        many = self.first[ids + 1] - self.first[ids]
        many[ids == 0] = 0
        places = np.flatnonzero(many)
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        ends = np.cumsum(many[places])
        a = 0
        while a < len(places):
            before = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, before + _PAIRS_AT_ONCE, "right")))
            n = many[places[a:b]]
            place = np.repeat(places[a:b], n)
            nth = np.arange(len(place)) - np.repeat(ends[a:b] - n - before, n)
            window = self.first[ids[place]] + nth
            start = place - self.at[window]
            fits = (start >= 0) & (start + self.length[window] <= len(ids))  # bounds by place and length
            window, start = window[fits], start[fits]
            for k in range(self.words.shape[1]):  # every step drops the windows that differ
                if not len(window):
                    break
                want = self.words[window, k]
                same = (want < 0) | (ids[np.minimum(start + k, len(ids) - 1)] == want)
                window, start = window[same], start[same]
            found.append((window, start))
            a = b
        return np.concatenate([w for w, _ in found]), np.concatenate([s for _, s in found])


def word_counts(docs: DataFrame, text: str, words: DataFrame) -> dict[str, int]:
    """How often each of the (bounded) ``words`` occurs in all of ``docs``."""
    vocabulary = {r[0].encode(): k + 1 for k, r in enumerate(words.collect())}
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = sent.value
        total = np.zeros(len(ids) + 1, np.int64)
        for batch in batches:
            for data in batch.column(0):
                ws = words_of(data.as_py())
                seen = np.fromiter(map(ids.get, ws, repeat(0)), np.int64, len(ws))
                total += np.bincount(seen, minlength=len(total))
        k = np.flatnonzero(total[1:]) + 1
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(total[k])], ["k", "n"])

    texts = docs.filter(F.col(text).isNotNull()).select(F.col(text).cast("binary"))
    sums = texts.mapInArrow(count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    by_number = {r["k"]: r["n"] for r in sums}
    return {w.decode(): by_number.get(k, 0) for w, k in vocabulary.items()}


def find_windows(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", size: int = WINDOW, block: int = BLOCK_WINDOWS,
) -> DataFrame:
    """(id, n_words, n_hit, items, spans) for each row of ``docs``: its words,
    how many of them lie inside an occurrence of an item's window, the ids of
    these items as sorted strings, and the hit runs as (first word, end).

    The benchmark may be of any size: its windows are taken in blocks of
    ``block``, which bounds what is broadcast, and one pass over the documents
    joins one block.  Documents are never shuffled when one block is enough;
    otherwise the runs of the passes are merged by a number given to each row.

    Windows of items with a NULL id count for ``n_hit`` and ``spans``; there is
    no id to list.  A NULL or empty text has no words and is clean.  Rows with equal or NULL
    ids stay rows of their own.  An empty benchmark hits nothing; no documents
    give no rows.
    """
    windows = landed(item_windows(items, item_id, item_text, size), "windows")
    total = windows.count()
    if total <= block:
        return _merged(_pass(docs, F.lit(""), windows, id_col, text))
    parts = -(-total // max(1, block // 2))  # a hash deals them out, so half a block each on average
    dealt = windows.withColumn("part", F.pmod(F.xxhash64("item_id", "words"), F.lit(parts)))
    docs = landed(docs.select(F.expr("uuid()").alias("_row"), F.col(id_col), F.col(text)), "numbered")
    found = None
    for k in range(parts):
        more = landed(_pass(docs, F.col("_row"), dealt.filter(F.col("part") == k), id_col, text), "pass")
        found = more if found is None else found.unionByName(more)
    return _merged(
        found.groupBy("row", "id", "n_words").agg(
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        )
    )


def _merged(found: DataFrame) -> DataFrame:
    """Sorted runs of all passes to runs that do not overlap, and their length."""
    empty = F.array().cast("array<struct<first:int,end:int>>")

    def add(runs, run):
        n = F.size(runs)
        last = F.try_element_at(runs, n)
        joined = F.struct(last["first"].alias("first"), F.greatest(last["end"], run["end"]).alias("end"))
        apart = (n == 0) | (last["end"] < run["first"])
        return F.when(apart, F.concat(runs, F.array(run))).otherwise(F.concat(F.slice(runs, 1, n - 1), F.array(joined)))

    runs = F.aggregate("spans", empty, add)
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, r: s + r["end"] - r["first"])
    return found.withColumn("spans", runs).select(  # later columns read the merged runs
        "id", "n_words", hit.alias("n_hit"), F.array_sort("items").alias("items"), "spans"
    )


def _pass(docs: DataFrame, row: Column, windows: DataFrame, id_col: str, text: str) -> DataFrame:
    """(row, id, n_words, items, spans) of one block of windows."""
    block = [(r["item_id"], r["words"]) for r in windows.select("item_id", "words").collect()]
    words = windows.select(F.explode("words").alias("w")).distinct()
    counts = word_counts(docs, text, words)
    sent = docs.sparkSession.sparkContext.broadcast(WindowIndex(block, counts))
    kinds = [pa.int64(), pa.list_(pa.string()), pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            n_words, items, spans = [], [], []
            for data in batch.column(2):
                ws = words_of(data.as_py() or b"")
                window, start = index.find(ws)
                n_words.append(len(ws))
                items.append(sorted({index.items[i] for w in np.unique(window).tolist() for i in index.of[w]}))
                edge = np.zeros(len(ws) + 1, np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + index.length[window], -1)
                inside = np.concatenate(([0], np.cumsum(edge) > 0)).astype(np.int8)
                turns = np.flatnonzero(np.diff(inside)).tolist()
                spans.append([{"first": a, "end": b} for a, b in zip(turns[::2], turns[1::2], strict=True)])
            new = [pa.array(x, k) for x, k in zip((n_words, items, spans), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *new], ["row", "id", "n_words", "items", "spans"]
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    shape = f"row string, id {id_type}, n_words long, items array<string>, spans array<struct<first:int,end:int>>"
    found = docs.select(row.alias("row"), F.col(id_col).alias("id"), F.col(text).cast("binary").alias("text"))
    return found.mapInArrow(search, shape)


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item, be its id NULL or not."""
    (row,) = fresh(docs, "row")
    rows = docs.withColumn(row, row_key(F.col(id_col), F.col(text)))
    found = find_windows(rows, items, row, text, **options)
    leaks = landed(found.filter(F.col("n_hit") > 0).select(F.col("id").alias(row)).distinct(), "leaks")
    return rows.join(leaks, row, "left_anti").select(*docs.columns)
