"""SimHash near-dedup by anchor-point covering.

Fingerprints of 64 bits link at ``THRESHOLD`` or fewer differing bits.  The
bits are cut into three blocks, so two linked fingerprints differ in at most
one bit of some block.  Within a block the anchors are the codewords of a
perfect Hamming code of length 15 next to free bits: its covering radius is 1,
so every block value has a home anchor within 1.  A fingerprint is copied to
every anchor within covering radius plus block threshold, 1 + 1, and compared
there with the fingerprints at home.  If x and y differ in at most one bit of a
block, then y is within 2 of the home anchor of x: no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from newsboard.llm.common import HOT_SHARE, LOWER, UPPER, fresh, hot_join, landed, row_key
from newsboard.llm.components import components

SHINGLE = 4
SEED = 42
THRESHOLD = 4
#: (lowest bit, width) of the blocks; one more block than half the threshold
#: leaves at most one differing bit in one of them.
BLOCKS = ((0, 21), (21, 21), (42, 22))
CODE_BITS = 15
_PAIRS_AT_ONCE = 1 << 21
_LINKS_AT_ONCE = 1 << 19
_ROWS_AT_ONCE = 1 << 18
_ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def simhash(data: bytes | None, size: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit fingerprint of a UTF-8 text: a bit is 1 if it is set in over half
    of the XXH64 hashes of its word shingles, repeats included.  Fewer words
    than a shingle are one shingle; no words, or None, give 0."""
    words = (data or b"").translate(_ASCII_LOWER).split()
    if not words:
        return 0
    text = b" ".join(words)
    size = min(size, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    firsts = np.concatenate(([0], ends[:-1] + 1))
    total = np.zeros(64, np.int64)
    n = len(words) - size + 1
    for at in range(0, n, 1 << 15):
        until = min(n, at + (1 << 15))
        spans = zip(firsts[at:until].tolist(), ends[at + size - 1 : until + size - 1].tolist(), strict=True)
        h = np.array([xxhash.xxh64_intdigest(text[a:b], seed) for a, b in spans], ">u8")
        total += np.unpackbits(h.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big", signed=True)


@F.pandas_udf(LongType())
def _simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([simhash(x) for x in texts], dtype="int64")


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text column, as a signed 64-bit integer."""
    return _simhash(text.cast("binary"))


def _anchors(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) for all anchors within 2 of the block values; the first
    ``len(values)`` entries are the home anchors."""
    rows = np.arange(len(values))
    word = values & ((1 << CODE_BITS) - 1)
    syndrome = np.zeros(len(values), np.int64)
    for bit in range(CODE_BITS):
        syndrome ^= np.where(word >> bit & 1, bit + 1, 0)
    home = values ^ np.where(syndrome > 0, 1 << np.maximum(syndrome - 1, 0), 0)
    found, of = [home], [rows]
    free = range(CODE_BITS, width)
    for i in free:  # one free bit off, the nearest codeword beside it
        found.append(home ^ (1 << i))
        of.append(rows)
    codeword, other = np.flatnonzero(syndrome == 0), np.flatnonzero(syndrome > 0)
    for i in free:  # two free bits off
        for j in range(i + 1, width):
            found.append(values[codeword] ^ (1 << i) ^ (1 << j))
            of.append(codeword)
    for i in range(1, CODE_BITS + 1):  # two code bits whose positions add up to the syndrome
        j = syndrome[other] ^ i
        pair = (j > i) & (j <= CODE_BITS)
        at = other[pair]
        found.append(values[at] ^ (1 << (i - 1)) ^ (1 << (j[pair] - 1)))
        of.append(at)
    return np.concatenate(found), np.concatenate(of)


def replicas(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot, fingerprint, home) for all anchors that fingerprints go to."""
    out = []
    for block, (low, width) in enumerate(BLOCKS):
        values = (fps.view(np.uint64) >> np.uint64(low) & np.uint64((1 << width) - 1)).astype(np.int64)
        anchor, row = _anchors(values, width)
        out.append((anchor | block << 24, fps[row], np.arange(len(row)) < len(fps)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slot, fp, home = replicas(np.asarray(batch.column(0)))
        for at in range(0, len(slot), _ROWS_AT_ONCE):
            cut = slice(at, at + _ROWS_AT_ONCE)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot[cut].astype(np.int32)), pa.array(fp[cut]), pa.array(home[cut])], ["slot", "fp", "home"]
            )


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) for all nodes but the roots of the graph with edges a-b."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        least = np.minimum(root[x], root[y])
        if (root[x] == root[y]).all():
            break
        np.minimum.at(root, root[x], least)
        np.minimum.at(root, root[y], least)
        while (root[root] != root).any():
            root = root[root]
    off = root != np.arange(len(nodes))
    return nodes[off], nodes[root[off]]


def _close(fp: np.ndarray, first: np.ndarray, homes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between each row and the ``homes`` rows from ``first`` on."""
    ends = np.cumsum(homes)
    at = 0
    while at < len(fp):
        before = ends[at - 1] if at else 0
        until = max(at + 1, int(np.searchsorted(ends, before + _PAIRS_AT_ONCE, "right")))
        n = homes[at:until]
        guest = np.repeat(np.arange(at, until), n)
        nth = np.arange(len(guest)) - np.repeat(ends[at:until] - n - before, n)
        x, y = fp[guest], fp[first[guest] + nth]
        far = np.bitwise_count((x ^ y).view(np.uint64))
        near = (far > 0) & (far <= THRESHOLD)
        if near.any():
            yield x[near], y[near]
        at = until


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (group, fp, home) sorted by group with its homes first, to a
    spanning forest (u, v) of the links found.  A group may go on in the next
    batch: its homes are kept, its guests are compared and forgotten."""
    a, b, held = [], [], 0
    kept_group, kept = None, np.empty(0, np.int64)

    def settled():
        u, v = forest(np.concatenate(a), np.concatenate(b))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    for batch in batches:
        if not batch.num_rows:
            continue
        group, fp = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        home = batch.column(2).to_numpy(zero_copy_only=False)
        if kept_group is not None and group[0] == kept_group:  # homes seen before come first again
            group = np.concatenate([np.full(len(kept), kept_group), group])
            fp, home = np.concatenate([kept, fp]), np.concatenate([np.ones(len(kept), bool), home])
        starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        sizes = np.diff(np.append(starts, len(group)))
        homes = np.add.reduceat(home.astype(np.int64), starts)
        for x, y in _close(fp, np.repeat(starts, sizes), np.repeat(homes, sizes)):
            a.append(x)
            b.append(y)
            held += len(x)
            if held > _LINKS_AT_ONCE:
                u, v = forest(np.concatenate(a), np.concatenate(b))
                a, b, held = [u], [v], len(u)
                if held > _LINKS_AT_ONCE // 2:
                    yield settled()
                    a, b, held = [], [], 0
        kept_group, kept = group[-1], fp[starts[-1] : starts[-1] + homes[-1]]
    if held:
        yield settled()


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """Edges (u, v) that connect just what links of at most ``THRESHOLD`` bits
    connect, for distinct fingerprints (fp).

    Per task a spanning forest is returned, not all pairs of a group.  Anchors
    that hold more than ``HOT_SHARE`` of all homes are at most a thousand per
    block; their homes are dealt to parts and their guests copied to each part.
    """
    placed = landed(fps.select("fp").mapInArrow(_replicate, "slot int, fp bigint, home boolean"), "anchors")
    per_slot = placed.filter("home").groupBy("slot").agg(F.count("*").alias("n"))
    limit = max(64.0, HOT_SHARE * placed.filter("home").count())
    hot = per_slot.filter(F.col("n") > limit).select("slot", F.ceil(F.col("n") / limit).cast("int").alias("parts"))
    parts = F.coalesce("parts", F.lit(1))
    mine = F.pmod(F.xxhash64("fp"), parts).cast("int")
    # a home is also a guest of the parts that it is not at home in
    every = F.sequence(F.lit(0), parts - 1)
    spread = (
        placed.join(F.broadcast(hot), "slot", "left")
        .select("slot", "fp", "home", mine.alias("mine"), F.explode(every).alias("part"))
        .select(
            (F.col("slot").cast("bigint") * (1 << 24) + F.col("part")).alias("g"),
            "fp",
            (F.col("home") & (F.col("mine") == F.col("part"))).alias("home"),
        )
    )
    return (
        spread.repartition("g")
        .sortWithinPartitions("g", F.col("home").desc())
        .mapInArrow(_link, "u bigint, v bigint")
    )


def near_duplicates(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(``key``, fp, component, component_id) for each row of ``docs``:
    ``component`` is the least fingerprint (signed) linked to the row's own,
    directly or through others, ``component_id`` the least ``key`` of the
    component.

    Copies share a fingerprint and are joined, not compared, so a text with a
    third of all rows is one fingerprint.  A NULL text has no words and the
    fingerprint zero, as the empty text has.  NULL keys keep their rows and
    count for no ``component_id``, which is NULL if there is no other key;
    rows with equal keys stay apart.  No rows give no rows.  A key that is
    called like another column of the result (in any case) has ``_`` before
    its name there.
    """
    named_key = f"_{key}" if key.lower() in ("fp", "component", "component_id") else key
    own = landed(docs.select(F.col(key).alias("key"), fingerprint(F.col(text)).alias("fp")), "fingerprints")
    nodes = landed(own.groupBy("fp").agg(F.min("key").alias("first"), F.count("*").alias("rows")), "nodes")
    roots = components(landed(fingerprint_links(nodes), "links")).withColumnRenamed("node", "fp")
    rooted = landed(
        nodes.join(roots, "fp", "left").withColumn("component", F.coalesce("root", "fp")).drop("root"), "rooted"
    )
    least = rooted.groupBy("component").agg(F.min("first").alias("component_id"), F.count("*").alias("fps"))
    named = landed(hot_join(rooted, landed(least, "least"), "component", "fps"), "named")
    return (
        hot_join(own, named.select("fp", "component", "component_id", "rows"), "fp", "rows")
        .select(F.col("key").alias(named_key), "fp", "component", "component_id")
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` per component: that with the least id, NULL last,
    and of rows with that id the one with the least digest of all its columns."""
    row, rank = fresh(docs, "row", "rank")
    rows = docs.withColumn(row, row_key(*[F.col(c) for c in docs.columns]))
    ranked = rows.select(F.struct(F.col(id_col).isNull(), F.col(id_col), F.col(row).alias(row)).alias(rank), text)
    found = near_duplicates(ranked, rank, text)
    kept = found.filter(F.col(rank) == F.col("component_id")).select(F.col(f"{rank}.{row}").alias(row)).distinct()
    return rows.join(kept, row, "left_semi").dropDuplicates([row]).select(*docs.columns)
