"""Substring dedup by hashing of lines, paragraphs or words."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from newsboard.llm.common import LOWER, UPPER, fresh, hot_join, landed

#: Repeated text is removed from this many words on.
LEAST_WORDS = 30
#: Units in a row are hashed together until they have so many words, so that
#: a short unit is no evidence by itself.
HASHED_WORDS = 8
_ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_SPACE = r"[ \t-\r]"
#: What separates units: a line break; blank lines; or, for words, any white
#: space: a passage begins and ends at any word, whatever its surroundings and
#: its script.
BREAKS = {
    "line": re.compile(r"\n"),
    "paragraph": re.compile(rf"(?:{_SPACE}*\n){{2,}}"),
    "word": re.compile(rf"{_SPACE}+"),
}
_IS_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\f\r"))
#: Sequences that a task holds before it deals them out, and that a group of
#: digests holds on average.
_AT_ONCE, _PER_GROUP = 1 << 20, 1 << 21
_LEAST_GROUPS, _BYTES_PER_WORD = 12, 6
#: A digest with more occurrences than this among those held is hot: only the
#: first one goes to the digest's group, the others are repeats for certain.
_HOT = 16
_REPEAT, _KNOWN, _FIRST = 0, 1, 2
#: Bytes of a digest that travel.  With the bits that choose its group, a corpus
#: of 10^10 sequences has 0.1 pairs that agree by chance.
_DIGEST_BYTES = 7


def normalised(unit: str) -> list[bytes]:
    """Words of a unit: A-Z lower-cased, split at runs of white space."""
    return unit.encode().translate(_ASCII_LOWER).split()


def pieces(text: str, unit: str) -> list[tuple[int, int, bytes]]:
    """(start, number of words, digest) of all units that have words."""
    out, at = [], 0
    for gap in BREAKS[unit].finditer(text):
        out.append((at, gap.start()))
        at = gap.end()
    out.append((at, len(text)))
    found = []
    for start, end in out:
        words = normalised(text[start:end])
        if words:
            found.append((start, len(words), xxhash.xxh3_128_digest(b" ".join(words))))
    return found


def sequences(text: str, unit: str, hashed_words: int) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(first word, end word, start, cut, digest) of the shortest sequences of
    units with ``hashed_words`` words that begin or end at each unit; ``cut``
    is where the unit after the sequence begins."""
    units = pieces(text, unit)
    words = [0, *accumulate(n for _, n, _ in units)]
    starts = [*(s for s, _, _ in units), len(text)]

    def sequence(i: int, j: int) -> tuple[int, int, int, int, bytes]:
        digest = units[i][2] if j == i + 1 else xxhash.xxh3_128_digest(b"".join(u[2] for u in units[i:j]))
        return words[i], words[j], starts[i], starts[j], digest

    n, j, last = len(units), 0, None
    for i in range(n):
        j = max(j, i + 1)
        while j < n and words[j] - words[i] < hashed_words:
            j += 1
        enough = words[j] - words[i] >= hashed_words
        # ends that no sequence from here on is the shortest for
        for end in range(last + 1, j if enough else n + 1) if last else ():
            yield sequence(i - 1, end)
        if not enough:
            return
        yield sequence(i, j)
        last = j
    for end in range(last + 1, n + 1) if last else ():
        yield sequence(n - 1, end)


def word_sequences(text: str, hashed_words: int) -> tuple[np.ndarray, np.ndarray]:
    """``sequences`` of words, as arrays: (first word, words, start, cut) and
    the halves of the digests."""
    data = text.encode()
    raw = np.frombuffer(data, np.uint8)
    edge = np.diff(np.concatenate(([0], (~_IS_SPACE[raw]).astype(np.int8), [0])))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    n = max(0, len(begin) - hashed_words + 1)
    if not n:
        return np.empty((4, 0), np.int64), np.empty((2, 0), np.int64)
    joined = b" ".join(data.translate(_ASCII_LOWER).split())
    last = np.cumsum(end - begin + 1) - 1
    first = np.concatenate(([0], last[:-1] + 1))
    spans = zip(first[:n].tolist(), last[hashed_words - 1 :].tolist(), strict=True)
    digests = b"".join([xxhash.xxh3_128_digest(joined[a:z]) for a, z in spans])
    if len(data) > len(text):
        begin = (np.cumsum((raw & 0xC0) != 0x80) - 1)[begin]
    cut = np.append(begin, len(text))[hashed_words:]
    places = np.stack([np.arange(n), np.full(n, hashed_words), begin[:n], cut])
    return places, np.frombuffer(digests, np.int64).reshape(-1, 2).T


def _sequence_arrays(text: str, unit: str, hashed_words: int) -> tuple[np.ndarray, np.ndarray]:
    if unit == "word":
        return word_sequences(text, hashed_words)
    found = list(sequences(text, unit, hashed_words))
    places = np.array([(a, b - a, start, cut) for a, b, start, cut, _ in found], np.int64).reshape(-1, 4).T
    return places, np.frombuffer(b"".join(x[4] for x in found), np.int64).reshape(-1, 2).T


def _zigzag(steps: np.ndarray) -> np.ndarray:
    """Small numbers of both signs as small ones without a sign."""
    return (steps << 1) ^ (steps >> 31)


def _pack(first: np.ndarray, words: np.ndarray, begin: np.ndarray, cut: np.ndarray, *kept: np.ndarray) -> bytes:
    """Places as compressed differences of 32 bits, by byte: a sequence's start
    against what its first word lets expect, its cut against its start."""
    first, words, begin, cut, *kept = (c.astype(np.int32) for c in (first, words, begin, cut, *kept))
    columns = [first, words, begin - first * np.int32(_BYTES_PER_WORD), *kept]
    steps = [_zigzag(np.diff(c, prepend=np.int32(0))) for c in columns] + [cut - begin]
    return pa.compress(b"".join(c.view(np.uint8).reshape(-1, 4).T.tobytes() for c in steps), codec="zstd", asbytes=True)


def _unpack(data: bytes, rows: int, columns: int) -> np.ndarray:
    raw = pa.decompress(data, decompressed_size=4 * rows * columns, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(columns, 4, rows).transpose(0, 2, 1)
    codes = np.ascontiguousarray(planes).view("<u4")[..., 0]
    steps = (codes[:-1] >> 1).view(np.int32) ^ -(codes[:-1] & 1).view(np.int32)
    first, words, begin, *kept = np.cumsum(steps, axis=1, dtype=np.int32)
    begin = begin + first * np.int32(_BYTES_PER_WORD)
    return np.stack([first, words, begin, begin + codes[-1].view(np.int32), *kept])


def _pack_ids(ids: pa.Array) -> bytes:
    """Ids as differences by byte if they are integers, else as they are;
    compressed."""
    if not pa.types.is_integer(ids.type):
        batch, sink = pa.RecordBatch.from_arrays([ids], ["id"]), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(batch)
        return sink.getvalue().to_pybytes()
    nulls = np.packbits(np.asarray(ids.is_null())) if ids.null_count else np.empty(0, np.uint8)
    steps = np.diff(np.asarray(ids.cast(pa.int64()).fill_null(0)), prepend=np.int64(0))
    planes = ((steps << 1) ^ (steps >> 63)).view(np.uint8).reshape(-1, 8).T
    return pa.compress(planes.tobytes() + nulls.tobytes(), codec="zstd", asbytes=True)


def _unpack_ids(data: bytes, n: int, has_null: bool, kind: pa.DataType) -> pa.Array:
    if not pa.types.is_integer(kind):
        return pa.ipc.open_stream(data).read_all().column(0).combine_chunks().cast(kind)
    size = 8 * n + (-(-n // 8) if has_null else 0)
    raw = np.frombuffer(pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True), np.uint8)
    codes = np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view(np.uint64)[:, 0]
    values = np.cumsum((codes >> np.uint64(1)).view(np.int64) ^ -(codes & np.uint64(1)).view(np.int64))
    mask = np.unpackbits(raw[8 * n :], count=n).astype(bool) if has_null else None
    return pa.array(values, pa.int64(), mask=mask).cast(kind)


def _mixed(ids: pa.Array) -> np.ndarray:
    """The stand-in for a text's hash where integer ids tell documents apart."""
    plain = np.asarray(ids.cast(pa.int64()).fill_null(-1)).view(np.uint64)
    mixed = plain * np.uint64(0x9E3779B97F4A7C15)
    return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)


def _numbered(ids: pa.Array, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each document, an entry of each number): documents by id,
    NULL last, then row; equal ones share a number."""
    by_id = np.asarray(pc.rank(ids, sort_keys="ascending", null_placement="at_end", tiebreaker="dense")).astype(np.int64)
    order = np.lexsort((rows, by_id))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(by_id[order]) != 0) | (rows[order][1:] != rows[order][:-1])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, order[new]


def _shortened(digests: np.ndarray) -> bytes:
    return np.ascontiguousarray(digests).view(np.uint8).reshape(-1, 8)[:, :_DIGEST_BYTES].tobytes()


def _digests(cells: list[bytes]) -> np.ndarray:
    """Integers from the low bytes of digests, as ``_shortened`` gives them."""
    raw = np.frombuffer(b"".join(cells), np.uint8).reshape(-1, _DIGEST_BYTES)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :_DIGEST_BYTES] = raw
    return out.reshape(-1).view(np.int64)


_DEALT = ["part", "kind", "n_docs", "n_kept", "nulls", "ids", "rows", "sizes", "places", "digests"]
_SHAPE = ("part int, kind int, n_docs int, n_kept int, nulls boolean, ids binary, rows binary, sizes binary, "
          "places binary, digests binary")


def _dealt(
    part: np.ndarray, kind: int, doc: np.ndarray, places: list[np.ndarray], digests: np.ndarray | None,
    ids: pa.Array, rows: np.ndarray, alone: bool, kept: np.ndarray | None = None,
) -> Iterator[pa.RecordBatch]:
    """A row per part with its documents, and the places of each, which come
    in the order of documents.  Hashes of texts travel unless ids are ``alone``
    enough to tell documents apart."""
    if not len(part):
        return
    order = np.argsort(part, kind="stable")
    ends = np.flatnonzero(np.append(part[order][1:] != part[order][:-1], True)) + 1
    none = pa.nulls(0, ids.type)
    for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
        at = order[a:b]
        docs, sizes = np.unique(doc[at], return_counts=True)
        columns, origins = [c[at] for c in places], none
        if kept is not None:
            used, index = np.unique(kept[at], return_inverse=True)
            columns, origins = [*columns, index], ids.take(pa.array(used))
        given = ids.take(pa.array(docs))
        row = [
            int(part[at[0]]), kind, len(docs), len(origins), bool(given.null_count or origins.null_count),
            _pack_ids(pa.concat_arrays([given, origins])), b"" if alone else rows[docs].tobytes(),
            pa.compress(sizes.astype("<i4").tobytes(), codec="zstd", asbytes=True), _pack(*columns),
            b"" if digests is None else _shortened(digests[at]),
        ]
        kinds = [pa.int32()] * 4 + [pa.bool_()] + [pa.binary()] * 5
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], _DEALT)


def _taken(
    table: pa.Table, columns: int, kind: pa.DataType, alone: bool
) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(ids, rows, document of each place, places, digests, kept ids) of rows
    that ``_dealt`` made; the last column of places refers to the kept ids."""
    none = pa.nulls(0, kind)
    ids, kept, sizes, places, before = [none], [none], [np.empty(0, np.int64)], [np.empty((columns, 0), np.int32)], 0
    for r in table.select(["n_docs", "n_kept", "nulls", "ids", "sizes", "places"]).to_pylist():
        both = _unpack_ids(r["ids"], r["n_docs"] + r["n_kept"], r["nulls"], kind)
        ids.append(both[: r["n_docs"]])
        kept.append(both[r["n_docs"] :])
        raw = pa.decompress(r["sizes"], decompressed_size=4 * r["n_docs"], codec="zstd", asbytes=True)
        sizes.append(np.frombuffer(raw, "<i4").astype(np.int64))
        p = _unpack(r["places"], int(sizes[-1].sum()), columns)
        if columns == 6:
            p[-1] += before
            before += r["n_kept"]
        places.append(p)
    all_ids, sizes = pa.concat_arrays(ids), np.concatenate(sizes)
    rows = _mixed(all_ids) if alone else np.frombuffer(b"".join(table.column("rows").to_pylist()), np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    digests = _digests(table.column("digests").to_pylist())
    return all_ids, rows, doc, np.concatenate(places, axis=1), digests, pa.concat_arrays(kept)


def hashed_sequences(
    docs: DataFrame, id_col: str, text: str, unit: str, hashed_words: int, groups: int, alone: bool
) -> DataFrame:
    """The sequences of all texts, dealt to ``groups`` by digest; a document is
    its id and a hash of the text.  Of a digest that is hot in a task only the
    first occurrence goes to its group, marked by a kind of ``_FIRST``; the
    others are dealt by document, with a kind of ``_KNOWN``."""

    def dealt(held: list) -> Iterator[pa.RecordBatch]:
        ids, rows = pa.concat_arrays([x[0] for x in held]), np.array([x[1] for x in held], np.int64)
        number, entry = _numbered(ids, rows)
        held = [held[k] for k in entry]  # by rank, copies once
        ids, rows = ids.take(pa.array(entry)), rows[entry]
        rows = _mixed(ids) if alone else rows
        doc = np.repeat(np.arange(len(held)), [x[2].shape[1] for x in held])
        places, (h1, h2) = np.concatenate([x[2] for x in held], 1), np.concatenate([x[3] for x in held], 1)
        h1 = h1 & ((1 << 8 * _DIGEST_BYTES) - 1)
        order = np.argsort(h1, kind="stable")
        opens = np.append(True, h1[order][1:] != h1[order][:-1])[: len(order)]
        group = np.cumsum(opens) - 1
        first = order[opens][group]
        many = (np.bincount(group)[group] > _HOT) & (h2[order] == h2[first])
        kind = np.full(len(order), _REPEAT, np.int8)
        kind[order[many]] = _KNOWN
        kind[first[many]] = _FIRST
        for k in (_REPEAT, _FIRST, _KNOWN):
            at = np.flatnonzero(kind == k)
            part = (rows[doc[at]] if k == _KNOWN else h2[at]).view(np.uint64) % np.uint64(groups)
            yield from _dealt(part.astype(np.int64), k, doc[at], list(places[:, at]), h1[at], ids, rows, alone)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                places, halves = _sequence_arrays(batch.column(2)[k].as_py(), unit, hashed_words)
                if not places.shape[1]:
                    continue
                held.append((batch.column(1).slice(k, 1), batch.column(0)[k].as_py(), places.astype(np.int32), halves))
                n += places.shape[1]
                if n >= _AT_ONCE:
                    yield from dealt(held)
                    held, n = [], 0
        if held:
            yield from dealt(held)

    given = docs.filter(F.col(text).isNotNull()).select(
        F.xxhash64(text).alias("row"), F.col(id_col).alias("id"), F.col(text).alias("text")
    )
    return given.mapInArrow(cut, _SHAPE)


def _repeats_of(parts: int, kind: pa.DataType, alone: bool):
    """From the sequences of a group of digests to its repeats, dealt to
    ``parts`` by document, and the first place of each hot digest."""

    def settle(table: pa.Table) -> pa.Table:
        out = []
        known = table.filter(pc.equal(table.column("kind"), _KNOWN))
        if known.num_rows:
            ids, rows, doc, places, digests, _ = _taken(known, 4, kind, alone)
            part = (rows[doc].view(np.uint64) >> np.uint64(20)) % np.uint64(parts)
            none = np.zeros(len(doc), np.int64)
            order = np.argsort(doc, kind="stable")
            places = [c[order] for c in (*places, none)]
            out += _dealt(part.astype(np.int64)[order], _KNOWN, doc[order], [*places, none], digests[order], ids, rows, alone)
        met = table.filter(pc.not_equal(table.column("kind"), _KNOWN))
        if met.num_rows:
            ids, rows, doc, places, digests, _ = _taken(met, 4, kind, alone)
            hot = np.unique(_digests([
                d for d, k in zip(met.column("digests").to_pylist(), met.column("kind").to_pylist(), strict=True) if k == _FIRST
            ]))
            number, entry = _numbered(ids, rows)
            ids, rows, doc = ids.take(pa.array(entry)), rows[entry], number[doc]
            order = np.argsort(digests, kind="stable")
            same = digests[order][1:] == digests[order][:-1]
            many = np.append(same, False) | np.append(False, same)
            at = order[many | np.isin(digests[order], hot)] if len(hot) else order[many]
            at = at[np.lexsort((places[0][at], doc[at], digests[at]))]
            opens = np.append(True, digests[at][1:] != digests[at][:-1])[: len(at)]
            first = at[opens][np.cumsum(opens) - 1] if len(at) else at
            again = (doc[at] != doc[first]) | (places[0][at] != places[0][first])
            back = np.lexsort((places[0][at[again]], doc[at[again]]))
            at_, first_ = at[again][back], first[again][back]
            part = (rows[doc[at_]].view(np.uint64) >> np.uint64(20)) % np.uint64(parts)
            columns = [*places[:, at_], places[2][first_]]
            out += _dealt(part.astype(np.int64), _REPEAT, doc[at_], columns, None, ids, rows, alone, doc[first_])
            if len(hot):
                heads = at[opens & np.isin(digests[at], hot)]
                heads = heads[np.argsort(doc[heads], kind="stable")]
                columns = [*places[:, heads], places[2][heads], np.zeros(len(heads), np.int64)]
                out += _dealt(np.zeros(len(heads), np.int64), _FIRST, doc[heads], columns, digests[heads], ids, rows, alone)
        return pa.Table.from_batches(out) if out else table.slice(0, 0)

    return settle


def _runs_of(least_words: int, kind: pa.DataType, alone: bool):
    """From the repeats of some documents to their runs; ``h1`` is set where
    the place that was kept is that of a hot digest."""

    def settle(table: pa.Table) -> pa.Table:
        has = [pc.equal(table.column("kind"), k) for k in (_REPEAT, _KNOWN)]
        ids, rows, doc, places, _, kept = _taken(table.filter(has[0]), 6, kind, alone)
        ids2, rows2, doc2, places2, digests, _ = _taken(table.filter(has[1]), 6, kind, alone)
        number, entry = _numbered(all_ids := pa.concat_arrays([ids, ids2]), all_rows := np.concatenate([rows, rows2]))
        doc = number[np.concatenate([doc, doc2 + len(ids)])]
        places = np.concatenate([places, places2], 1)
        h1 = np.concatenate([np.zeros(places.shape[1] - len(digests), np.int64), digests])
        hot = np.arange(places.shape[1]) >= places.shape[1] - len(digests)
        end = places[0] + places[1]
        # of a sequence that both came to know, the one with its kept place
        order = np.lexsort((hot, end, places[0], doc))
        doc, places, h1, hot, end = doc[order], places[:, order], h1[order], hot[order], end[order]
        # one axis for all documents, with room between them
        room = doc * (int(end.max(initial=0)) + 2)
        reach = np.maximum.accumulate(room + end)
        opens = np.append(True, (room + places[0])[1:] > reach[:-1])[: len(doc)]
        begin = np.flatnonzero(opens)
        words = (np.maximum.reduceat(end, begin) if len(begin) else end) - places[0][begin]
        cut = np.maximum.reduceat(places[3], begin) if len(begin) else begin
        enough = words >= least_words
        begin, words, cut = begin[enough], words[enough], cut[enough]
        at = entry[doc[begin]]
        from_, lost = places[5][begin], hot[begin]
        return pa.Table.from_arrays(
            [
                pa.array(all_rows[at]), all_ids.take(pa.array(at)), pa.array(places[2][begin].astype(np.int32)),
                pa.array(cut.astype(np.int32)), pa.array(words.astype(np.int32)),
                kept.take(pa.array(from_, mask=lost)) if len(kept) else pa.nulls(len(at), kind),
                pa.array(places[4][begin].astype(np.int32), mask=lost), pa.array(h1[begin], mask=~lost),
            ],
            ["row", "id", "start", "cut", "n_words", "kept_id", "kept_start", "h1"],
        )

    return settle


def repeated_units(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", unit: str = "word",
    least_words: int = LEAST_WORDS, hashed_words: int = HASHED_WORDS,
) -> DataFrame:
    """The passages to remove: (row, id, start, cut, n_words, kept_id,
    kept_start), runs of units that all occur earlier.

    Units are lines, paragraphs (between blank lines) or words, with A-Z
    lower-cased and white space run together.  The shortest sequences with
    ``hashed_words`` words that begin or end at a unit are hashed.  Occurrences of a digest
    are ranked by id, then place in the document: the first stays, the others
    are repeats, also within one document.  Overlapping and touching repeats
    are one run; runs of ``least_words`` words or more are reported with code
    point offsets of the original text, and where the first of their sequences
    was kept.  ``cut`` is where the text after the run begins.  With words
    every sequence of ``hashed_words`` words is hashed, so a passage of
    ``least_words`` words that occurs earlier is found whatever surrounds it.

    NULL ids rank last.  Rows with equal id and text are one document: they
    lose the same passages.  NULL and empty texts have no units, no rows give
    no rows.  Sequences travel packed, a row per task's holding and group of
    digests; of a hot digest each holding sends one occurrence to its group.
    Integer ids that occur once name their documents alone; with others a hash
    of the text travels beside each id.
    """
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    groups = max(_LEAST_GROUPS, size // (_BYTES_PER_WORD * _PER_GROUP))
    id_type, kind = docs.schema[id_col].dataType.simpleString(), to_arrow_type(docs.schema[id_col].dataType)
    given = docs.filter(F.col(text).isNotNull()).select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    alone = pa.types.is_integer(kind) and given.groupBy("id").count().filter("count > 1").isEmpty()
    found = hashed_sequences(docs, id_col, text, unit, hashed_words, groups, alone)
    repeats = landed(found.groupBy("part").applyInArrow(_repeats_of(groups, kind, alone), _SHAPE), "repeats")
    runs = landed(
        repeats.filter(F.col("kind") != _FIRST).groupBy("part").applyInArrow(
            _runs_of(least_words, kind, alone),
            f"row long, id {id_type}, start int, cut int, n_words int, kept_id {id_type}, kept_start int, h1 long",
        ),
        "runs",
    )

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, _, doc, places, digests, _ = _taken(pa.Table.from_batches([batch]), 6, kind, alone)
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests), ids.take(pa.array(doc)), pa.array(places[2])], ["h1", "first_id", "first_start"]
            )

    first = repeats.filter(F.col("kind") == _FIRST).mapInArrow(firsts, f"h1 long, first_id {id_type}, first_start int")
    names = ["row", "id", "start", "cut", "n_words"]
    # runs that begin with the same hot digest may be many
    lost = runs.filter(F.col("h1").isNotNull())
    counts = lost.groupBy("h1").agg(F.count("*").alias("n"))
    late = hot_join(lost, landed(first.dropDuplicates(["h1"]).join(counts, "h1"), "hot-firsts"), "h1", "n")
    out = runs.filter(F.col("h1").isNull()).select(*names, "kept_id", "kept_start").unionByName(
        late.select(*names, F.col("first_id").alias("kept_id"), F.col("first_start").alias("kept_start"))
    )
    if not alone:
        return out
    hashes = given.select(F.xxhash64("text").alias("row"), F.col("id").alias("of"))
    return out.drop("row").join(hashes, F.col("id").eqNullSafe(F.col("of"))).select(*out.columns)


def remove_units(
    docs: DataFrame, removed: DataFrame, id_col: str = "doc_id", text: str = "text", kept: str = "kept_spans"
) -> DataFrame:
    """``docs`` without the passages of ``repeated_units``, and a column
    ``kept`` with the spans (start, end) of the original text that the new text
    is made of, so that every place can be traced back.  A document that loses
    all of its text keeps an empty one; a NULL text stays NULL with no spans.  A
    column of ``docs`` that is called like ``kept`` (in any case) is replaced."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() == kept.lower()])
    row, cuts = fresh(docs, "_unit_row", "_unit_cuts")
    by_row = removed.groupBy(F.col("id").alias(f"{row}_id"), F.col("row").alias(f"{row}_of")).agg(
        F.array_sort(F.collect_set(F.struct("start", "cut"))).alias(cuts)
    )
    whole = F.length(F.col(text))
    spans = "array<struct<start:int,end:int>>"

    def step(acc: Column, c: Column) -> Column:
        piece = F.array(F.struct(acc["at"].alias("start"), c["start"].alias("end")))
        more = F.when(c["start"] > acc["at"], F.concat(acc["out"], piece)).otherwise(acc["out"])
        return F.struct(c["cut"].alias("at"), more.alias("out"))

    def finish(acc: Column) -> Column:
        tail = F.array(F.struct(acc["at"].alias("start"), whole.alias("end")))
        return F.when(whole > acc["at"], F.concat(acc["out"], tail)).otherwise(acc["out"])

    start = F.struct(F.lit(0).alias("at"), F.array().cast(spans).alias("out"))
    none = F.array().cast("array<struct<start:int,cut:int>>")
    parts = F.transform(F.col(kept), lambda s: F.substring(F.col(text), s["start"] + 1, s["end"] - s["start"]))
    met = (F.col(row) == F.col(f"{row}_of")) & F.col(id_col).eqNullSafe(F.col(f"{row}_id"))
    joined = (
        docs.withColumn(row, F.xxhash64(text))
        .join(by_row, met, "left")
        .withColumn(kept, F.coalesce(F.aggregate(F.coalesce(cuts, none), start, step, finish), F.array().cast(spans)))
    )
    cut = F.when(F.col(cuts).isNull(), F.col(text)).otherwise(F.array_join(parts, ""))
    return joined.withColumn(text, cut).select(*docs.columns, kept)
