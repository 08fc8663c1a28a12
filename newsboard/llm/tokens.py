"""Token ids in binary files: fixed-width bit packing in blocks.

A file holds documents one after the other:

* head: magic, bits per id, ids per block;
* blocks: ids packed in ``bits`` bits each, lowest bit first, every block from
  a byte of its own, so numpy unpacks a block in one call;
* offset of every block; for every document the end of its ids, its id and
  whether that is NULL;
* tail: numbers of blocks, documents and ids, position of the offsets, magic.

Any document can be read with the tail, two offsets and its blocks.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from newsboard.llm.common import landed, open_for_read, open_for_write
from newsboard.plans.storage import shared_dir

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 26
CHUNK_IDS = 1 << 20
CHUNKS_PER_TASK = 8
CACHED_PIECES = 250_000
MAGIC = b"IDSBITS1"
HEAD = struct.Struct("<8sII")
TAIL = struct.Struct("<QQQQ8s")


def bits_for(vocabulary: int) -> int:
    """Least number of bits that hold the ids 0 .. vocabulary - 1."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, lowest bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(raw, axis=1, count=bits, bitorder="little"), bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first ``n`` ids of a block."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype("<u4")
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return np.packbits(np.pad(flat, ((0, 0), (0, 32 - bits))), axis=1, bitorder="little").view("<u4").ravel()


class _Pieces(dict):
    """Ids of a pre-token as little-endian bytes; unknown ones are encoded."""

    def __init__(self, tokenizer):
        self.model = tokenizer.model
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        self.chars = {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(rest)}

    def __missing__(self, piece: str) -> bytes:
        word = piece if piece.isascii() else "".join(map(self.chars.__getitem__, piece.encode()))
        ids = np.array([t.id for t in self.model.tokenize(word)], "<u4").tobytes()
        if len(self) >= CACHED_PIECES:
            self.clear()
        self[piece] = ids
        return ids


#: How the word BPE vocabulary prepares a text, the only way that
#: ``WordEncoder`` may look words up for.
_PREPARED = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "truncation": None,
    "padding": None,
}


def words_apart(definition: str) -> bool:
    """Whether a tokenizer file prepares texts in the way that ``WordEncoder``
    knows, and its added tokens all hold a character that is not plain."""
    parts = json.loads(definition)
    return (
        all(parts.get(k) == v for k, v in _PREPARED.items())
        and parts["model"].get("type") == "BPE" and not parts["model"].get("dropout")
        and all("<" in t["content"] and not re.search(r"\s", t["content"]) for t in parts.get("added_tokens") or [])
    )


class WordEncoder:
    """Ids of texts by the word BPE vocabulary, as its tokenizer gives them.
    Texts for a vocabulary that prepares them in another way go to its
    tokenizer whole.

    Its pre-tokens are encoded apart from each other, so the ids of one that
    was seen before are looked up.  That path takes only characters whose
    normal form, lower case and class are plain; a word with any other
    character goes to the tokenizer as it stands.  White space ends a word in
    either case.
    """

    _PLAIN = "\t\n\x0b\x0c\r\x20-;=-~\xa1\xa7\xab\xb0\xb6\xbb\xbf-įı-ňŊ-ž–—‘’“”…€"
    _ODD = re.compile(f"[^{_PLAIN}]")
    _PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")

    def __init__(self, path: str | None = None, definition: str | None = None):
        from tokenizers import Tokenizer

        definition = definition or read_definition(path)
        self.tokenizer, self.apart = Tokenizer.from_str(definition), words_apart(definition)
        self.pieces = _Pieces(self.tokenizer)
        self.ids_of = self.pieces.__getitem__

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.ids_of, self._PIECE.findall(text.lower())))

    def encode(self, text: str) -> bytes:
        """All ids of a text as little-endian unsigned 32-bit integers."""
        if not self.apart:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if not self._ODD.search(text):
            return self._plain(text)
        out = []
        for word in re.findall(r"[^ \t-\r]+", text):
            if self._ODD.search(word):
                ids = self.tokenizer.encode(word, add_special_tokens=False).ids
                out.append(np.array(ids, "<u4").tobytes())
            else:
                out.append(self._plain(word))
        return b"".join(out)


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_definition(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(definition: str) -> WordEncoder:
    """The encoder of this Python worker."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(definition=definition)
    return _ENCODERS[key]


class IdFile:
    """Writes one file; memory is a block and 17 bytes a document."""

    def __init__(self, uri: str, bits: int, block_ids: int = BLOCK_IDS):
        self.uri, self.bits, self.block_ids = uri, bits, block_ids
        self.out = open_for_write(uri)
        self.out.write(HEAD.pack(MAGIC, bits, block_ids))
        self.at, self.offsets, self.ends, self.doc_ids, self.nulls = HEAD.size, [], [], [], []
        self.waiting, self.n_waiting, self.n_ids = [], 0, 0

    def _blocks(self, whole: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, "<u4")
        upto = len(ids) if whole else len(ids) // self.block_ids * self.block_ids
        for a in range(0, upto, self.block_ids):
            data = pack(ids[a : min(a + self.block_ids, upto)], self.bits)
            self.offsets.append(self.at)
            self.out.write(data)
            self.at += len(data)
        self.waiting, self.n_waiting = [ids[upto:]], len(ids) - upto

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        self.ends.append(self.n_ids)
        self.doc_ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        if self.n_waiting >= self.block_ids:
            self._blocks(False)

    def close(self) -> None:
        self._blocks(True)
        for values, kind in ((self.offsets, "<u8"), (self.ends, "<u8"), (self.doc_ids, "<i8"), (self.nulls, "u1")):
            self.out.write(np.array(values, kind).tobytes())
        self.out.write(TAIL.pack(len(self.offsets), len(self.ends), self.n_ids, self.at, MAGIC))
        self.out.close()


def read_docs(uri: str, first: int, until: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, start in the file, ids) of the documents first .. until - 1."""
    with open_for_read(uri) as f:
        size = f.size()
        n_blocks, n_docs, n_ids, index, magic = TAIL.unpack(f.read_at(TAIL.size, size - TAIL.size))
        head, bits, block_ids = HEAD.unpack(f.read_at(HEAD.size, 0))
        if magic != MAGIC or head != MAGIC:
            raise ValueError(f"{uri} is not a file of ids")

        def column(at: int, kind: str, a: int, b: int) -> np.ndarray:
            width = np.dtype(kind).itemsize
            return np.frombuffer(f.read_at((b - a) * width, at + a * width), kind)

        ends_at = index + 8 * n_blocks
        ends = column(ends_at, "<u8", first, until).astype(np.int64)
        start = int(column(ends_at, "<u8", first - 1, first)[0]) if first else 0
        doc_ids = column(ends_at + 8 * n_docs, "<i8", first, until)
        nulls = column(ends_at + 16 * n_docs, "u1", first, until)
        block, ids = -1, np.empty(0, "<u4")
        for doc_id, null, end in zip(doc_ids.tolist(), nulls.tolist(), ends.tolist(), strict=True):
            parts, at = [], start
            while at < end:
                if at // block_ids != block:
                    block = at // block_ids
                    a, b = (int(x) for x in np.append(column(index, "<u8", block, min(block + 2, n_blocks)), index)[:2])
                    ids = unpack(f.read_at(b - a, a), min(block_ids, n_ids - block * block_ids), bits)
                upto = min(end, (block + 1) * block_ids)
                parts.append(ids[at - block * block_ids : upto - block * block_ids])
                at = upto
            yield (None if null else doc_id), start, np.concatenate(parts) if parts else ids[:0]
            start = end


def write_ids(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", vocabulary: str | None = None,
    end_id: int = END_ID, bits: int | None = None, file_ids: int = FILE_IDS, chunk_ids: int = CHUNK_IDS,
) -> DataFrame:
    """Encode every whole text and write its ids, with ``end_id`` after each
    document, to files of the shared folder; returns their index.

    Files follow each other in ascending ``id_col`` (NULL first; equal ids in
    the order of their texts' hashes, so that reruns agree).  Rows that agree
    in both are dealt to as many ranges as they fill.  ``vocabulary`` is a
    tokenizer file of the driver; its content is sent to the tasks.  The index has a row per chunk of about ``chunk_ids`` ids:
    path, first, until (documents of the file), n_ids, and start: the number
    of ids in all documents before it.

    A task writes its range of ids to new files with names of their own and
    the index names them; a task that is run again writes others, and files of
    a lost attempt are in no index.  A NULL text is empty: its ids are just
    ``end_id``.  No rows give no files and an empty index.
    """
    from tokenizers import Tokenizer

    definition = read_definition(vocabulary or vocabulary_path(VOCABULARY))
    bits = bits or bits_for(Tokenizer.from_str(definition).get_vocab_size())
    sent = docs.sparkSession.sparkContext.broadcast(definition)
    folder = shared_dir(docs.sparkSession, "ids")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        enc, end = encoder(sent.value), np.array([end_id], "<u4").tobytes()
        rows, file, n_files = [], None, 0

        def cut():
            first = rows[-1]["until"] if rows and rows[-1]["path"] == file.uri else 0
            before = rows[-1]["file_start"] + rows[-1]["n_ids"] if first else 0
            if len(file.ends) > first:
                rows.append({"path": file.uri, "task": task, "file": n_files, "first": first, "until": len(file.ends),
                             "file_start": before, "n_ids": file.n_ids - before})

        for batch in batches:
            for doc_id, data in zip(batch.column(0), batch.column(1), strict=True):
                if file is None:
                    file = IdFile(f"{folder}/{task:06d}-{uuid.uuid4().hex}.ids", bits)
                    since = 0
                file.add(doc_id.as_py(), np.frombuffer(enc.encode(data.as_py() or "") + end, "<u4"))
                if file.n_ids - since >= chunk_ids:
                    cut()
                    since = file.n_ids
                if file.n_ids >= file_ids:
                    cut()
                    file.close()
                    file, n_files = None, n_files + 1
        if file is not None:
            cut()
            file.close()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
                [("path", pa.string()), ("task", pa.int32()), ("file", pa.int32()), ("first", pa.int64()),
                 ("until", pa.int64()), ("file_start", pa.int64()), ("n_ids", pa.int64())]))

    shape = "path string, task int, file int, first long, until long, file_start long, n_ids long"
    index = landed(
        docs.select(
            F.col(id_col).cast("bigint").alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"),
            F.monotonically_increasing_id().alias("copy"),  # rows that agree so far are alike
        )
        .repartitionByRange(F.col("id").asc_nulls_first(), "tie", "copy")
        .sortWithinPartitions(F.col("id").asc_nulls_first(), "tie")
        .mapInArrow(write, shape),
        "ids-index",
    )
    files = index.groupBy("path", "task", "file").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("task", "file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    bases = files.select("path", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return (
        index.join(bases, "path")
        .withColumn("start", F.col("base") + F.col("file_start"))
        .select("path", "first", "until", "n_ids", "start")
    )


def read_ids(index: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of all documents of an index that
    ``write_ids`` made; ids are little-endian unsigned 32-bit integers.

    Tasks get ``CHUNKS_PER_TASK`` chunks of the index each, dealt evenly.
    """
    tasks = max(1, -(-index.count() // CHUNKS_PER_TASK))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "ids"]
        for batch in batches:
            for chunk in batch.to_pylist():
                out, held, shift = [], 0, None
                for doc_id, at, ids in read_docs(chunk["path"], chunk["first"], chunk["until"]):
                    shift = chunk["start"] - at if shift is None else shift
                    out.append((doc_id, at + shift, len(ids), ids.tobytes()))
                    held += len(ids)
                    if held >= CHUNK_IDS:
                        yield _batch(out, names)
                        out, held = [], 0
                if out:
                    yield _batch(out, names)

    return index.repartition(tasks).mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
