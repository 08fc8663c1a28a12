"""Spelling variants: search schemes on FM-indexes of a delimited vocabulary.

Two words are near if one code point is inserted, deleted or replaced.  One
such error leaves a half of the longer word as it is, so two schemes find every
pair: match the second half and extend to the left over the first one, or match
the first half and extend to the right over the second one, in both cases with
one error on the way to the delimiter.  The two directions of the index are the
suffix ranks of the words and those of the reversed words.  Both schemes begin
at a delimiter and extend in one direction only, so a group of words builds
just the direction that its scheme reads.

Words that share a half share their first or last code points: the vocabulary
is dealt to groups by these, once for each scheme, and no word is searched for
in any other group.  Groups have a bounded number of words; code points that
more words share are split into cells of indexed and searched words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from newsboard.llm.common import LOWER, UPPER, hot_join, landed

LEAST_CHARS, LEAST_COUNT, RATIO, ONE_IN = 6, 5, 5, 199
#: Words of a group on average; beyond this the words of a key are split.
GROUP_WORDS = 1 << 15
_QUERIES_AT_ONCE, _HELD_WORDS, _CHARS_AT_ONCE, _POSITIONS_AT_ONCE = 1 << 13, 1 << 18, 1 << 20, 1 << 22
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_REST = re.compile("[A-Za-zÀ-ÿ]*")
_ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_LEFT, _RIGHT = 0, 1
_INDEXED, _SEARCHED, _BOTH = 1, 2, 3


def _slices(text: str) -> Iterator[str]:
    """A text in pieces that cut no run of letters."""
    at = 0
    while at < len(text):
        end = at + _CHARS_AT_ONCE
        if end < len(text):
            end = _REST.match(text, end).end()
        yield text[at:end]
        at = end


def add_words(counts: Counter, doc_id: object, text: str, least_chars: int, one_in: int) -> None:
    """Count the words of a text: runs of letters with A-Z lower-cased.  A run
    whose crc32 with the id is divisible by ``one_in`` lacks a code point."""
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for piece in _slices(text):
        lowered = piece.encode().translate(_ASCII_LOWER).decode()
        for run, n in Counter(_RUN.findall(lowered)).items():
            if len(run) < least_chars:
                continue
            h = zlib.crc32(run.encode(), seed)
            if h % one_in == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
                if len(run) < least_chars:
                    continue
            counts[run] += n


def vocabulary(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT, one_in: int = ONE_IN,
) -> DataFrame:
    """(word, n): words of at least ``least_chars`` code points that occur
    ``least_count`` times or more in all texts.

    Each task counts before the shuffle.  A NULL or empty text has no words, a
    NULL id counts as an empty one; rows that repeat count each time.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
            )
            held.clear()
            return out

        for batch in batches:
            for k in range(batch.num_rows):
                add_words(held, batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), least_chars, one_in)
                if len(held) > _HELD_WORDS:
                    yield flush()
        yield flush()

    given = docs.filter(F.col(text).isNotNull()).select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    sums = given.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return sums.filter(F.col("n") >= least_count)


class SuffixRanks:
    """One direction of the index: the words, each with a delimiter of its own
    behind it, as the letters before the suffixes in their order.

    An interval [lo, hi) of suffix ranks stands for all words that go on with
    what was matched; ``extend`` puts a letter before it.
    """

    def __init__(self, words: list[np.ndarray], letters: int):
        lengths = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(lengths + 1) - 1
        text = np.zeros(int(ends[-1]) + 1 if len(words) else 0, np.int64)
        is_letter = np.ones(len(text), bool)
        is_letter[ends] = False
        if len(words):
            text[is_letter] = np.concatenate(words)
        self.words, self.letters, self.size = len(words), letters, len(text)
        order = self._sorted(text, is_letter)
        self.before = text[order - 1]  # the text is a ring: a delimiter comes before each word
        by_letter = np.argsort(self.before, kind="stable")
        self.ranks = self.before[by_letter] * (self.size + 1) + by_letter
        #: ranks of whole words, and which words these are
        self.whole = by_letter[: self.words]
        self.word_at = np.searchsorted(ends, order[self.whole])

    def _sorted(self, text: np.ndarray, is_letter: np.ndarray) -> np.ndarray:
        """Suffixes in order, by ranks of prefixes that double in length; the
        delimiters differ, so no comparison goes beyond one."""
        rank = np.where(is_letter, text + self.words, np.cumsum(~is_letter) - 1)
        width = 1
        while True:
            ahead = np.full(self.size, -1, np.int64)
            ahead[: max(0, self.size - width)] = rank[width:]
            key = rank * (self.size + self.letters + 2) + ahead + 1
            order = np.argsort(key, kind="stable")
            steps = np.diff(key[order]) != 0
            if steps.all():
                return order
            rank = np.empty(self.size, np.int64)
            rank[order] = np.concatenate(([0], np.cumsum(steps)))
            width *= 2

    def extend(self, lo: np.ndarray, hi: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = letter * (self.size + 1)
        return np.searchsorted(self.ranks, base + lo), np.searchsorted(self.ranks, base + hi)

    def found(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The word that an interval matches as a whole, or -1."""
        k = np.searchsorted(self.whole, lo)
        there = k < np.searchsorted(self.whole, hi)
        return np.where(there, self.word_at[np.minimum(k, max(0, self.words - 1))], -1)

    def letters_before(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval, letter): the distinct letters before each interval."""
        wide = hi - lo > 64 * self.letters
        states, letters = [np.repeat(np.flatnonzero(wide), self.letters)], [np.tile(np.arange(1, self.letters + 1), wide.sum())]
        narrow = np.flatnonzero(~wide)
        ends = np.cumsum((hi - lo)[narrow])
        a = 0
        while a < len(narrow):
            done = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, done + _POSITIONS_AT_ONCE, "right")))
            at = narrow[a:b]
            sizes = (hi - lo)[at]
            place = np.arange(int(sizes.sum())) + np.repeat(lo[at] - (np.cumsum(sizes) - sizes), sizes)
            seen = np.unique(np.repeat(at, sizes) * (self.letters + 1) + self.before[place])
            state, letter = np.divmod(seen, self.letters + 1)
            states.append(state[letter > 0])
            letters.append(letter[letter > 0])
            a = b
        return np.concatenate(states), np.concatenate(letters)


def search(
    index: SuffixRanks, words: list[np.ndarray], free: np.ndarray, first_of_run_is_last: bool
) -> tuple[np.ndarray, np.ndarray]:
    """(searched word, indexed word) that differ by one error in the first
    ``free`` letters of the searched word, what is behind them being equal.

    A word is matched from its last letter on.  The error is a letter replaced
    by a greater one, or a letter left out; the other directions of both are
    found from the other word.  Of equal letters in a row the one that comes
    first in the word is left out, so every pair is found once;
    ``first_of_run_is_last`` tells that the words are given reversed.
    """
    lengths = np.array([len(w) for w in words], np.int64)
    opens = np.cumsum(lengths) - lengths
    codes = np.concatenate(words) if words else np.empty(0, np.int64)
    # may the letter at a place be left out: it has no equal on the side of the word's begin
    same = np.append(codes[1:] == codes[:-1], False)
    inner = np.ones(len(codes), bool)
    inner[opens + lengths - 1] = False
    same &= inner
    leave = ~same if first_of_run_is_last else ~np.concatenate(([False], same[:-1]))[: len(codes)]

    q = np.arange(len(words))
    left, lo, hi = lengths.copy(), np.zeros(len(words), np.int64), np.full(len(words), index.words, np.int64)
    while True:  # the half that has to be equal
        go = np.flatnonzero(left > free[q])
        if not len(go):
            break
        lo[go], hi[go] = index.extend(lo[go], hi[go], codes[opens[q[go]] + left[go] - 1])
        left[go] -= 1
        alive = lo < hi
        q, left, lo, hi = q[alive], left[alive], lo[alive], hi[alive]
    error = np.zeros(len(q), bool)
    out_q, out_w = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while len(q):
        done = left == 0
        ends = done & error
        word = index.found(lo[ends], hi[ends])
        out_q.append(q[ends][word >= 0])
        out_w.append(word[word >= 0])
        q, left, lo, hi, error = (x[~done] for x in (q, left, lo, hi, error))
        at = opens[q] + left - 1
        code = codes[at]
        new_lo, new_hi = index.extend(lo, hi, code)
        alive = new_lo < new_hi
        states = [(q[alive], left[alive] - 1, new_lo[alive], new_hi[alive], error[alive])]
        clean = np.flatnonzero(~error)
        if len(clean):
            drop = clean[leave[at[clean]]]
            states.append((q[drop], left[drop] - 1, lo[drop], hi[drop], np.ones(len(drop), bool)))
            # words that have matched the same letters share an interval
            spans, of = np.unique(lo[clean] * (index.size + 1) + hi[clean], return_inverse=True)
            span, letter = index.letters_before(*np.divmod(spans, index.size + 1))
            letter = letter[np.argsort(span, kind="stable")]
            many = np.bincount(span, minlength=len(spans))
            first = np.cumsum(many) - many
            n = many[of]
            who = np.repeat(clean, n)
            nth = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
            other = letter[np.repeat(first[of], n) + nth]
            greater = other > code[who]
            who, other = who[greater], other[greater]
            new_lo, new_hi = index.extend(lo[who], hi[who], other)
            alive = new_lo < new_hi
            who = who[alive]
            states.append((q[who], left[who] - 1, new_lo[alive], new_hi[alive], np.ones(len(who), bool)))
        q, left, lo, hi, error = (np.concatenate(x) for x in zip(*states, strict=True))
    return np.concatenate(out_q), np.concatenate(out_w)


def near_pairs(indexed: list[str], searched: list[str], side: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(searched, indexed) numbers of near words of one scheme, in blocks:
    ``_LEFT`` has the second halves equal, ``_RIGHT`` the first ones."""
    points = [np.frombuffer(w.encode("utf-32-le"), "<u4") for w in (*indexed, *searched)]
    alphabet, codes = np.unique(np.concatenate(points), return_inverse=True) if points else (np.empty(0), np.empty(0))
    ends = np.cumsum([len(p) for p in points])
    words = np.split(codes.astype(np.int64) + 1, ends[:-1]) if points else []
    if side == _RIGHT:
        words = [w[::-1] for w in words]
    index, queries = SuffixRanks(words[: len(indexed)], len(alphabet)), words[len(indexed) :]
    for a in range(0, len(queries), _QUERIES_AT_ONCE):
        some = queries[a : a + _QUERIES_AT_ONCE]
        length = np.array([len(w) for w in some], np.int64)
        free = length // 2 if side == _LEFT else length - length // 2
        q, w = search(index, some, free, side == _RIGHT)
        yield q + a, w


def _dealt(words: DataFrame, key_chars: int, group_words: int) -> DataFrame:
    """Words by scheme and group (side, bucket, row, col) with their role."""
    ends = F.array(
        F.struct(F.lit(_LEFT).alias("side"), F.right("word", F.lit(key_chars)).alias("key")),
        F.struct(F.lit(_RIGHT).alias("side"), F.left("word", F.lit(key_chars)).alias("key")),
    )
    keyed = words.select("word", "n", F.explode(ends).alias("e")).select("word", "n", "e.side", "e.key")
    total = words.count()
    groups = max(1, -(-total // group_words))
    # at most total / group_words keys of a side by arithmetic
    hot = (
        keyed.groupBy("side", "key").agg(F.count("*").alias("_n")).filter(F.col("_n") > group_words)
        .select("side", "key", F.ceil(F.col("_n") / group_words).cast("int").alias("_cells"))
    )
    with_cells = keyed.join(F.broadcast(landed(hot, "hot-ends")), ["side", "key"], "left")
    mine = F.pmod(F.xxhash64("word"), F.col("_cells")).cast("int")
    cell = lambda row, col, role: F.struct(
        row.alias("row"), col.alias("col"), F.lit(role).alias("role"))
    every = F.sequence(F.lit(0), F.col("_cells") - 1)
    split = F.concat(
        F.transform(every, lambda k: cell(mine, k, _INDEXED)), F.transform(every, lambda k: cell(k, mine, _SEARCHED))
    )
    cells = F.when(F.col("_cells").isNull(), F.array(cell(F.lit(-1), F.lit(-1), _BOTH))).otherwise(split)
    bucket = F.when(F.col("_cells").isNull(), F.pmod(F.xxhash64("key"), F.lit(groups))).otherwise(F.xxhash64("key"))
    dealt = with_cells.select("side", bucket.alias("bucket"), F.explode(cells).alias("c"), "word", "n").select(
        "side", "bucket", "c.row", "c.col", "c.role", "word", "n"
    )
    # The number is given, so that adaptive execution does not put the groups,
    # which are small but take long, into a few tasks.
    return dealt.repartition(2 * groups, "side", "bucket", "row", "col")


def near_words(
    words: DataFrame, least_chars: int = LEAST_CHARS, group_words: int = GROUP_WORDS
) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of near words, once.

    ``words`` has distinct words of at least ``least_chars`` code points, with
    a count n; any code points may occur.  No words or one word give no rows.
    """

    def met(table: pa.Table) -> pa.Table:
        side = table.column("side")[0].as_py()
        role, word, n = (table.column(c).to_numpy(zero_copy_only=False) for c in ("role", "word", "n"))
        indexed, searched = np.flatnonzero(role & _INDEXED), np.flatnonzero(role & _SEARCHED)
        out = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        if len(indexed):
            out += near_pairs(word[indexed].tolist(), word[searched].tolist(), side)
        a, b = (np.concatenate(x) for x in zip(*out, strict=True))
        a, b = searched[a], indexed[b]
        a, b = np.concatenate([a, b]), np.concatenate([b, a])
        taken = lambda c, k: table.column(c).take(pa.array(k))
        return pa.Table.from_arrays(
            [taken("word", a), taken("n", a), taken("word", b), taken("n", b)], ["word", "n", "near", "near_n"]
        )

    dealt = _dealt(words.select("word", "n"), least_chars // 2, group_words)
    return dealt.groupBy("side", "bucket", "row", "col").applyInArrow(
        met, "word string, n long, near string, near_n long"
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each chain of forms, by doubling the steps.
    Counts grow along a chain by the ratio, so there is an end and the rounds
    are few; words that share a form are a hot key and joined as such."""
    now = landed(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        sizes = now.groupBy("root").agg(F.count("*").alias("_rows"))
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        steps = landed(ahead.join(sizes, "root"), "steps")
        if steps.isEmpty():
            return now
        joined = hot_join(now, steps, "root", "_rows", "left")
        now = landed(joined.select("word", F.coalesce("_next", "root").alias("root")), "roots")


def variant_groups(
    words: DataFrame, least_chars: int = LEAST_CHARS, ratio: int = RATIO, group_words: int = GROUP_WORDS
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each of the distinct ``words``
    (word, n).

    The form of a word is its near word of largest n, of these the first in
    code point order, if that n is at least ``ratio`` times its own (``ratio``
    above 1); otherwise NULL.  The root is the end of the chain of forms, the
    word itself if it has no form.  No words give no rows.
    """
    words = landed(words.select("word", "n"), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word")))
    near = near_words(words, least_chars, group_words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    chosen: Column = -F.col("best.less") >= ratio * F.col("n")
    known = landed(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(chosen, F.col("best.word")).alias("form"), F.when(chosen, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(known.filter(F.col("form").isNotNull()))
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
