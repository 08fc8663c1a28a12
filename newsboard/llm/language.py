"""Language identification by error-correcting output codes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from newsboard.llm.common import fresh, landed

UNDETERMINED = "und"
BUCKETS = 1 << 14
#: Buckets of a language's sums that one row carries.
_SLICE = 1 << 10
#: Languages whose sums a task holds before it gives them on.
_HELD_LANGUAGES = 128
#: Lead of the best codeword over the next below which a text is ambiguous.
LEAD = 0.1
_GAIN, _SMOOTHING = 4.0, 0.5
_COMPARED = 50 * 1000**2
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
_ASCII_LETTER = re.compile("[A-Za-z]")
_BYTES_AT_ONCE = 1 << 20


def has_letter(text: str | None) -> bool:
    return bool(text) and bool(_ASCII_LETTER.search(text) or any(map(str.isalpha, text)))


def profile(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Share of every hashed n-gram (two and three bytes of the lower-cased
    letters, other characters as word ends) among all of a text."""
    total = np.zeros(buckets, np.int64)
    data = b" " + b" ".join(text.lower().encode().translate(_LETTERS).split()) + b" "
    for at in range(0, len(data), _BYTES_AT_ONCE):
        b = np.frombuffer(data[at : at + _BYTES_AT_ONCE + 2], np.uint8).astype(np.uint32)
        for gram in (b[:-1] << 8 | b[1:], (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) + np.uint32(1 << 24)):
            total += np.bincount((gram * np.uint32(2654435761)) >> np.uint32(32 - buckets.bit_length() + 1), minlength=buckets)
    return total / max(1, total.sum())


def codewords(n: int, seed: int = 1) -> np.ndarray:
    """n codewords of +1 and -1, all columns different and none constant.

    Up to seven languages use every split in two, so codewords differ in half
    of the bits or more.  More languages use the best of some random codes: the
    one whose closest codewords are farthest apart, 50 of them or as many as
    ``_COMPARED`` pairs of codewords allow.  A code whose closest codewords
    differ in less than a sixth of the bits is never taken.
    """
    if n < 2:
        return np.ones((n, 1))
    if n <= 7:
        splits = np.arange(1, 2 ** (n - 1))
        return np.where(splits[None, :] >> np.arange(n)[:, None] & 1, 1.0, -1.0)
    rng, best, most = np.random.default_rng(seed), None, -1
    tries = min(50, -(-_COMPARED // n**2))
    while tries > 0 or most < best.shape[1] / 6:
        tries -= 1
        code = rng.choice([-1.0, 1.0], (n, 15 * int(np.ceil(np.log2(n)))))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        alike = -np.inf
        for a in range(0, n, 1000):
            agree = code[a : a + 1000] @ code.T
            agree[np.arange(len(agree)), np.arange(a, a + len(agree))] = -np.inf
            alike = max(alike, agree.max())
        apart = (code.shape[1] - alike) / 2
        if apart > most:
            best, most = code, apart
    return best


@dataclass
class Model:
    """One linear n-gram classifier per bit of the codewords."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, languages: list[str], code: np.ndarray, odds: np.ndarray, scores: np.ndarray) -> Model:
        """From the odds (buckets x bits) and every language's mean profile
        times them (languages x bits)."""
        if not languages:
            return cls([], np.empty((0, 0)), np.empty((BUCKETS, 0), np.float32))
        on, both = code > 0, np.abs(code.sum(axis=0)) < len(code)
        # the middle between both sides' nearest languages is the border
        border = (np.where(on, scores, np.inf).min(axis=0) + np.where(on, -np.inf, scores).max(axis=0)) / 2
        border = np.where(both, border, 0.0)
        spread = np.where(both, np.abs(scores - border).mean(axis=0), 1.0)
        weights = np.where(both, odds - border, 0.0) / np.where(spread > 0, spread, 1)
        return cls(languages, code, weights.astype(np.float32))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, ambiguous) of a whole text."""
        if not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0, True
        margins = profile(text) @ self.weights
        # weighted by the bits' margins: a sure wrong bit costs much, an open one little
        # (the mean of log(1 + exp(-gain * bit * margin)), but for what all languages share)
        loss = -_GAIN / 2 * (self.code @ margins) / self.code.shape[1]
        shares = np.exp(-_GAIN * (loss - loss.min()))
        shares /= shares.sum()
        order = np.argsort(-shares, kind="stable")
        lead = shares[order[0]] - (shares[order[1]] if len(order) > 1 else 0.0)
        return self.languages[order[0]], float(shares[order[0]]), bool(lead < LEAD)


def learn(docs: DataFrame, text: str, lang: str) -> Model:
    """Fit a model on all rows of ``docs`` that have a text and a language.

    Every document adds its profile to its language's mean; sums are made in
    the tasks and added up per language, as rows.  A bit's classifier weighs
    each n-gram by the logarithm of its odds between the languages whose
    codewords have the bit and the others: the rows are reduced to sums per
    bit, whose number grows with the logarithm of the number of languages, and
    only these, the names and a score per language and bit come to the driver.
    """
    labelled = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    )

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        n: dict[str, int] = {}

        def given() -> pa.RecordBatch:
            rows = [(name, k, n[name], x[k : k + _SLICE].tobytes()) for name, x in sums.items() for k in range(0, BUCKETS, _SLICE)]
            cells = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate((pa.string(), pa.int32(), pa.int64(), pa.binary()))]
            return pa.RecordBatch.from_arrays(cells, ["lang", "slice", "n", "sums"])

        for batch in batches:
            for name, cell in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not has_letter(body := cell.as_py()):
                    continue
                if name not in sums and len(sums) == _HELD_LANGUAGES:
                    yield given()
                    sums.clear()
                    n.clear()
                sums[name] = sums[name] + profile(body) if name in sums else profile(body)
                n[name] = n.get(name, 0) + 1
        yield given()

    def merge(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n, rows = np.zeros(_SLICE), 0, None
        for rows in parts:
            for x in rows["sums"]:
                total += np.frombuffer(x)
            n += rows["n"].sum()
        yield rows[:1].assign(n=n, sums=[total.tobytes()])[["lang", "slice", "n", "sums"]]

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        slices = pdf.sort_values("slice")
        return pd.DataFrame({"lang": slices["lang"][:1], "n": slices["n"][:1], "sums": [b"".join(slices["sums"])]})

    # a group of any number of tasks passes through in batches; the groups of a
    # language grow with its slices and parts, not what one of them holds
    shape = "lang string, slice int, n long, sums binary"
    partial = labelled.mapInArrow(add_up, shape).withColumn("part", F.spark_partition_id() % 32)
    merged = partial.groupBy("lang", "slice", "part").applyInPandas(merge, shape)
    merged = merged.groupBy("lang", "slice").applyInPandas(merge, shape)
    means = landed(merged.groupBy("lang").applyInPandas(whole, "lang string, n long, sums binary"), "languages")
    languages = sorted(r["lang"] for r in means.select("lang").collect())
    if not languages:
        return Model.fit([], *[np.empty((0, 0))] * 3)
    number, code = {x: k for k, x in enumerate(languages)}, codewords(len(languages))
    bits = code.shape[1]
    sent = docs.sparkSession.sparkContext.broadcast((number, code))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        for batch in batches:
            for name, n, sums in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield sent.value[0][name], np.frombuffer(sums) / n

    def by_bit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on, every = np.zeros((bits, BUCKETS)), np.zeros(BUCKETS)
        for k, share in rows(batches):
            on[sent.value[1][k] > 0] += share
            every += share
        cells = [pa.array(range(-1, bits), pa.int32()), pa.array([x.tobytes() for x in (every, *on)], pa.binary())]
        yield pa.RecordBatch.from_arrays(cells, ["bit", "sums"])

    def merge_bit(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x) for x in pdf["sums"]], axis=0)
        return pd.DataFrame({"bit": [pdf["bit"].iloc[0]], "sums": [total.tobytes()]})

    summed = means.mapInArrow(by_bit, "bit int, sums binary").groupBy("bit").applyInPandas(merge_bit, "bit int, sums binary")
    sums = {r["bit"]: np.frombuffer(r["sums"]) for r in summed.collect()}
    n_on = (code > 0).sum(axis=0)
    odds = np.zeros((BUCKETS, bits))
    for bit in np.flatnonzero((n_on > 0) & (n_on < len(code))):
        on, off = sums[bit] / n_on[bit], (sums[-1] - sums[bit]).clip(0) / (len(code) - n_on[bit])
        odds[:, bit] = np.log(on + _SMOOTHING / BUCKETS) - np.log(off + _SMOOTHING / BUCKETS)
    sent_odds = docs.sparkSession.sparkContext.broadcast(odds)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, share in rows(batches):
            cells = [pa.array([k], pa.int32()), pa.array([(share @ sent_odds.value).tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(cells, ["k", "scores"])

    scores = np.zeros(code.shape)
    for r in means.mapInArrow(score, "k int, scores binary").collect():
        scores[r["k"]] = np.frombuffer(r["scores"])
    return Model.fit(languages, code, odds, scores)


def held_out(id_col: Column) -> Column:
    """Whether the document is kept from learning; a NULL id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, model: Model, text: str = "text", out: str = "lang_id") -> DataFrame:
    """``docs`` with a struct ``out`` of lang (``und`` for a text that is NULL
    or has no letter, or if no language was learned), score (0 to 1) and
    ambiguous.  Only the text is read; whole texts, of any length.  A column of
    ``docs`` that is called like ``out`` (in any case) is replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, ambiguous boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([sent.value.predict(x) for x in texts], columns=["lang", "score", "ambiguous"])

    others = [docs[c] for c in docs.columns if c.lower() != out.lower()]
    return docs.select(*others, predict(F.col(text)).alias(out))


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", out: str = "lang_id") -> DataFrame:
    """``docs`` with ``out`` as of ``identify``, by a model learned from the
    text and language of the documents that are not held out."""
    model = learn(docs.filter(~held_out(F.col(id_col)) & F.col(id_col).isNotNull()), text, lang)
    return identify(docs, model, text, out)


def _have_letters(texts: pd.Series) -> pd.Series:
    return pd.Series([has_letter(x) for x in texts], dtype=bool)


def drop_undetermined(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose text has a language; ambiguous ones stay, and
    all that have a letter if no language could be learned."""
    (out,) = fresh(docs, "lang_id")
    model = learn(docs.filter(~held_out(F.col(id_col)) & F.col(id_col).isNotNull()), text, lang)
    if not model.languages:
        letters = F.pandas_udf(_have_letters, "boolean")
        return docs.filter(letters(F.col(text)))
    return identify(docs, model, text, out).filter(F.col(f"{out}.lang") != UNDETERMINED).select(*docs.columns)
