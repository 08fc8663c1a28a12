"""Text helpers: hosts, phonetic codes, identifiers, patterns, comma lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# Fixed values of the Soundex code: one digit per letter A..Z.
SOUNDEX_DIGITS = "01230120022455012623010202"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()


def _code_pattern() -> str:
    """A letter that starts a run of its code: not after the same code.

    A literal digit in the text counts as that code for the letter after it.
    """
    starts = []
    for digit in "123456":
        letters = "".join(c for c, d in zip(_UPPER, SOUNDEX_DIGITS) if d == digit)
        letters += letters.lower()
        starts.append(f"(?<![{letters}{digit}])[{letters}]")
    return "|".join(starts)


# First letter, then up to three letters that start a run.  The lazy gaps stop
# at the third one, so a long text is matched only as far as its code needs.
_SOUNDEX = (
    "(?s)^[^A-Za-z]*(?:([A-Za-z])" + f"(?:.*?({_code_pattern()}))?" * 3 + r".*)?\z"
)


def host_of(url: Column) -> Column:
    """Host part after the last ``://``, without any ``www.``; NULL without a scheme."""
    host = F.regexp_extract(url, ".*://([^/]*)", 1)
    return F.when(url.rlike("://"), F.replace(host, F.lit("www."), F.lit("")))


def soundex_pg(text: Column) -> Column:
    """PostgreSQL flavour of Soundex, for the whole text.

    Leading non-letters are skipped, H and W separate equal codes, a text
    without letters gives an empty string and NULL gives NULL.
    """
    letters = F.regexp_replace(text, _SOUNDEX, "$1$2$3$4")
    first = F.translate(F.substring(letters, 1, 1), _LOWER, _UPPER)
    rest = F.translate(F.substring(letters, 2, 3), _UPPER + _LOWER, SOUNDEX_DIGITS * 2)
    return F.when(letters == "", F.lit("")).otherwise(F.rpad(F.concat(first, rest), 4, "0"))


def first_non_null(*cols: Column) -> Column:
    return F.coalesce(*cols)


def map_labels(label: Column, mapping: Mapping[str, str]) -> Column:
    """Replace the labels listed in ``mapping``; keep every other label."""
    if not mapping:
        return label
    pairs = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, label), label)


def any_of(predicates: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, predicates, F.lit(False))


def any_ilike(label: Column, patterns: Sequence[str]) -> Column:
    return any_of([label.ilike(p) for p in patterns])


def any_like(label: Column, patterns: Sequence[str]) -> Column:
    return any_of([label.like(p) for p in patterns])


def identifier(*cols: Column) -> Column:
    """Lower-case parts joined by ``-``; NULL as soon as one part is NULL."""
    parts: list[Column] = []
    for col in cols:
        parts += [F.lit("-"), col.cast("string")]
    return F.lower(F.concat(*parts[1:]))


def split_list(col: Column, sep: str = ",") -> Column:
    """Comma list to array: an empty string is an empty list, parts are not trimmed."""
    empty = F.array().cast("array<string>")
    return F.when(col == "", empty).otherwise(F.split(col, f"\\Q{sep}\\E", -1))


def histogram(freq: Column, max_freq: Column, width: int = 20, ch: str = "#") -> Column:
    """Bar of ``width * freq / max_freq`` characters, halves rounded up exactly.

    Integer arithmetic, so no binary fraction can tip a half the wrong way.
    """
    doubled = F.lit(2 * width) * freq + max_freq
    # floor(a / b) == (a - a % b) / b on whole numbers
    chars = (doubled - doubled % (F.lit(2) * max_freq)) / (F.lit(2) * max_freq)
    return F.repeat(F.lit(ch), chars.cast("int"))


def ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))
