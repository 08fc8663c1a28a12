"""JSON helpers that read both nested documents and string-encoded ones.

``from_json`` with a *string* field returns the raw text of a nested object
and the content of a JSON string alike, so decoding in two steps reads either
encoding.  Numbers are read as text and cast with ``try_cast``: one malformed
number in a feed gives one NULL, never a failed job and never a NaN.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def json_text(doc: Column, *path: str) -> Column:
    """Field of a JSON document as text; every step may be string-encoded."""
    for name in path:
        doc = F.get_json_object(doc, f"$.{name}")
    return doc


def json_unwrap(doc: Column, schema: str) -> Column:
    """Parse a JSON text column to the given DDL type."""
    return F.from_json(doc, schema)


def json_at(doc: Column, index: int, *path: str) -> Column:
    """Field of the ``index``-th array item, NULL when the array is short."""
    return json_text(F.get_json_object(doc, f"$[{index}]"), *path)


def json_num(text: Column, kind: str = "double") -> Column:
    """A number, NULL if the text is none, out of range, NaN or infinite."""
    value = text.try_cast(kind)
    # NaN compares as larger than every number.
    return F.when(F.abs(value) < float("inf"), value) if kind == "double" else value
