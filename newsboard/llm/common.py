"""Helpers that the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsboard.plans.storage import shared_dir

#: The white space of the corpus contracts: space and \t \n \v \f \r.
SPACES = " \t\n\x0b\f\r"
#: The same as a class of Java's regular expressions.
SPACE_CLASS = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def landed(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written once in the shared folder.

    Whatever reads the result reads files that outlive any executor, and the
    work above it runs a single time.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and all other characters as they are."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def uniform(*cols: Column) -> Column:
    """A number in [0, 1) that depends on the values of ``cols`` alone."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) * F.lit(2.0**-53)


def row_key(*cols: Column) -> Column:
    """128-bit digest of the values; NULL differs from every value."""
    parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in cols]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts)))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that clash with no column of ``df``, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


#: A key with more than this share of all rows is hot.
HOT_SHARE = 1e-3
#: Bytes of hot rows, as JSON, up to which rows of no bounded width are broadcast.
HOT_BYTES = 1 << 26


def hot_join(facts: DataFrame, dim: DataFrame, key: str, rows: str, how: str = "inner", wide: bool = False) -> DataFrame:
    """Join ``facts`` with ``dim`` on ``key`` where keys may be hot.

    ``dim`` has one row per key and, in ``rows``, how many rows of ``facts``
    have it.  Keys with more than ``HOT_SHARE`` of that total are at most
    ``1 / HOT_SHARE`` by arithmetic, so they are broadcast; all other keys are
    shuffled.  NULL keys match nothing and are not moved.  ``how`` is inner or
    left.  Both frames are read more than once and should be stored tables.
    Rows of ``dim`` that have no bounded width are ``wide``: their hot ones are
    measured, and beyond ``HOT_BYTES`` all keys are shuffled and adaptive
    execution splits the hot ones.
    """
    total = dim.agg(F.sum(rows)).first()[0] or 0
    limit = max(1.0, total * HOT_SHARE)
    heavy = dim.filter(F.col(rows) > limit)
    if wide and (heavy.agg(F.sum(F.length(F.to_json(F.struct(*dim.columns))))).first()[0] or 0) > HOT_BYTES:
        heavy = heavy.limit(0)
        limit = float("inf")
    hot = F.broadcast(heavy)
    cold = dim.filter(F.col(rows) <= limit)
    others = facts.filter(F.col(key).isNotNull()).join(hot.select(key), key, "left_anti")
    out = facts.join(hot, key, "inner").unionByName(others.join(cold, key, how))
    if how == "left":
        out = out.unionByName(facts.filter(F.col(key).isNull()), allowMissingColumns=True)
    return out


def open_for_write(uri: str):
    """A binary stream to a new file of the shared folder, from any task."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None, buffer_size=1 << 20)


def open_for_read(uri: str):
    """A binary file of the shared folder with random access, from any task."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)
