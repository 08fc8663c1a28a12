"""Joins of large tables with dimensions whose keys may be hot, rows that meet by a key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F


def spread_join(facts: DataFrame, dimension: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join of facts with a dimension, for keys that may be hot or NULL.

    Nothing is copied ahead: adaptive execution measures the partitions and
    splits those that a hot key has filled, copying only the dimension's rows
    of that partition.  Facts with a NULL key match nothing; they are kept out
    of the shuffle and, for an outer join, added back.  No broadcast hint is
    given: Spark broadcasts the dimension by its own size check.  ``how`` is
    inner, left, left_semi or left_anti.
    """
    if how in ("inner", "left_semi"):
        return facts.join(dimension, list(on), how)
    no_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    found = facts.where(~no_key).join(dimension, list(on), how)
    return found.unionByName(facts.where(no_key), allowMissingColumns=True)


def together(df: DataFrame, key: str) -> DataFrame:
    """All rows, those of a key in one partition: steps by the key, alone or with
    other columns, need no shuffle after it.

    ``repartition`` would deal rows out anew that lie together in another number
    of partitions than a shuffle has, as those of large stored tables do.  A
    window asks only that they lie together: one shuffle, or none.
    """
    place = F.row_number().over(Window.partitionBy(key).orderBy(key))
    return df.withColumn("_place", place).where("_place > 0").drop("_place")
