"""Array aggregates with the NULL rules of SQL ``array_agg``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def null_if_empty(array: Column) -> Column:
    return F.when(F.size(array) > 0, array)


def set_of(col: Column) -> Column:
    """Distinct non-NULL values, sorted; NULL when there are none."""
    return null_if_empty(F.array_sort(F.collect_set(col)))


def union_of(array: Column) -> Column:
    """Distinct non-NULL items of an array column over a group, sorted; NULL when none."""
    items = F.array_compact(F.array_distinct(F.flatten(F.collect_set(array))))
    return null_if_empty(F.array_sort(items))


def set_keep_nulls(col: Column) -> Column:
    """Distinct values, sorted, with one NULL last if any value was NULL."""
    items = F.array_sort(F.collect_set(col))
    null = F.array(F.lit(None).cast("string"))
    has_null = F.bool_or(col.isNull())
    return F.when(has_null, F.concat(items, null.cast("array<string>"))).otherwise(items)


def list_keep_nulls(col: Column, order: Column) -> Column:
    """All values of a group by ascending ``order``, NULLs included."""
    pairs = F.array_sort(F.collect_list(F.struct(order.alias("o"), col.alias("x"))))
    return F.transform(pairs, lambda p: p["x"])
