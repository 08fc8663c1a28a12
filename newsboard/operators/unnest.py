"""Array columns to rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from newsboard.functions.arrays import null_if_empty
from newsboard.functions.json import json_num


def unnest(
    df: DataFrame,
    array: Column,
    fields: Mapping[str, str | tuple[str, str]] | str,
    keep: Sequence[str | Column] = (),
) -> DataFrame:
    """One row per item of ``array``, next to the ``keep`` columns.

    ``fields`` maps an output column to a field of the item, or to a pair of
    field and number type to read it as (see ``json_num``); a plain string names the item
    itself.  All fields come from one ``explode``, so they stay in step.  Rows
    with an empty or missing array give nothing.

    Exploding a plain column would make Spark test its size below the
    projection that computes it, and so parse a JSON array twice; exploding an
    expression keeps the array computed once.
    """
    items = df.select(*keep, F.explode(null_if_empty(array)).alias("_item"))
    item = F.col("_item")
    if isinstance(fields, str):
        out = [item.alias(fields)]
    else:
        out = []
        for name, field in fields.items():
            if isinstance(field, str):
                out.append(item[field].alias(name))
            else:
                out.append(json_num(item[field[0]].cast("string"), field[1]).alias(name))
    return items.select(*[c for c in items.columns if c != "_item"], *out)


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct()
