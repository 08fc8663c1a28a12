"""Sharding by proportional stratified interleaving.

The rows of each source are put into a seeded order and get the fractions
(rank + phase) / rows of the source, so that any range of fractions holds every
source in proportion.  Sorted by fraction, the rows of all sources interleave,
and cuts at equal counts give shards that match the mixture.

Neither sort passes through one task: ranks are numbered inside of buckets of
the order and shifted by the counts of the buckets before, so a source with
most of the rows is as many groups as there are buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsboard.llm.common import fresh, landed

SHARDS, SEED = 16, 12
#: Buckets of the order within a source and of the order by fraction.
BUCKET_BITS = 12


def _draw(seed: int, *cols: Column) -> Column:
    """128 bits, as hex digits, that depend on the seed and the values alone."""
    parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in cols]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def _leading(draw: Column, digits: int) -> Column:
    return F.conv(F.substring(draw, 1, digits), 16, 10).cast("bigint")


def fractions(docs: DataFrame, source: str, keys: list[str], seed: int, names: list[str]) -> DataFrame:
    """``docs`` with a fraction in [0, 1) and the seeded draw of each row, in
    columns called ``names``.  Equal fractions of one source do not occur."""
    fraction, draw, group, bucket, before, rows, rank = fresh(
        docs, *names, "_source", "_bucket", "_before", "_rows", "_rank"
    )
    digests = [F.md5(F.col(k).cast("binary")) if docs.schema[k].dataType.simpleString() == "string" else F.col(k) for k in keys]
    drawn = docs.withColumn(draw, _draw(seed, *digests))
    # NULL is a source like any other; one name for it lets window and join share a shuffle
    drawn = drawn.withColumn(group, F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("-")))
    drawn = drawn.withColumn(bucket, F.shiftright(_leading(F.col(draw), 4), 16 - BUCKET_BITS).cast("int"))
    sizes = landed(drawn.groupBy(group, bucket).agg(F.count("*").alias(rows)), "source-buckets")
    whole = Window.partitionBy(group)
    sofar = whole.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        group, bucket, F.coalesce(F.sum(rows).over(sofar), F.lit(0)).alias(before), F.sum(rows).over(whole).alias(rows)
    )
    order = Window.partitionBy(group, bucket).orderBy(draw)
    numbered = drawn.withColumn(rank, F.row_number().over(order) - 1).join(offsets, [group, bucket])
    phase = _leading(_draw(seed, F.col(source)), 8) / F.lit(float(1 << 32))
    return numbered.withColumn(fraction, (F.col(before) + F.col(rank) + phase) / F.col(rows)).select(
        *docs.columns, fraction, draw
    )


def interleave(
    docs: DataFrame, source: str = "source", keys: tuple[str, ...] = ("doc_id", "text"), n_shards: int = SHARDS,
    seed: int = SEED, shard: str = "shard", slot: str = "slot",
) -> DataFrame:
    """``docs`` with the shard of each row and its place in the shard.

    Shards are numbered from 0, slots are gapless from 0, and the counts of
    shards differ by one at most.  Of each source a shard holds its share, one
    row more or less.  ``keys`` decide the order within a source: the same rows
    and seed give the same shards, in whatever order they come; rows that agree
    in all of them are interchangeable and rank in any order, in one task.

    NULL is a source of its own; NULL and empty texts are rows like others.
    Sources with fewer rows than shards are spread by a phase that depends on
    the source.  No rows give no rows.  A column of ``docs`` that is called
    like a new one (in any case) is replaced.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in (shard.lower(), slot.lower())])
    fraction, draw, part, before, n, at = fresh(docs, "_fraction", "_draw", "_part", "_start", "_n", "_at")
    ranked = fractions(docs, source, list(keys), seed, [fraction, draw])
    spot = F.least(F.floor(F.col(fraction) * (1 << BUCKET_BITS)), F.lit((1 << BUCKET_BITS) - 1)).cast("int")
    ranked = ranked.withColumn(part, spot)
    # 2 ** BUCKET_BITS rows at most: one task adds them up, and all tasks may hold them
    counts = landed(ranked.groupBy(part).agg(F.count("*").alias(n)), "fraction-buckets")
    sofar = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(part, F.coalesce(F.sum(n).over(sofar), F.lit(0)).alias(before))
    total = counts.agg(F.sum(n)).first()[0] or 0
    order = Window.partitionBy(part).orderBy(fraction, F.col(source).asc_nulls_last(), draw)
    placed = ranked.withColumn(at, F.row_number().over(order) - 1).join(F.broadcast(starts), part)
    placed = placed.withColumn(at, F.col(at) + F.col(before))
    # shard k begins at row floor(k * total / n_shards)
    number = F.expr(f"((`{at}` + 1) * {n_shards} - 1) div {max(1, total)}").cast("int")
    begin = F.expr(f"(`{shard}` * {total}L) div {n_shards}")
    return placed.withColumn(shard, number).withColumn(slot, F.col(at) - begin).select(*docs.columns, shard, slot)


def write_shards(docs: DataFrame, path: str, shard: str = "shard", slot: str = "slot") -> None:
    """Write the rows of ``interleave`` as Parquet, a folder per shard whose
    files, in the order of their names, hold the rows in the order of slots.
    A shard is split by slot where it is large."""
    # Sampled ranges, so tasks get equal shares of rows; folders are made by the writer.
    dealt = docs.repartitionByRange(F.col(shard), F.col(slot)).sortWithinPartitions(shard, slot)
    dealt.write.partitionBy(shard).parquet(path)
