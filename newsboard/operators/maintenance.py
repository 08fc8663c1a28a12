"""Keyed changes of stored tables, work lists and row documents."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from newsboard.functions.time import moment
from newsboard.operators.articles import entry_details
from newsboard.operators.ranking import dedupe_by_rank, number_rows, top_k
from newsboard.sources.feed import parse_entries


def as_json(*cols: str) -> Column:
    """The columns as one JSON document, NULL fields included."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def latest_by_key(
    incoming: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the newest by ``order``, with the smallest ``keep`` values.

    A rank filter with its group limit: a key that repeats without end sends
    one row per task.  The smallest ``keep`` values come from an aggregate of
    those columns alone.  Rows that tie on ``order`` are settled by their
    remaining columns.
    """
    rest = [c for c in incoming.columns if c not in keys and c not in keep and c not in order]
    newest = dedupe_by_rank(incoming, keys, [F.col(c).desc_nulls_last() for c in [*order, *rest]])
    if not keep:
        return newest
    kept = incoming.groupBy(*keys).agg(*[F.min(c).alias(c) for c in keep])
    return newest.drop(*keep).join(kept, list(keys)).select(*incoming.columns)


def upsert(
    base: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = ("updated_at",),
    keep: Sequence[str] = ("created_at",),
) -> DataFrame:
    """``base`` with the newest incoming row per key put in its place.

    ``keep`` columns stay as they are in ``base``.  Rows of untouched keys pass
    through an anti join; only the key and ``keep`` columns of ``base`` are read
    a second time, so a small batch never shuffles the payloads of the table.
    """
    fresh = latest_by_key(incoming.select(*base.columns), keys, order, keep)
    old = base.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in keep], F.lit(True).alias("_hit"))
    touched = old.join(fresh.select(*keys), list(keys), "left_semi")
    changed = fresh.join(touched, list(keys), "left").select(
        *[
            F.when(F.col("_hit"), F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c)
            if c in keep else F.col(c)
            for c in base.columns
        ]
    )
    untouched = base.join(fresh.select(*keys), list(keys), "left_anti")
    return untouched.select(*base.columns).unionByName(changed)


def digest_uuid(*cols: Column) -> Column:
    """An identifier in the form of a UUID that depends on the values alone, so
    a load that is run again gives a row the identifier it had."""
    parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in cols]
    hexed = F.md5(F.concat_ws("/", *parts))
    return F.concat_ws("-", *[F.substring(hexed, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def with_defaults(
    incoming: DataFrame, stored: DataFrame, key: str, now: datetime, empty: Sequence[str] = ("payload",)
) -> DataFrame:
    """New rows with the defaults of their columns, as they are to be stored.

    A row of a key that is stored keeps its ``id`` and ``created_at``; the
    others get ids that go on after the largest stored one, in the order of the
    keys, and ``now``.  ``updated_at`` is ``now`` where it is missing, and
    missing documents (``empty``) are ``{}``.  ``incoming`` has one row per key;
    rows that are numbered once and loaded again keep their number.  Needs a
    checkpoint directory, as :func:`~newsboard.operators.ranking.number_rows`.
    """
    stamp = moment(now)
    known = stored.select(key, F.col("id").alias("_id"), F.col("created_at").alias("_created"))
    last = stored.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    fresh = number_rows(incoming.select(key).join(stored.select(key), key, "left_anti"), [key], "_nth")
    numbered = incoming.drop("id").join(known, key, "left").join(fresh, key, "left")
    columns = {
        "id": F.coalesce("_id", F.col("_nth") + F.lit(last)),
        "created_at": F.coalesce("_created", "created_at", stamp),
        "updated_at": F.coalesce("updated_at", stamp),
        **{c: F.coalesce(c, F.lit("{}")) for c in empty},
    }
    return numbered.withColumns(columns).select("id", *[c for c in incoming.columns if c != "id"])


def update_existing(
    base: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    order: Sequence[str] = ("updated_at",),
) -> DataFrame:
    """``base`` with ``cols`` taken from the newest incoming row of the same key.

    Incoming keys that ``base`` lacks are ignored.
    """
    picked = list(dict.fromkeys([*keys, *cols, *order]))
    fresh = latest_by_key(incoming.select(*picked), keys, order)
    new = fresh.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in cols], F.lit(True).alias("_hit"))
    return base.join(new, list(keys), "left").select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in cols else F.col(c)
            for c in base.columns
        ]
    )


def merge_analyses(base: DataFrame, results: DataFrame, now: datetime) -> DataFrame:
    """Analysis table after a run.

    ``results`` has feedly_id, payload (NULL for a failure) and, if an id may
    occur more than once, ``seq``.  A success stores its payload with 200.  A
    failure stores 404 without payload for a new id, but 400 with the old
    payload for a known one.
    """
    seq = F.col("seq") if "seq" in results.columns else F.lit(0)
    ok = F.col("payload").isNotNull()
    ranked = results.select("feedly_id", "payload", seq.alias("_seq"), ok.alias("_ok"))
    last = dedupe_by_rank(ranked, ["feedly_id"], [F.desc("_seq"), F.desc("_ok")]).select("feedly_id", "_ok")
    good = dedupe_by_rank(ranked.where("_ok"), ["feedly_id"], [F.desc("_seq"), F.desc("payload")])
    runs = (
        ranked.groupBy("feedly_id")
        .agg(F.count("*").alias("_n"))
        .join(last, "feedly_id")
        .join(good.select("feedly_id", F.col("payload").alias("_payload")), "feedly_id", "left")
    )
    old = base.select(
        "feedly_id", F.col("created_at").alias("_created"), F.col("payload").alias("_old"),
        F.lit(True).alias("_hit"),
    ).join(runs.select("feedly_id"), "feedly_id", "left_semi")
    stamp = moment(now)
    failed = F.when(F.col("_hit") | (F.col("_n") > 1), 400).otherwise(404)
    changed = runs.join(old, "feedly_id", "left").select(
        F.when(F.col("_hit"), F.col("_created")).otherwise(stamp).alias("created_at"),
        stamp.alias("updated_at"),
        "feedly_id",
        F.coalesce("_payload", "_old").alias("payload"),
        F.when(F.col("_ok"), 200).otherwise(failed).cast("int").alias("status_code"),
        stamp.alias("status_at"),
        F.when(F.col("_ok"), stamp).alias("parsed_at"),
    )
    untouched = base.join(runs.select("feedly_id"), "feedly_id", "left_anti")
    return untouched.select(*changed.columns).unionByName(changed)


def analysis_backlog(entries: DataFrame, analyses: DataFrame, limit: int = 300) -> DataFrame:
    """Newest entries that have no analysis yet or one without a status.

    Only ids and creation times are compared; payloads are parsed for the
    ``limit`` entries that remain.
    """
    done = analyses.where(F.col("status_code").isNotNull()).select("feedly_id")
    waiting = entries.join(done, "feedly_id", "left_anti")
    newest = top_k(waiting, [F.col("created_at").desc_nulls_first(), F.col("feedly_id").asc()], limit)
    return entry_details(parse_entries(newest)).select("feedly_id", "url")


def refresh_batches(details: DataFrame, since: datetime, size: int = 250) -> DataFrame:
    """Ids crawled since the start of the day of ``since``, in lists of ``size``."""
    midnight = datetime(since.year, since.month, since.day)
    ids = (
        details.where(F.col("crawled_at") >= moment(midnight))
        .select("created_at", "feedly_id")
        .distinct()
    )
    numbered = number_rows(ids, ["created_at", "feedly_id"])
    in_order = F.array_sort(F.collect_list(F.struct("rn", "feedly_id")))
    return (
        numbered.groupBy(F.floor((F.col("rn") - 1) / size).alias("batch"))
        .agg(in_order.alias("_ids"))
        .select("batch", F.transform("_ids", lambda r: r["feedly_id"]).alias("feedly_ids"))
    )
