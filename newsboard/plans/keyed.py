"""Stored tables in hash buckets of their key.

A version is a list of one folder per bucket.  A change reads and writes the
buckets that its keys fall into; all others keep their folders, names included.
A lookup reads the buckets of the ids that it is given.  Several writers may
change one table: a version number can be taken once, and who comes second
works on what the first has left.

A table of which no key has many rows may be ``dealt``: its folders are buckets
of Spark's own, and what joins or groups its rows by the key shuffles nothing.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from newsboard.operators.maintenance import latest_by_key
from newsboard.plans.storage import delete, latest_version, list_names, publish, read_text, version_file

BUCKETS = 64
_BUCKET = "bucket_no"

Folders = dict[int, str]


class KeyedTable:
    """A table at ``path`` whose rows are found by ``keys``.

    A key may have many rows.  The number of buckets is that of the first
    version: choose it so that a bucket is what one task writes.

    In a ``dealt`` table a key has few rows, since one task reads and writes a
    bucket.  Rows that are dealt by the key into as many partitions are written
    where they lie.  Its versions are named in the session's catalog, which
    tells Spark how their files are dealt.

    With ``keep`` a change deletes the versions before the newest ``keep``; a
    frame of one of these cannot be read any more, and a second writer may fail.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], schema: StructType | str, buckets: int = BUCKETS,
        dealt: bool = False, keep: int | None = None,
    ):
        self.spark, self.path, self.keys, self.keep = spark, path, list(keys), keep
        self.schema = spark.createDataFrame([], schema).schema
        first = self._version(0)
        self.buckets = first["buckets"] if first else buckets
        self.dealt = first.get("dealt", False) if first else dealt
        self._named: set[str] = set()

    def _version(self, number: int | None = None) -> dict | None:
        number = latest_version(self.spark, self.path) if number is None else number
        names = list_names(self.spark, f"{self.path}/versions")
        if number is None or not names:
            return None
        name = version_file(self.path, max(number, int(names[0])))
        return json.loads(read_text(self.spark, name)) | {"number": int(name.rpartition("/")[2])}

    def _bucket_of(self) -> Column:
        # The first hash is the one by which Spark deals rows out.
        of_key = F.hash(*self.keys) if self.dealt else F.xxhash64(*self.keys)
        return F.pmod(of_key, F.lit(self.buckets)).cast("int")

    def deal(self, rows: DataFrame) -> DataFrame:
        """Rows in one partition per bucket; those that lie so already stay."""
        return rows.repartition(self.buckets, *self.keys)

    def folders(self) -> Folders:
        """The folder of each bucket that has rows."""
        version = self._version()
        return {int(b): f for b, f in version["folders"].items()} if version else {}

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The current rows, of all buckets or of some."""
        return self._read(self.folders(), buckets)

    def _read(self, folders: Folders, buckets: Sequence[int] | None = None) -> DataFrame:
        paths = [f for b, f in folders.items() if buckets is None or b in set(buckets)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        if self.dealt:
            rows = self.spark.table(self._catalog_name(folders))
            return (rows if len(paths) == len(folders) else rows.where(F.col(_BUCKET).isin(*buckets))).select(*self.schema.names)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{p}" for p in paths])

    def _name_of(self, folders: Folders) -> str:
        return f"keyed_{hashlib.md5(json.dumps([self.path, sorted(folders.items())]).encode()).hexdigest()}"

    def _catalog_name(self, folders: Folders) -> str:
        """A table of the catalog, of these folders; its name depends on them alone."""
        name = self._name_of(folders)
        if name not in self._named:
            at = lambda folder: "'" + f"{self.path}/{folder}".replace("\\", "\\\\").replace("'", "\\'") + "'"
            columns = self.spark.createDataFrame([], self.schema)._jdf.schema().toDDL()
            keys = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {_BUCKET} INT) USING parquet PARTITIONED BY ({_BUCKET}) "
                f"CLUSTERED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION {at('data')}"
            )
            parts = " ".join(f"PARTITION ({_BUCKET} = {b}) LOCATION {at(f)}" for b, f in folders.items())
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
            self._named.add(name)
        return name

    def _write(self, parts: Sequence[DataFrame], data: str) -> None:
        """Write rows to a folder of data, with one folder per bucket below it."""
        name = f"written_{data.rpartition('/')[2]}"
        for rows in parts:
            rows = rows.select(*self.schema.names).withColumn(_BUCKET, self._bucket_of())
            if not self.dealt:
                # A key with most rows fills its bucket: adaptive execution splits what is large.
                rows.hint("rebalance", _BUCKET).write.mode("append").partitionBy(_BUCKET).parquet(f"{self.path}/{data}")
                continue
            writer = self.deal(rows).write.mode("append").format("parquet").option("compression", "zstd")
            writer = writer.partitionBy(_BUCKET).bucketBy(self.buckets, *self.keys)
            writer.option("path", f"{self.path}/{data}").saveAsTable(name)
        if self.dealt:  # its name goes from the catalog, its files are the version's
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of the keys of ``rows``: at most as many as there are."""
        return self._touched(rows)[0]

    def _touched(self, rows: DataFrame) -> tuple[list[int], bool]:
        """The buckets of the keys of ``rows``, and whether a key has a NULL."""
        null = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in self.keys])
        found = rows.select(self._bucket_of().alias("_b"), null.alias("_null")).distinct().collect()
        return sorted({r[0] for r in found}), any(r[1] for r in found)

    def matching(self, ids: DataFrame) -> DataFrame:
        """The current rows with a key that ``ids`` has."""
        ids = ids.select(*self.keys)
        buckets, null = self._touched(ids)
        rows = self.read(buckets)
        ids = self.deal(ids) if self.dealt else ids  # else the rows would be dealt out like many ids
        if not null:  # rows are then found by the key itself, and stay dealt by it
            return rows.join(ids, self.keys, "left_semi").select(*self.schema.names)
        ids = ids.distinct()
        return rows.join(ids, self._same(rows, ids), "left_semi").select(*self.schema.names)

    def _same(self, a: DataFrame, b: DataFrame) -> Column:
        """Equal keys; NULL equals NULL."""
        return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in self.keys])

    def done(self, series: str) -> int:
        """The number of the last change of a series that was stored, or -1."""
        version = self._version()
        return version["series"].get(series, -1) if version else -1

    def change(
        self, touched: Sequence[int], combine: Callable[[DataFrame], DataFrame | Sequence[DataFrame]],
        step: tuple[str, int] | None = None,
    ) -> None:
        """Put ``combine(rows of the touched buckets)`` in their place.

        ``combine`` must return rows of these buckets only, in one frame or in
        several that are written one after the other; it is called again
        if another writer has changed one of them in the meantime.  ``step``
        names a series of changes and the number of this one: it is stored with
        the rows, and a change whose number was stored before does nothing.
        """
        touched, held, written = sorted(touched), None, {}
        while touched:
            version = self._version()
            folders = {int(b): f for b, f in version["folders"].items()} if version else {}
            series = version["series"] if version else {}
            if step and series.get(step[0], -1) >= step[1]:
                return
            mine = {b: folders.get(b) for b in touched}
            if mine != held:
                data, held = f"data/{uuid.uuid4().hex}", mine
                parts = combine(self._read(folders, touched))
                self._write([parts] if isinstance(parts, DataFrame) else parts, data)
                names = list_names(self.spark, f"{self.path}/{data}")
                written = {int(n.partition("=")[2]): f"{data}/{n}" for n in names if n.startswith(f"{_BUCKET}=")}
            kept = {b: f for b, f in folders.items() if b not in held}
            text = json.dumps({"buckets": self.buckets, "keys": self.keys, "folders": kept | written,
                               "dealt": self.dealt, "series": series | dict([step] if step else [])})
            if publish(self.spark, version_file(self.path, version["number"] + 1 if version else 0), text):
                if self.keep:
                    self.vacuum(self.keep)
                return

    def upsert(self, incoming: DataFrame, order: Sequence[str] = ("updated_at",), keep: Sequence[str] = ()) -> None:
        """Store the newest row per key of what is stored and what comes in.

        The result does not depend on how rows are cut into batches or on which
        come first, and a batch that is repeated changes nothing.  Rows with a
        NULL in their key name nothing and are left out.
        """
        named = incoming.select(*self.schema.names).dropna(subset=self.keys)
        if self.dealt:
            self.change(self.touched(named), lambda old: self._newest(old, named, order, keep))
            return
        new = latest_by_key(named, self.keys, order, keep).persist()
        try:
            self.change(self.touched(new), lambda old: latest_by_key(old.unionByName(new), self.keys, order, keep))
        finally:
            new.unpersist()

    def _newest(
        self, old: DataFrame, named: DataFrame, order: Sequence[str], keep: Sequence[str]
    ) -> list[DataFrame]:
        """What :func:`latest_by_key` leaves of both, in two frames whose rows stay
        where their keys lie: neither is shuffled, nor held while it is written."""
        new = latest_by_key(self.deal(named), self.keys, order, keep)
        old = latest_by_key(old, self.keys, order, keep)
        own = [c for c in self.schema.names if c not in self.keys]
        rest = [*order, *[c for c in own if c not in keep and c not in order]]
        before = old.select(*self.keys, F.struct(*rest).alias("_old"), *[F.col(c).alias(f"_{c}") for c in keep])
        newest = F.greatest(F.struct(*rest), "_old")  # in the order of latest_by_key: a NULL is least
        picked = new.join(before, self.keys, "left").withColumn("_new", newest)
        rows = picked.select(
            *[
                F.col(c) if c in self.keys else F.least(c, f"_{c}").alias(c) if c in keep else F.col("_new")[c].alias(c)
                for c in self.schema.names
            ]
        )
        return [rows, old.join(self.deal(named.select(*self.keys)), self.keys, "left_anti").select(*self.schema.names)]

    def replace(self, keys: DataFrame, rows: DataFrame) -> None:
        """Drop what is stored under ``keys`` and store ``rows``, whose keys are
        among them, instead."""
        keys, rows = keys.select(*self.keys), rows.select(*self.schema.names)
        touched, null = self._touched(keys)

        def stay(old: DataFrame) -> DataFrame:
            if not null:
                return old.join(keys, self.keys, "left_anti").select(*self.schema.names)
            gone = keys.distinct()
            return old.join(gone, self._same(old, gone), "left_anti")

        self.change(touched, lambda old: [stay(old), rows] if self.dealt else stay(old).unionByName(rows))

    def vacuum(self, keep: int = 2) -> None:
        """Delete the versions before the newest ``keep`` and the folders that
        only they name; what a writer has under way is in no version yet."""
        names = list_names(self.spark, f"{self.path}/versions")
        of = lambda n: set(json.loads(read_text(self.spark, f"{self.path}/versions/{n}"))["folders"].values())
        used = set().union(*map(of, names[-keep:]))
        for name in names[:-keep]:
            self._forget(name)
            for folder in of(name) - used:
                delete(self.spark, f"{self.path}/{folder}")
            delete(self.spark, f"{self.path}/versions/{name}")

    def _forget(self, version: str) -> None:
        """Take a version's name from the catalog."""
        if self.dealt:
            folders = json.loads(read_text(self.spark, f"{self.path}/versions/{version}"))["folders"]
            name = self._name_of({int(b): f for b, f in folders.items()})
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self._named.discard(name)

    def drop(self) -> None:
        """Delete the table with all its versions."""
        for name in list_names(self.spark, f"{self.path}/versions"):
            self._forget(name)
        delete(self.spark, self.path)
