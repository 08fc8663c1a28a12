"""Stored results that readers can use while a refresh runs.

A table is a folder with numbered version files.  A version file appears whole
or not at all, and a number can be taken only once, so several writers may work
on one table: who comes second takes the next number.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path under the application's part of the shared folder."""
    return f"{_application_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _application_dir(spark: SparkSession) -> str:
    """Below the folder that the cluster names in ``spark.checkpoint.dir`` or,
    where that is unset, below the warehouse, if executors can share it."""
    base = spark.conf.get(_CHECKPOINT_DIR, None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        local_mode = spark.sparkContext.master.split("[")[0] == "local"
        if not local_mode and base.split(":")[0] in ("file", base):
            raise RuntimeError(f"executors do not share {base}: set {_CHECKPOINT_DIR} to a folder that they share")
    return f"{base.rstrip('/')}/newsboard-{spark.sparkContext.applicationId}"


def clear_shared(spark: SparkSession) -> None:
    """Delete what this application has put below the shared folder; tables
    and logs read from there are gone after it."""
    delete(spark, _application_dir(spark))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Have a reliable checkpoint folder; one that is set already stays."""
    if spark.sparkContext.getCheckpointDir() is None:
        base = spark.conf.get(_CHECKPOINT_DIR, None)
        spark.sparkContext.setCheckpointDir(base or f"{_application_dir(spark)}/checkpoints")


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    fs, at = _file_system(spark, path)
    found = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(n for n in found if not n.startswith((".", "_")))


def input_bytes(df: DataFrame) -> int:
    """Size of the files that ``df`` is read from."""
    sizes = [fs.getFileStatus(at).getLen() for fs, at in (_file_system(df.sparkSession, p) for p in df.inputFiles())]
    return sum(sizes)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or of all files in a folder; 0 if there is none."""
    fs, at = _file_system(spark, path)
    return fs.getContentSummary(at).getLength() if fs.exists(at) else 0


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = _file_system(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file that must not exist yet; False if it does.

    The file gets its name when it is complete.  Renaming onto a file that
    exists fails on a cluster's file system; a local one would replace it, and
    there a hard link is made instead.
    """
    fs, at = _file_system(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f"_draft-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(text.encode())
    out.close()
    try:
        if fs.getScheme() != "file":
            return not fs.exists(at) and fs.rename(draft, at)
        os.link(draft.toUri().getPath(), at.toUri().getPath())
        return True
    except FileExistsError:
        return False
    finally:
        fs.delete(draft, False)


def latest_version(spark: SparkSession, path: str) -> int | None:
    numbers = list_names(spark, f"{path}/versions")
    return int(numbers[-1]) if numbers else None


def version_file(path: str, number: int) -> str:
    return f"{path}/versions/{number:020d}"


def materialize(df: DataFrame, path: str, keep: int = 2) -> DataFrame:
    """Write ``df`` as the new version of the table at ``path`` and read it back.

    Data goes to a folder of its own; the next version file names it once the
    write is complete.  Readers of the old version are not disturbed, and a
    failed write is never seen.  Writers that finish together get different
    numbers, in the order in which they finish.  The newest ``keep`` versions
    stay on disk.
    """
    spark = df.sparkSession
    data = f"{path}/data-{uuid.uuid4().hex}"
    df.write.parquet(data)
    while True:
        last = latest_version(spark, path)
        number = 0 if last is None else last + 1
        if publish(spark, version_file(path, number), data):
            break
    for name in list_names(spark, f"{path}/versions"):
        if int(name) <= number - keep:
            delete(spark, read_text(spark, f"{path}/versions/{name}"))
            delete(spark, f"{path}/versions/{name}")
    return spark.read.parquet(data)


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The current version of the table at ``path``, None before the first."""
    last = latest_version(spark, path)
    return None if last is None else spark.read.parquet(read_text(spark, version_file(path, last)))
