"""Company register files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsboard.sources.schemas import REGISTER


def read_register(spark: SparkSession, path: str, table: str) -> DataFrame:
    """CSV with header into the typed register table ``table``.

    The schema is explicit, so no pass over the data infers it; the header must
    name its columns in order, and a row that does not fit ends the load.
    Quoted fields may hold line breaks and doubled quotes, as the bulk exports
    do, so a file is one task: exports come as files of moderate size.
    """
    return (
        spark.read.schema(REGISTER[table])
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
