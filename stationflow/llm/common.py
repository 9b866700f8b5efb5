"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from stationflow.session import prepare, scratch, shared_root

# Bounds of one Arrow batch on its way to a Python worker.  Rows can be long texts, so the bytes
# bound is the one that keeps a worker's memory flat.
BATCH_ROWS = 1024
BATCH_BYTES = 16 << 20
# Estimates from here on stand for an input whose size Spark does not know.
UNKNOWN_BYTES = 1 << 58


def ready(spark: SparkSession) -> SparkSession:
    """Session options of this subpackage: small Arrow batches, shuffle files freed after each query."""
    prepare(spark)
    shared_root(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def table_or_none(spark: SparkSession, sf_dir: str, name: str) -> DataFrame | None:
    """The table, or None where the folder has no such table."""
    try:
        return table(spark, sf_dir, name)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def fresh_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have in any letter case."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def fixed(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def input_bytes(df: DataFrame) -> int:
    """Size of the input as the optimizer knows it (file sizes for a scanned table), 0 if it does not."""
    found = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return 0 if found >= UNKNOWN_BYTES else found
