"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

import stationflow
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

_own_roots: dict[str, str] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators rely on; cluster sizing is left alone.

    The few functions that run in Python workers travel with the plan, so executors need no copy
    of this package.
    """
    cloudpickle.register_pickle_by_value(stationflow)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def local_session(cpus: int | str = "*", app: str = "stationflow", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    shuffle = cpus if isinstance(cpus, int) else 8
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would lose data with its executor, so the setting is required.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = _own_roots.get(context.applicationId)
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="stationflow-")
        _own_roots[context.applicationId] = root
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared one."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/stationflow/{app}/{label}-{uuid.uuid4().hex[:12]}"


def fixed(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so that later steps see what it is now."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
