"""Small lookup tables made from settings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from stationflow.config import MODEL_LABELS, STATION_NAMES
from stationflow.schemas import MODEL_DIM, STATION_DIM

# Settings-made lookup tables above this many rows are not marked for broadcast.
BROADCAST_ROWS = 10_000


def literal_dim(spark: SparkSession, rows: Sequence[tuple], schema: StructType) -> DataFrame:
    """A DataFrame of driver-side settings, marked for broadcast only if it is known to be small.

    Lookup *tables* need no such mark: Catalyst and AQE broadcast them by measured size.
    """
    dim = spark.createDataFrame(list(rows), schema)
    return F.broadcast(dim) if len(rows) <= BROADCAST_ROWS else dim


def station_dim(spark: SparkSession, names: dict[str, str] = STATION_NAMES) -> DataFrame:
    return literal_dim(spark, sorted(names.items()), STATION_DIM)


def model_dim(spark: SparkSession, long_labels: bool = True) -> DataFrame:
    """Model labels; the forecast dashboard uses the short ones, the monitor the long ones."""
    rows = [(key, long if long_labels else short, strategy) for key, short, long, strategy in MODEL_LABELS]
    return literal_dim(spark, rows, MODEL_DIM)
