"""All models of all stations as one versioned table: inputs, trees, settings and score, a row a model."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationflow.models.forest import INPUT_FIELDS, NODE_FIELDS, packed, unpacked
from stationflow.sources.snapshots import Change, Layout, SnapshotTable

# A model takes some 200 KB, so a bucket of 10,000 models' table is some 30 MB.
BUCKETS = 64
LOG = ("run_ts", "station_id", "strategy", "params", "mae")


class ModelTables:
    """A fit of any number of models is one commit; readers see the newest version of each model.

    The version of a model is that of the table's commit, so it is unique and rises whoever writes.
    """

    def __init__(self, spark: SparkSession, root: str):
        layout = Layout(keys=("station_id", "strategy", "version"), bucket_by=("station_id",), buckets=BUCKETS, time="run_ts")
        self.spark = spark
        self.table = SnapshotTable(spark, root, layout)

    def save(self, inputs: DataFrame, nodes: DataFrame, run_ts: datetime, params: dict[str, object], scores: DataFrame | None = None) -> int:
        """Store models of any stations and strategies with one commit; returns their version.

        ``scores`` has ``station_id, model, mae`` for the run log.
        """
        settings = [F.lit(str(x)) for pair in sorted(params.items()) for x in pair]
        rows = inputs.select("station_id", "strategy", *INPUT_FIELDS, "explained_variance").join(packed(nodes), ["station_id", "strategy"])
        if scores is None:
            rows = rows.withColumn("mae", F.lit(None).cast("double"))
        else:
            rows = rows.join(scores.select("station_id", F.col("model").alias("strategy"), "mae"), ["station_id", "strategy"], "left")
        rows = rows.withColumns({"run_ts": F.lit(run_ts).cast("timestamp"), "params": F.create_map(*settings).cast("map<string,string>")})
        found = []

        def change(base) -> Change:
            found.append(base.version + 1)
            return Change(rows.withColumn("version", F.lit(base.version + 1).cast("long")))

        self.table.transact(change)
        return found[-1]

    def newest(self, strategies: Sequence[str] | None = None, stations: Sequence[str] | None = None) -> DataFrame:
        """One row per model, its newest version; listed stations go by the files that can hold them."""
        rows = self.table.read(stations=stations)
        if strategies is not None:
            rows = rows.where(F.col("strategy").isin(*strategies))
        # The versions are read as three narrow columns; the arrays are read for the newest ones only.
        last = rows.groupBy("station_id", "strategy").agg(F.max("version").alias("version"))
        return rows.join(last, ["station_id", "strategy", "version"], "left_semi")

    def nodes(self, strategies: Sequence[str] | None = None, stations: Sequence[str] | None = None) -> DataFrame:
        """One row per tree node of the newest models; leaves have ``feature_index`` -1."""
        return unpacked(self.newest(strategies, stations).select("station_id", "strategy", *NODE_FIELDS))

    def runs(self) -> DataFrame:
        """The log of all fits: settings and score."""
        return self.table.read().select(*LOG)
