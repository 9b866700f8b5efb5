"""Fitted models on disk, and their contents as tables.

A model lives in ``<root>/<strategy>/station=<id>/v=<n>`` in Spark ML's own format.  That format
holds the trees as parquet, so the node table is a plain scan of the saved models.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from urllib.parse import quote

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stationflow.config import DEFAULTS
from stationflow.models.trees import in_parallel
from stationflow.sources.store import TableMissing

INPUT_SCHEMA = (
    "station_id string, strategy string, version int, "
    "selected array<int>, mean array<double>, loadings array<double>"
)
RUN_SCHEMA = "run_ts timestamp, station_id string, strategy string, params map<string,string>, mae double"


class ModelRegistry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _folder(self, strategy: str, station: str) -> str:
        return f"{self.root}/{strategy}/station={quote(station, safe='')}"

    def versions(self, strategy: str, station: str) -> list[int]:
        """Complete versions in ascending order; the stage folder is written last."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        base = hadoop.Path(self._folder(strategy, station))
        fs = base.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(base):
            return []
        names = [status.getPath() for status in fs.listStatus(base)]
        done = [p for p in names if fs.exists(hadoop.Path(p, "_COMPLETE"))]
        return sorted(int(p.getName().removeprefix("v=")) for p in done)

    def save(self, strategy: str, station: str, model: PipelineModel) -> int:
        """Store a model as the next version; it counts once all of it is written."""
        number = max(self.versions(strategy, station), default=0) + 1
        folder = f"{self._folder(strategy, station)}/v={number}"
        model.write().overwrite().save(folder)
        self._write_inputs(strategy, station, number, model)
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        marker = hadoop.Path(f"{folder}/_COMPLETE")
        marker.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(marker).close()
        return number

    def save_all(self, strategy: str, models: dict[str, PipelineModel], parallelism: int = 4) -> None:
        in_parallel(self.spark, models.items(), lambda item: self.save(strategy, *item), parallelism)

    def load(self, strategy: str, station: str, version: int | None = None) -> PipelineModel:
        """A stored model, by default its newest version."""
        versions = self.versions(strategy, station)
        if not versions or (version is not None and version not in versions):
            raise TableMissing(f"{strategy} model of {station}")
        number = versions[-1] if version is None else version
        return PipelineModel.load(f"{self._folder(strategy, station)}/v={number}")

    def load_all(self, strategy: str, stations: Sequence[str], parallelism: int = 4) -> dict[str, PipelineModel]:
        """The newest model of each station that has one."""
        known = [s for s in stations if self.versions(strategy, s)]
        return dict(zip(known, in_parallel(self.spark, known, lambda s: self.load(strategy, s), parallelism)))

    def _write_inputs(self, strategy: str, station: str, version: int, model: PipelineModel) -> None:
        selected = mean = loadings = None
        if strategy == "topk":
            selected = [int(i) for i in model.stages[1].getIndices()]
        elif strategy == "pca":
            mean = [float(v) for v in model.stages[1].mean.toArray()]
            # One row of loadings per component, rows after each other.
            loadings = [float(v) for v in model.stages[2].pc.toArray().T.ravel()]
        row = [(station, strategy, version, selected, mean, loadings)]
        folder = f"{self._folder(strategy, station)}/v={version}/inputs"
        self.spark.createDataFrame(row, INPUT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(folder)

    def _newest_folders(self, strategies: Sequence[str], stations: Sequence[str]) -> list[str]:
        found = []
        for strategy in strategies:
            for station in stations:
                versions = self.versions(strategy, station)
                if versions:
                    found.append(f"{self._folder(strategy, station)}/v={versions[-1]}")
        return found

    def nodes(self, strategies: Sequence[str], stations: Sequence[str]) -> DataFrame:
        """One row per tree node of the newest models; leaves have ``feature_index`` -1.

        Feature indices count the model's own inputs; ``inputs`` tells what those are.
        """
        folders = self._newest_folders(strategies, stations)
        if not folders:
            raise TableMissing("no fitted models")
        path = F.col("_metadata.file_path")
        key = {
            "station_id": F.url_decode(F.url_decode(F.regexp_extract(path, r"/station=([^/]+)/", 1))),
            "strategy": F.regexp_extract(path, r"/([^/]+)/station=[^/]+/", 1),
        }
        reader = self.spark.read
        trees = reader.parquet(*[f"{f}/stages/*GBTRegressor*/treesMetadata" for f in folders]).select(
            *[c.alias(n) for n, c in key.items()], F.col("_1").alias("tree_id"), F.col("_3").alias("tree_weight")
        )
        node = F.col("nodeData")
        nodes = reader.parquet(*[f"{f}/stages/*GBTRegressor*/data" for f in folders]).select(
            *[c.alias(n) for n, c in key.items()],
            F.col("treeID").alias("tree_id"),
            node["id"].alias("node_id"),
            node["split"]["featureIndex"].alias("feature_index"),
            F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
            node["leftChild"].alias("left"),
            node["rightChild"].alias("right"),
            node["prediction"].alias("value"),
        )
        return nodes.join(trees, ["station_id", "strategy", "tree_id"]).withColumn(
            "threshold", F.coalesce("threshold", F.lit(0.0))
        )

    def inputs(self, strategies: Sequence[str], stations: Sequence[str]) -> DataFrame:
        folders = self._newest_folders(strategies, stations)
        return self.spark.read.schema(INPUT_SCHEMA).parquet(*[f"{f}/inputs" for f in folders])

    def log_runs(self, scores: DataFrame, strategy: str, params: dict[str, object], run_ts: datetime) -> None:
        """Append one row per fit: settings and score."""
        pairs = [F.lit(str(x)) for pair in sorted(params.items()) for x in pair]
        scores.select(
            F.lit(run_ts).cast("timestamp").alias("run_ts"),
            "station_id",
            F.lit(strategy).alias("strategy"),
            F.create_map(*pairs).alias("params"),
            "mae",
        ).write.mode("append").parquet(f"{self.root}/model_runs")

    def runs(self) -> DataFrame:
        return self.spark.read.schema(RUN_SCHEMA).parquet(f"{self.root}/model_runs")


def split_importance(nodes: DataFrame, n_features: int = DEFAULTS.n_lags) -> DataFrame:
    """How many splits use each feature; features without a split count 0."""
    used = (
        nodes.where(F.col("feature_index") >= 0)
        .groupBy("station_id", "strategy", "feature_index")
        .agg(F.count(F.lit(1)).alias("importance"))
    )
    every = (
        nodes.groupBy("station_id", "strategy")
        .agg(F.lit(1).alias("_one"))
        .select("station_id", "strategy", F.explode(F.sequence(F.lit(0), F.lit(n_features - 1))).alias("feature_index"))
    )
    return every.join(used, ["station_id", "strategy", "feature_index"], "left").withColumn(
        "importance", F.coalesce("importance", F.lit(0))
    )


def top_features(importance: DataFrame, k: int = DEFAULTS.top_k) -> DataFrame:
    """The ``k`` most used features of each model in ascending order of use.

    Equal counts are ordered by feature, the smaller index ranking higher.
    """
    order = Window.partitionBy("station_id", "strategy").orderBy(F.desc("importance"), "feature_index")
    return (
        importance.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .withColumn("position", F.lit(k) - F.col("rank"))
    )


def selected_features(top: DataFrame) -> dict[str, list[int]]:
    """The chosen feature indices per station, ten small numbers each, in ascending order of use."""
    ordered = F.transform(
        F.array_sort(F.collect_list(F.struct("position", "feature_index"))), lambda x: x["feature_index"]
    )
    rows = top.groupBy("station_id").agg(ordered.alias("selected")).collect()
    return {row["station_id"]: list(row["selected"]) for row in rows}
