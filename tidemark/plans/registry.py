"""Run records and model versions as append-only parquet tables.

One writer at a time: the next version is the highest one plus one, read before the append.
"""

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import ranking
from tidemark.sinks.files import remove
from tidemark.sources.files import load_model


def _read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table, or an empty one before the first append."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return _read_table(spark, path, S.RUNS_SCHEMA)


def append_runs(runs: DataFrame, path: str) -> None:
    """Add run records; columns a writer does not know are NULL."""
    columns = [
        (F.col(f.name) if f.name in runs.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in S.RUNS_SCHEMA
    ]
    runs.select(*columns).coalesce(1).write.mode("append").parquet(path)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return _read_table(spark, path, S.REGISTRY_SCHEMA)


def register(
    spark: SparkSession, path: str, run_id: str, uri: str, name: str = S.MODEL_NAME
) -> int:
    """Append ``run_id`` as the next version of ``name``."""
    known = read_registry(spark, path).filter(F.col("name") == name)
    version = (known.agg(F.max("version")).first()[0] or 0) + 1
    row = spark.createDataFrame([(name, version, run_id, uri)], S.REGISTRY_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(path)
    return version


def latest_uri(spark: SparkSession, path: str, name: str = S.MODEL_NAME) -> str:
    """Where the newest version of ``name`` is stored."""
    known = read_registry(spark, path).filter(F.col("name") == name)
    newest = ranking.latest_version(known).first()
    if newest is None:
        raise ValueError(f"No registered model: {name}")
    return newest["uri"]


class LatestModel:
    """The newest registered model, called for each use.

    The registry is read each time, which is one small table; the artifact is loaded only
    when another version has become the newest.
    """

    def __init__(self, spark: SparkSession, path: str, name: str = S.MODEL_NAME):
        self.spark, self.path, self.name = spark, path, name
        self.uri = self.model = None

    def __call__(self, uri: str | None = None) -> PipelineModel:
        """The newest one, or the one stored at ``uri``."""
        uri = uri or self.newest()
        if uri != self.uri:
            self.model, self.uri = load_model(uri), uri
        return self.model

    def newest(self) -> str:
        return latest_uri(self.spark, self.path, self.name)


class PinnedModel:
    """The model of a micro-batch: the newest one when the batch is first begun, then that one.

    The choice is written down before the batch is scored, so a batch replayed after a failure
    is scored by its first model though another version has been registered since. A record
    that a failure cut short counts as none: nothing was scored yet. As in Spark's own logs the
    last ``RECORDS`` batches are kept.
    """

    RECORDS = 100

    def __init__(self, latest: LatestModel, log: str):
        self.latest, self.log = latest, log

    def __call__(self, batch_id: int) -> PipelineModel:
        spark, path = self.latest.spark, f"{self.log}/batch_{batch_id}"
        known = _read_table(spark, path, S.PINNED_SCHEMA).first()
        if known:
            return self.latest(known["uri"])
        uri = self.latest.newest()
        record = spark.createDataFrame([(batch_id, uri)], S.PINNED_SCHEMA)
        record.coalesce(1).write.mode("overwrite").parquet(path)
        if batch_id >= self.RECORDS:
            remove(spark, f"{self.log}/batch_{batch_id - self.RECORDS}")
        return self.latest(uri)


def register_best_past_run(
    spark: SparkSession,
    runs_path: str,
    registry_path: str,
    experiment: str = S.EXPERIMENT,
    metric: str = S.SELECTION_METRIC,
    name: str = S.MODEL_NAME,
) -> int:
    """Register the best run an experiment has on record."""
    runs = read_runs(spark, runs_path)
    best = ranking.best_run_in_experiment(runs, experiment, metric).first()
    if best is None:
        raise ValueError(f"No runs found for experiment: {experiment}")
    return register(spark, registry_path, best["run_id"], best["uri"], name)
