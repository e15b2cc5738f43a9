"""Bronze, silver and gold as written layers."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.operators import features, reports
from tidemark.sinks.files import write_layer
from tidemark.sources.files import read_csv, read_layer


def bronze_layer(raw: DataFrame, path: str) -> str:
    """Raw rows as they came."""
    return write_layer(raw, path)


def silver_layer(spark: SparkSession, bronze_path: str, path: str) -> str:
    return write_layer(features.silver(read_layer(spark, bronze_path)), path)


def gold_layer(spark: SparkSession, silver_path: str, path: str) -> str:
    return write_layer(features.gold(read_layer(spark, silver_path)), path)


def run_layers(raw: DataFrame, out: str) -> DataFrame:
    """Write all three layers below ``out``; returns their row counts.

    Each layer is computed once. The counts come from the parquet footers, so a task that
    ran twice after a lost executor is still counted once.
    """
    spark = raw.sparkSession
    paths = {name: f"{out}/{name}" for name in ("bronze", "silver", "gold")}
    bronze_layer(raw, paths["bronze"])
    silver_layer(spark, paths["bronze"], paths["silver"])
    gold_layer(spark, paths["silver"], paths["gold"])
    return reports.layer_counts(spark, paths)


def run_etl(
    spark: SparkSession,
    source: str,
    out: str,
    schema: T.StructType | None = None,
    infer: bool = False,
    quarantine: str | None = None,
) -> DataFrame:
    """CSV at ``source`` through all layers.

    A row that does not fit the schema fails the job, unless ``quarantine`` names a folder
    for such rows; the others then go on.
    """
    if quarantine is None:
        return run_layers(read_csv(spark, source, schema, infer), out)
    rows = read_csv(spark, source, schema, corrupt=True)
    write_layer(rows.filter(F.col(S.CORRUPT).isNotNull()), quarantine)
    return run_layers(rows.filter(F.col(S.CORRUPT).isNull()).drop(S.CORRUPT), out)
