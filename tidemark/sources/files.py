"""Batch file sources."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    infer: bool = False,
    corrupt: bool = False,
) -> DataFrame:
    """CSV whose header names the columns, in any order.

    The explicit schema saves the extra pass that inference costs. A missing or unknown
    column raises, and so does a file whose header differs from the first file's. A bad cell
    fails the read; with ``corrupt`` its line is kept in a column of its own instead.
    """
    reader = spark.read.option("header", True)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    schema = schema or S.raw_schema()
    header = reader.csv(path).columns  # reads one line
    missing, unknown = set(schema.names) - set(header), set(header) - set(schema.names)
    if missing or unknown:
        raise ValueError(f"{path}: missing columns {sorted(missing)}, unknown {sorted(unknown)}")
    in_file = [schema[name] for name in header]
    reader = reader.option("enforceSchema", False)
    wanted = [F.col(f"`{name}`") for name in schema.names]
    if not corrupt:
        return reader.option("mode", "FAILFAST").schema(T.StructType(in_file)).csv(path).select(wanted)
    marked = T.StructType([*in_file, T.StructField(S.CORRUPT, T.StringType())])
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", S.CORRUPT)
    return reader.schema(marked).csv(path).select(*wanted, S.CORRUPT)


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_batches(spark: SparkSession, folder: str) -> DataFrame:
    """All ``batch_<id>`` folders below ``folder`` as one table."""
    return spark.read.parquet(f"{folder}/*")


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Scoring requests as JSON lines; one that is damaged or mistyped fails the read."""
    return spark.read.schema(S.request_schema()).option("mode", "FAILFAST").json(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
