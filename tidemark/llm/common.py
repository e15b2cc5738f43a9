"""What the corpus operators share: reading, staging, fixed hash splits, Arrow maps."""

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path
from tempfile import mkdtemp
from zipfile import ZipFile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tidemark
from tidemark.session import scratch_path

# --- Fixed values: white space of the word contracts, as bytes.split() and as a pattern ---
SPACES = r"[\x20\x09-\x0D]"
# --- End of fixed values ---

ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<bigint>": pa.list_(pa.int64()),
    "array<double>": pa.list_(pa.float64()),
}

ROW = "_row"  # a row's key inside the pipeline's stages
BATCH_ROWS = 500  # rows that a Python task gets at once


def read(spark: SparkSession, folder: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, null text as empty: other columns can't clash."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def remainder(modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as -1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus, F.lit(-1))


_WRITTEN: list[list[str]] = []  # paths that are noted, for each ``noted`` under way


@contextmanager
def noted() -> Iterator[list[str]]:
    """The paths written below the shared folder meanwhile, in order."""
    paths: list[str] = []
    _WRITTEN.append(paths)
    try:
        yield paths
    finally:
        _WRITTEN.pop()


def noted_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, known to whoever takes notes."""
    path = scratch_path(spark, name)
    for paths in _WRITTEN:
        paths.append(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, lineage cut."""
    path = noted_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once, unless they have it already."""
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    root = Path(tidemark.__file__).parent
    archive = Path(mkdtemp(prefix="tidemark-code-")) / "tidemark.zip"  # Spark serves it from here
    with ZipFile(archive, "w") as out:
        for path in root.rglob("*.py"):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._tidemark_shipped = True


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def lists(values, sizes) -> pa.Array:
    """Consecutive runs of ``values`` as lists."""
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def with_rows(docs: DataFrame) -> DataFrame:
    """``docs`` with a written key for each row, ``ROW``; ids may repeat or be missing."""
    return staged(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")


def only_rows(keyed: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``with_rows`` whose key is in ``kept``, without the key."""
    return keyed.join(kept.select(ROW), ROW, "left_semi").drop(ROW)


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str
) -> DataFrame:
    """``mapInArrow`` with small batches; ``function`` yields columns by name."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    arrow = pa.schema([(n, ARROW[kind]) for n, kind in (c.split() for c in schema.split(", "))])

    def run(batches):
        for columns in function(batches):
            yield pa.RecordBatch.from_arrays(
                [_array(columns[f.name], f.type) for f in arrow], schema=arrow
            )

    return df.mapInArrow(run, schema)


def filter_batches(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], list[bool]]]
) -> DataFrame:
    """Whole rows that pass; ``make`` gives each task its test of a batch."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def run(batches):
        keep = make()
        for batch in batches:
            yield batch.filter(pa.array(keep(batch), pa.bool_()))

    return df.mapInArrow(run, df.schema)
