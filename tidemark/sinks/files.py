"""Batch file sinks."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S

EVENTS_PER_FILE = 500_000  # a compressed file is read by one task


def write_layer(df: DataFrame, path: str) -> str:
    """Overwrite a parquet layer. ``df`` must not read from ``path``."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_batch(df: DataFrame, folder: str, batch_id: int) -> str:
    """One folder per micro-batch: a replayed batch replaces its own output."""
    return write_layer(df, f"{folder}/batch_{batch_id}")


def write_events(rows: DataFrame, path: str, most: int = EVENTS_PER_FILE) -> str:
    """Append JSON event files of ``most`` events at most, compressed.

    A single column ``value`` holds lines that are written as they are. The tasks that have the rows write them: nothing is shuffled, and the number of files grows
    with the rows, so none is more than one task should read.
    """
    fast = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    writer = rows.write.mode("append").options(maxRecordsPerFile=most, **fast)
    if rows.columns == ["value"]:
        writer.text(path)
    else:
        writer.json(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in whatever store the path names; one that is absent is fine."""
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(context._jsc.hadoopConfiguration()).delete(found, True)


def remove_batch(spark: SparkSession, folder: str, batch_id: int) -> None:
    """Take a batch's output away, and the folder if nothing else is in it."""
    remove(spark, f"{folder}/batch_{batch_id}")
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(folder)
    store = found.getFileSystem(context._jsc.hadoopConfiguration())
    if store.exists(found) and not len(store.listStatus(found)):
        store.delete(found, False)


def write_leaderboard_csv(board: DataFrame, path: str, params: list[str]) -> str:
    """One CSV file in rank order, each named parameter in a column of its own.

    A board has one row per run, so a single task writes it.
    """
    (
        board.repartition(1)
        .sortWithinPartitions("rank")
        .select(
            "run_id",
            "run_name",
            "model_type",
            *S.METRICS,
            *[F.col("params").getItem(name).alias(name) for name in params],
        )
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )
    return path


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path
