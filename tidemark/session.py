"""Session settings and the shared work folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

# Day differences depend on the session zone, so it is pinned rather than inherited.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


SHUFFLE_BYTES = 64 * 1024 * 1024  # input behind one shuffle partition
LEAST_PARTITIONS = 200  # Spark's own default


def shuffle_partitions(input_bytes: int, each: int = SHUFFLE_BYTES) -> int:
    """Partitions for shuffles of so much input: about ``each`` bytes in one.

    Adaptive execution merges partitions that turn out small but never splits a plain
    shuffle's, so a session for large tables starts from this number.
    """
    return max(LEAST_PARTITIONS, -(-input_bytes // each))


def build_session(
    app: str = "tidemark", master: str | None = None, input_bytes: int | None = None, **settings
) -> SparkSession:
    """A session with the runtime settings; the cluster names the master.

    ``input_bytes`` is the size of the tables the session will read; it sizes the shuffles,
    once. No later call changes them.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = {}
    if input_bytes is not None:
        sized["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes))
    for key, value in {**RUNTIME_SETTINGS, **sized, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session in one process without that setting gets a temporary folder.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not folder:
        folder = sc.getCheckpointDir()
    if not folder:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
