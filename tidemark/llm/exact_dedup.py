"""Exact de-duplication by sorting contents."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ROW, SPACES, only_rows, staged, with_rows

PREFIX = 64  # characters of a text that splitters carry
LEAST_SLICE = 1000  # copies of one text that always go to one task
MOST_HOT = 100_000  # texts with more copies than a slice holds: at most so many


def normalised(text: Column) -> Column:
    """Each run of white space as one space; a single space is left in place."""
    return F.regexp_replace(text, rf"{SPACES}{{2,}}|[\x09-\x0D]", " ")


def exact_dedup(docs: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Per document: ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, and columns ``keys``.

    Sampled splitters over (start of the text, its hash) range-partition the normalised
    texts; an external sort inside each partition places equal texts side by side, and the
    running window compares each whole text with its neighbour. Splitters are short, so the
    sample that the driver sees is bounded. Texts travel once.

    Copies of one text beyond ``max(LEAST_SLICE, rows / MOST_HOT)`` are dealt to slices of
    that size by id; there are fewer than ``MOST_HOT`` such texts, so their hashes may be
    broadcast. Each slice is folded to its first row, and the few slice heads are merged by
    digest in a second step.

    Null text is the empty text. A null id sorts last and is kept only if every id of its
    group is null. Rows repeated under one id are copies like any other: one is kept. An
    empty table gives an empty result; other columns are not read.
    """
    text = normalised(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select("doc_id", *keys, text.alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    slice_rows = max(LEAST_SLICE, docs.count() // MOST_HOT)
    hot = (
        rows.groupBy("h")
        .agg(F.count("*").alias("copies"))
        .filter(F.col("copies") > slice_rows)
        .select("h", F.ceil(F.col("copies") / slice_rows).cast("int").alias("slices"))
    )
    placed = (
        rows.join(F.broadcast(hot), "h", "left")
        .withColumn("start", F.substring("text", 1, PREFIX))
        .withColumn(
            "slice",
            F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("slices")), F.lit(0)).cast("int"),
        )
        .repartitionByRange("start", "h", "slice")
    )
    equal = Window.partitionBy("start", "h", "slice", "text")
    sorted_ids = equal.orderBy(F.asc_nulls_last("doc_id"))
    folded = staged(
        placed.select(
            "doc_id",
            *keys,
            "slice",
            F.col("slices").isNotNull().alias("hot"),
            F.sha2("text", 256).alias("text_sha256"),
            F.min("doc_id").over(equal).alias("head_id"),
            F.count("*").over(equal).alias("n"),
            (F.row_number().over(sorted_ids) == 1).alias("head"),
        ),
        "sorted",
    )
    first = F.struct(F.col("head_id").isNull().alias("last"), "head_id", "slice")
    merged = (
        folded.filter("hot AND head")
        .groupBy("text_sha256")
        .agg(F.min(first).alias("first"), F.sum("n").alias("total"))
    )
    return folded.join(F.broadcast(merged), "text_sha256", "left").select(
        "doc_id",
        F.when(F.col("first").isNull(), F.col("head_id")).otherwise(F.col("first.head_id")).alias("keep_id"),
        F.coalesce("total", "n").alias("group_size"),
        (F.col("head") & F.coalesce(F.col("slice") == F.col("first.slice"), F.lit(True))).alias("kept"),
        "text_sha256",
        *keys,
    )


def stage(spark, docs: DataFrame, folder: str) -> DataFrame:
    """Exactly the rows that are kept, one for each text, whatever their ids."""
    keyed = with_rows(docs)
    return only_rows(keyed, exact_dedup(keyed, (ROW,)).filter("kept"))
