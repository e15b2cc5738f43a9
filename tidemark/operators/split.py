"""Deterministic stratified split and class weights."""

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.session import scratch_path

HASH = "_hash"
HASH_BYTES = 16
LEVEL_BYTES = 2
PIECES = 256**LEVEL_BYTES  # counts per class and level, and the most that one task orders
COPIES_PER_CHUNK = 1_000_000
ROWS = "_rows"  # how many rows a profile stands for
CLASSES = (0, 1)  # the label's values by contract; other labels name theirs


def row_hash(columns: list[str], seed: int) -> Column:
    """md5 over the row's values and the seed."""
    values = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\N")) for c in columns]
    return F.unhex(F.md5(F.concat_ws("\x1f", *values, F.lit(str(seed)))))


def per_class(table: DataFrame, label: str, classes: tuple = CLASSES) -> dict:
    """A table with one row per class, keyed by class. Refuses a value that is no class.

    NULL counts as a class of its own.
    """
    rows = table.limit(len(classes) + 2).collect()
    strange = {row[label] for row in rows} - {*classes, None}
    if strange:
        raise ValueError(f"{label} has values beside {list(classes)}: {sorted(map(str, strange))[:3]}")
    return {row[label]: row for row in rows}


def by_class(label: str, values: dict) -> Column:
    """The value that belongs to the row's class; NULL for a class without one."""
    chosen = F.lit(None)
    for key, value in values.items():
        chosen = F.when(F.col(label).eqNullSafe(F.lit(key)), F.lit(value)).otherwise(chosen)
    return chosen


def test_sizes(class_rows: dict, fraction: float) -> dict:
    """Test rows per class.

    The test part has ceil(fraction * n) rows. Train seats are shared out in proportion,
    rounded down, and seats left over go to the largest remainders.
    """
    total = sum(class_rows.values())
    train = total - math.ceil(fraction * total)
    shares = {c: n / total * train for c, n in class_rows.items()}
    seats = {c: math.floor(share) for c, share in shares.items()}
    by_remainder = sorted(shares, key=lambda c: (seats[c] - shares[c], str(c)))
    for c in by_remainder[: train - sum(seats.values())]:
        seats[c] += 1
    return {c: n - seats[c] for c, n in class_rows.items()}


def _inside(label: str, prefixes: dict) -> Column:
    """Rows whose hash starts with their class's prefix."""
    tests = [
        F.col(label).eqNullSafe(F.lit(c)) & F.startswith(F.col(HASH), F.lit(prefix))
        for c, prefix in prefixes.items()
    ]
    return reduce(or_, tests, F.lit(False))


def cut_points(hashed: DataFrame, label: str, fraction: float, classes: tuple = CLASSES) -> dict:
    """Per class: the hash where the test part ends, rows to take of it, rows having it.

    No class is sorted as a whole. Counts per hash prefix show which prefix holds the
    cut; the next pass counts only below that prefix, with more bytes, and the last one
    whole hashes. Class sizes tell how many passes leave about ``PIECES`` hashes to order.
    Counting folds copies inside each task. The driver sees one row per class and pass.
    """
    counted = per_class(hashed.groupBy(label).agg(F.count("*").alias("n")), label, classes)
    sizes = {c: row["n"] for c, row in counted.items()}
    wanted = {c: n for c, n in test_sizes(sizes, fraction).items() if n > 0}
    prefixes = dict.fromkeys(wanted, b"")
    levels, largest = [], max(sizes.values(), default=0)
    while largest > PIECES and len(levels) < HASH_BYTES // LEVEL_BYTES - 1:
        levels.append((len(levels) + 1) * LEVEL_BYTES)
        largest /= PIECES
    found = {}
    for length in [*levels, HASH_BYTES]:
        running = (
            Window.partitionBy(label)
            .orderBy("piece")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        target = by_class(label, wanted)
        found = per_class(
            hashed.filter(_inside(label, prefixes))
            .groupBy(label, F.substring(HASH, 1, length).alias("piece"))
            .agg(F.count("*").alias("n"))
            .withColumn("upto", F.sum("n").over(running))
            .filter((F.col("upto") - F.col("n") < target) & (F.col("upto") >= target)),
            label,
            classes,
        )
        prefixes = {c: bytes(row["piece"]) for c, row in found.items()}
        wanted = {c: wanted[c] - (row["upto"] - row["n"]) for c, row in found.items()}
    return {c: (prefixes[c], wanted[c], row["n"]) for c, row in found.items()}


def stratified_split(
    df: DataFrame,
    label: str = S.LABEL,
    fraction: float = S.TEST_FRACTION,
    seed: int = S.SEED,
    key: list[str] | None = None,
    classes: tuple = CLASSES,
) -> DataFrame:
    """Add ``split`` (``train`` or ``test``), exact per class.

    ``key`` names the columns that tell rows apart, all of them by default; rows with equal
    keys are copies. ``classes`` are the label's values; another value raises.

    Within a class the rows with the smallest hashes are the test part, so membership
    depends on values only and survives any repartitioning or recomputation. ``df`` is
    computed once: its rows and their hashes are written to the shared folder, the passes
    that find the cut read only label and hash there, and the result is a narrow scan.

    Where the cut falls among copies of one row, the copies are counted and dealt out
    anew in chunks, so that a row making up much of the table needs no single task.
    """
    columns = df.columns
    path = scratch_path(df.sparkSession, "hashed")
    df.withColumn(HASH, row_hash(key or columns, seed)).write.parquet(path)
    hashed = df.sparkSession.read.parquet(path)
    cuts = cut_points(hashed.select(label, HASH), label, fraction, classes)
    cut = by_class(label, {c: point[0] for c, point in cuts.items()})
    is_test = F.coalesce(F.col(HASH) <= cut, F.lit(False))
    marked = hashed.withColumn("split", F.when(is_test, "test").otherwise("train"))

    shared = {c: point for c, point in cuts.items() if point[1] < point[2]}
    if not shared:
        return marked.select(*columns, "split")
    dealt = _inside(label, {c: point[0] for c, point in shared.items()})
    take = by_class(label, {c: point[1] for c, point in shared.items()})
    rest = marked.filter(~dealt).select(*columns, "split")
    return rest.unionByName(_deal(hashed.filter(dealt), columns, label, take))


def _deal(copies: DataFrame, columns: list[str], label: str, take: Column) -> DataFrame:
    """``take`` of each class's copies as test rows, the others as train rows."""
    counted = copies.groupBy(*columns).agg(F.count("*").alias("n"))
    running = (
        Window.partitionBy(label)
        .orderBy(*columns)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = F.sum("n").over(running) - F.col("n")
    to_test = F.greatest(F.lit(0), F.least(F.col("n"), take - F.col("before")))
    shares = F.array(
        F.struct(F.lit("test").alias("split"), F.col("to_test").alias("n")),
        F.struct(F.lit("train").alias("split"), (F.col("n") - F.col("to_test")).alias("n")),
    )
    parts = (
        counted.withColumn("before", before)
        .withColumn("to_test", to_test)
        .select(*columns, F.explode(shares).alias("share"))
        .select(*columns, "share.split", "share.n")
    )
    return _repeat(parts, [*columns, "split"])


def in_fixed_order(df: DataFrame, rows: int) -> DataFrame:
    """The same rows in the same partitions and order, whatever files they come from.

    Anything drawn by partition and position, as Spark ML draws its bootstrap samples, then
    depends on values alone. Their number follows ``rows``, the size of ``df``; copies of one
    row are counted and dealt out again in chunks, so that they need no single partition. Where
    no row has as many copies as a chunk holds, the rows travel once, to the same places.
    """
    if not may_crowd(df):
        keys = [F.col(f"`{c}`") for c in df.columns]
        first = F.lit(0).cast("bigint")  # every chunk's start
        return df.repartition(fixed_partitions(rows), *keys, first).sortWithinPartitions(*keys)
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    return _repeat(counted, df.columns, fixed_partitions(rows))


def may_crowd(df: DataFrame) -> bool:
    """Whether some row may have more copies than a chunk holds.

    Counts per bucket of the row's hash fold inside each task; a bucket within a chunk's size
    rules it out for all its rows.
    """
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(PIECES))
    crowded = df.groupBy(bucket).agg(F.count("*").alias("n")).filter(F.col("n") > COPIES_PER_CHUNK)
    return not crowded.isEmpty()


def profiles(df: DataFrame) -> DataFrame:
    """Each distinct row once, with the number of its copies in ``_rows``."""
    return df.groupBy(*df.columns).agg(F.count("*").alias(ROWS))


def profiles_in_fixed_order(df: DataFrame, rows: int) -> DataFrame:
    """``profiles`` in partitions and an order that their values alone decide; ``rows`` as in
    ``in_fixed_order``. Copies fold inside each task before they travel, so there are fewer
    partitions than of rows, but no more than two million profiles in one if all differ."""
    keys = [F.col(f"`{c}`") for c in df.columns]
    partitions = max(1, min(-(-rows // 100_000), 64), -(-rows // 2_000_000))
    return profiles(df).repartition(partitions, *keys).sortWithinPartitions(*keys)


def fixed_partitions(rows: int) -> int:
    """A number of partitions that rows decide and no setting: 20,000 rows each in small
    tables, which keeps a machine busy, and two million in large ones."""
    return max(1, min(-(-rows // 20_000), 200), -(-rows // 2_000_000))


def _repeat(counted: DataFrame, columns: list[str], partitions: int | None = None) -> DataFrame:
    """Each row ``n`` times, in chunks spread over the tasks.

    With ``partitions`` there are so many, each in the order of the rows' values.
    """
    size = F.lit(COPIES_PER_CHUNK).cast("bigint")
    chunks = (
        counted.filter("n > 0")
        .withColumn("_from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, size)))
        .withColumn("_rows", F.least(size, F.col("n") - F.col("_from")))
    )
    keys = [*[F.col(f"`{c}`") for c in columns], F.col("_from")]
    if partitions:
        spread = chunks.repartition(partitions, *keys).sortWithinPartitions(*keys)
    else:
        spread = chunks.repartition(*keys)
    return spread.withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_rows")))
    ).select(*columns)


def class_weights(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Balanced weight n / (classes * n_class): one row per class."""
    every_class = Window.partitionBy()
    return (
        df.groupBy(label)
        .agg(F.count("*").alias("class_rows"))
        .withColumn(
            "class_weight",
            F.sum("class_rows").over(every_class)
            / (F.count("*").over(every_class) * F.col("class_rows")),
        )
    )


def exact_weights(weights: dict, rows: int) -> dict:
    """Weights as multiples of a power of two so small that sums over ``rows`` rows are exact.

    Sums then don't depend on the order in which tasks deliver their parts. A weight changes
    by some 1e-15 times the number of rows.
    """
    step = 2.0 ** (math.ceil(math.log2(max(rows, 1))) + 3 - 53)
    return {label: round(weight / step) * step for label, weight in weights.items()}


def with_class_weight(df: DataFrame, weights: dict, label: str = S.LABEL) -> DataFrame:
    """Attach the class's weight to every row; ``weights`` is keyed by class."""
    return df.withColumn("class_weight", by_class(label, weights).cast("double"))
