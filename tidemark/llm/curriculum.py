"""A mix of sources whose weights vary over training, as positions of documents."""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

# --- Fixed values: what a word is, and the weights of sources in turn ---
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
# --- End of fixed values ---

#: Schedules of sources in turn, as (time, weight) from 0 to 1. Their integrals are ``WEIGHTS``:
#: heavy sources lead early, light ones late.
SCHEDULES = tuple(
    [(0.0, w * (1 + tilt)), (1.0, w * (1 - tilt))] for w, tilt in zip(WEIGHTS, (0.5, 0.0, -0.5))
)

CHUNK = 1000  # rows equal in id, source and size that travel as one
BUCKET_ROWS = 10_000  # rows of a source that one window orders, about
MOST_DIGITS = 5  # of the hash, 16^5 buckets of a source at most


def integral(schedule) -> float:
    """Area below the schedule, which is linear between its knots."""
    return sum((a + b) / 2 * (t1 - t0) for (t0, a), (t1, b) in zip(schedule, schedule[1:]))


def when_reached(schedule, share: Column) -> Column:
    """The time at which a schedule has brought ``share`` (0 to 1) of its whole area."""
    found, area = F.lit(None).cast("double"), integral(schedule)
    pieces, done = [], 0.0
    for (t0, a), (t1, b) in zip(schedule, schedule[1:]):
        pieces.append((t0, t1, a, b, done))
        done += (a + b) / 2 * (t1 - t0)
    for t0, t1, a, b, before in reversed(pieces):
        y = F.greatest(share * F.lit(area) - F.lit(before), F.lit(0.0))
        slope = (b - a) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(a * a) + F.lit(2 * slope) * y, F.lit(0.0)))
        x = F.when(y > 0, 2 * y / (F.lit(a) + root)).otherwise(F.lit(0.0))
        at = F.least(F.lit(t0) + x, F.lit(t1))
        later = share * F.lit(area) > F.lit(before + (a + b) / 2 * (t1 - t0))
        found = at if t1 == schedule[-1][0] else F.when(later, found).otherwise(at)
    return found


def targets(sizes: DataFrame, schedules=SCHEDULES, most: int = MOST_PASSES) -> DataFrame:
    """Per source: ``source_size``, ``turn`` (its schedule), ``target``, ``goal`` (whole words).

    ``sizes`` has one row per source. Sources take schedules in turn by code point, null
    last; a target is the share of all words by integrated weight, stopped at ``most`` times
    the source, what is above going to the others by weight. Sorted by limit over weight, the
    stopped sources come first: source k is stopped if the words and weights left by those
    before it would give it more than its limit.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    turn = ((F.row_number().over(by_name) - 1) % len(schedules)).cast("int")
    areas = F.array(*[F.lit(float(integral(s))) for s in schedules])
    ranked = (
        sizes.withColumn("turn", turn)
        .withColumn("weight", areas[F.col("turn")])
        .withColumn("limit", F.lit(most).cast("bigint") * F.col("source_size"))
        .withColumn("fills", F.try_divide(F.col("limit").cast("double"), F.col("weight")))
    )
    order = Window.orderBy(F.asc_nulls_last("fills"), F.asc_nulls_last("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = ranked.select(
        "*",
        (
            F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0))
        ).cast("double").alias("words_left"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias(
            "weight_left"
        ),
    )
    stopped = F.col("weight") * F.col("words_left") > F.col("limit") * F.col("weight_left")
    level = F.max(
        F.when(~stopped, F.try_divide(F.col("words_left"), F.col("weight_left")))
    ).over(every)
    target = F.when(stopped, F.col("limit").cast("double")).otherwise(
        F.least(F.col("weight") * F.coalesce(level, F.lit(0.0)), F.col("limit").cast("double"))
    )
    return left.select("source", "source_size", "turn", target.alias("target")).withColumn(
        "goal", F.round("target").cast("bigint")
    )


def assigned(docs: DataFrame, schedules=SCHEDULES, most: int = MOST_PASSES) -> DataFrame:
    """Per document, in no order: its size, its source's size and target, and its ``passes``.

    ``passes`` lists (pass, words, position): a source is read again and again, in the order of
    md5 over id and size, until its whole-word target is met; the last pass may cut one
    document. An occurrence's position is the time at which the source's schedule has brought
    the words up to its middle.

    Words before a document are a running sum within its (source, bucket of hashes) plus the
    sums of earlier buckets. Buckets are prefixes of a hash, so a source that is much of the
    table is spread evenly, and their number follows the rows. Rows equal in id, source and
    size are interchangeable: they are folded, numbered and unfolded in chunks that have
    hashes of their own.

    Null text has size 0; a null source is a source, the last one; a null id is an id. Sources
    and documents without words are taken zero times. Repeated rows are documents of their
    own. No other column is read. An empty table gives an empty result.
    """
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    rows = staged(docs.select("doc_id", "source", words.alias("size")), "sizes")
    sources = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("source_rows")
    )
    wanted = staged(targets(sources.drop("source_rows"), schedules, most), "targets")
    total = rows.count()
    digits = min(MOST_DIGITS, max(1, math.ceil(math.log(max(total / BUCKET_ROWS, 1), 16))))

    start = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(CHUNK).cast("bigint")))
    chunks = (
        rows.groupBy("doc_id", "source", "size")
        .agg(F.count("*").alias("n"))
        .withColumn("start", start)
        .withColumn("n", F.least(F.col("n") - F.col("start"), F.lit(CHUNK)))
        .withColumn(
            "h",
            F.md5(
                F.concat_ws(
                    ":",
                    F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                    F.col("size").cast("string"),
                    F.col("start").cast("string"),
                )
            ),
        )
        .withColumn("bucket", F.substring("h", 1, digits))
        .withColumn("words", F.col("n") * F.col("size"))
    )
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size")
    summed = staged(
        chunks.withColumn(
            "inside",
            F.coalesce(
                F.sum("words").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        ),
        "summed",
    )
    earlier = Window.partitionBy("source").orderBy("bucket")
    buckets = staged(
        summed.groupBy("source", "bucket")
        .agg(F.sum("words").alias("words"))
        .select(
            F.col("source").alias("of_source"),
            F.col("bucket").alias("of_bucket"),
            F.coalesce(
                F.sum("words").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("earlier"),
        ),
        "buckets",
    )
    of = wanted.withColumnRenamed("source", "in_source")
    placed = (
        summed.join(
            buckets,
            F.col("source").eqNullSafe(F.col("of_source"))
            & (F.col("bucket") == F.col("of_bucket")),
        )
        .join(of, F.col("source").eqNullSafe(F.col("in_source")))
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
        .withColumn(
            "ahead", F.col("earlier") + F.col("inside") + F.col("copy") * F.col("size")
        )
    )
    whole = F.when(
        F.col("source_size") > 0, F.expr("goal div nullif(source_size, 0)")
    ).otherwise(F.lit(0).cast("bigint"))
    rest = F.col("goal") - F.col("whole") * F.col("source_size")
    cut = F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), rest - F.col("ahead")))

    def occurrence(number: Column) -> Column:
        taken = F.when(number < F.col("whole"), F.col("size")).otherwise(F.col("cut"))
        middle = number * F.col("source_size") + F.col("ahead") + taken / 2
        share = F.try_divide(middle.cast("double"), F.col("goal").cast("double"))
        position = F.lit(None).cast("double")
        for turn, schedule in enumerate(schedules):
            position = F.when(F.col("turn") == turn, when_reached(schedule, share)).otherwise(position)
        return F.struct(
            number.cast("int").alias("pass"),
            taken.alias("words"),
            position.alias("position"),
        )

    passes = F.filter(
        F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("whole")), occurrence),
        lambda p: p["words"] > 0,
    )
    return (
        placed.withColumn("whole", whole)
        .withColumn("cut", cut)
        .select("doc_id", "source", "size", "source_size", "target", passes.alias("passes"))
    )


def curriculum(docs: DataFrame, schedules=SCHEDULES, most: int = MOST_PASSES) -> DataFrame:
    """The training order: an occurrence of a document per row, range-sorted by position.

    ``doc_id``, ``source``, ``pass``, ``words`` (the first so many are read) and ``position``
    between 0 and 1. Ties go by source, id and pass, null first.
    """
    occurrences = assigned(docs, schedules, most).select(
        "doc_id", "source", F.explode("passes").alias("p")
    ).select("doc_id", "source", "p.pass", "p.words", "p.position")
    order = ["position", "source", "doc_id", "pass"]
    return occurrences.repartitionByRange(*order).sortWithinPartitions(*order)


def mix(docs: DataFrame) -> DataFrame:
    """Documents range-sorted by their first position, those not taken at the end.

    ``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` (words over all passes),
    ``n_passes`` and ``first_position``.
    """
    words = F.aggregate("passes", F.lit(0).cast("bigint"), lambda n, p: n + p["words"])
    first = F.array_min(F.transform("passes", lambda p: p["position"]))
    rows = assigned(docs).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        words.alias("taken"),
        F.size("passes").alias("n_passes"),
        first.alias("first_position"),
    )
    order = [F.asc_nulls_last("first_position"), F.asc("doc_id")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def oracle() -> str:
    """The same as SQL; rows equal in id, source and size would need the chunks' numbers."""

    def cases(of) -> str:
        return " ".join(f"WHEN {i} THEN {of(s)}" for i, s in enumerate(SCHEDULES))

    def position(schedule) -> str:
        (_, a), (_, b) = schedule
        y = f"greatest(share * {integral(schedule)!r}::DOUBLE, 0::DOUBLE)"
        root = f"sqrt(greatest({a * a!r}::DOUBLE + {2 * (b - a)!r}::DOUBLE * {y}, 0::DOUBLE))"
        return f"least(CASE WHEN {y} > 0 THEN 2 * {y} / ({a!r}::DOUBLE + {root}) ELSE 0 END, 1)"

    return rf"""
WITH sized AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size
    FROM documents
), named AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(SCHEDULES)} AS turn
    FROM sized GROUP BY source
), weighed AS (
    SELECT *, CAST(CASE turn {cases(integral)} END AS DOUBLE) AS weight,
           {MOST_PASSES} * source_size AS most
    FROM named
), remaining AS (
    SELECT *,
           CAST(sum(source_size) OVER () - coalesce(sum(most) OVER before, 0) AS DOUBLE) AS words_left,
           sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight_left
    FROM weighed
    WINDOW before AS (ORDER BY most / weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), judged AS (
    SELECT *, weight * words_left > most * weight_left AS stopped FROM remaining
), wanted AS (
    SELECT source, source_size, turn,
           CASE WHEN stopped THEN CAST(most AS DOUBLE)
                ELSE least(weight * coalesce(max(CASE WHEN NOT stopped THEN words_left / weight_left END)
                                             OVER (), 0), CAST(most AS DOUBLE)) END AS target
    FROM judged
), goals AS (
    SELECT *, CAST(round(target) AS BIGINT) AS goal,
           CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS whole
    FROM wanted
), placed AS (
    SELECT d.doc_id, d.size, g.*,
           CAST(coalesce(sum(d.size) OVER (
               PARTITION BY d.source ORDER BY md5(coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || d.size || ':0')
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS ahead
    FROM sized d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
), cuts AS (
    SELECT *, greatest(0, least(size, goal - whole * source_size - ahead)) AS cut FROM placed
), firsts AS (
    SELECT *, whole * size + cut AS taken,
           (CASE WHEN size > 0 THEN whole ELSE 0 END) + (CASE WHEN cut > 0 THEN 1 ELSE 0 END) AS n_passes,
           CAST(ahead + (CASE WHEN whole > 0 THEN size ELSE cut END) / 2 AS DOUBLE) / CAST(goal AS DOUBLE) AS share
    FROM cuts
)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken,
       CAST(n_passes AS INTEGER) AS n_passes,
       CASE WHEN taken > 0 THEN CASE turn {cases(position)} END END AS first_position
FROM firsts
"""
