"""Appointment-shaped rows from the order tables, used by queries, tests and bench.

Every lineitem with its order becomes one raw row. Rows whose id leaves 1 modulo 50 appear
twice: added copies that give de-duplication something to do.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import features

ID_TYPE = "bigint"  # order keys of a large table times ten outgrow an int

FROM_ORDERS = {
    "PatientId": "cast(o_custkey as double)",
    "ScheduledDay": "cast(o_orderdate as timestamp)",
    "Neighbourhood": "o_orderpriority",
    "No-show": "case when o_orderstatus = 'F' then 'Yes' when o_orderstatus = 'O' then 'No' end",
}

FROM_LINES = {
    "AppointmentID": "l_orderkey * 10 + l_linenumber",
    "Gender": "case when l_linestatus = 'F' then 'F' when l_returnflag <> 'N' then 'M' end",
    "AppointmentDay": "cast(l_shipdate as timestamp)",
    "Age": "case when l_quantity < 50 then cast(l_quantity as int) * 2 - 5 end",
    "Scholarship": "case when l_returnflag = 'R' then 1 else 0 end",
    "Hipertension": "case when l_discount >= 0.08D then 1 else 0 end",
    "Diabetes": "case when l_tax >= 0.08D then null when l_tax >= 0.06D then 1 else 0 end",
    "Alcoholism": "case when l_linenumber = 7 then 1 else 0 end",
    "Handcap": "l_linenumber % 5",
    "SMS_received": "case when l_partkey % 3 = 0 then 1 else 0 end",
}


def raw_appointments(spark: SparkSession, folder: str) -> DataFrame:
    """Raw rows with timestamps.

    Each side is mapped before the join, once per order and once per line. The join
    strategy is left to the optimizer's size estimates, and a hot order key to its
    run-time skew split. The copies come out of the same pass, not of a second join.
    """
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    orders = spark.read.parquet(f"{folder}/orders.parquet")

    def mapped(df, key, expressions):
        return df.select(
            F.col(key).alias("_order"), *[F.expr(sql).alias(n) for n, sql in expressions.items()]
        )

    rows = (
        mapped(lines, "l_orderkey", FROM_LINES)
        .join(mapped(orders, "o_orderkey", FROM_ORDERS), "_order")
        .select(*[name for name, _ in S.RAW_FIELDS])
    )
    times = F.when(F.col("AppointmentID") % 50 == 1, 2).otherwise(1)
    return rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), times))).drop("_copy")


def as_events(raw: DataFrame) -> DataFrame:
    """Raw rows with both days as the text events carry."""
    return raw.withColumns(
        {
            day: F.date_format(day, S.EVENT_TIME_FORMAT)
            for day in ("ScheduledDay", "AppointmentDay")
        }
    )



def scored_rows(rows: DataFrame) -> DataFrame:
    """Add a score computed from the row itself in place of a model's.

    It has many ties and hits both thresholds exactly.
    """
    mixed = F.col("AppointmentID") * 7919 + F.col("days_until_appointment") * 13
    return rows.withColumn("no_show_probability", (mixed % 1000).cast("double") / 1000)


def scored_runs(gold_df: DataFrame) -> DataFrame:
    """Scored training rows as 25 runs: one per neighbourhood and handicap level."""
    kept = ["AppointmentID", "Neighbourhood"]
    position = (F.substring("Neighbourhood", 1, 1).cast("int") - 1) * 5 + F.col("Handcap")
    return scored_rows(features.training_set(gold_df, kept)).select(
        position.alias("seq"),
        F.concat_ws("/", "Neighbourhood", "Handcap").alias("run_name"),
        F.col("Neighbourhood").alias("experiment"),
        F.col(S.LABEL).alias("label"),
        F.col("no_show_probability").alias("p"),
    )
