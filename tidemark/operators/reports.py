"""Counts, shares and previews."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def row_total(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def counts_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("count"))


def shares_by(df: DataFrame, column: str) -> DataFrame:
    """Counts with their percentage of all rows.

    The total is a sum over the counts (one row per class), not a second scan.
    """
    total = F.sum("count").over(Window.partitionBy())
    return counts_by(df, column).withColumn(
        "percentage", F.round(F.col("count") / total * 100, 2)
    )


def preview(df: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """First ``n`` rows in key order, the same ones every time.

    Each task keeps its own first ``n``; only those meet. ``keys`` are followed by the
    remaining columns, so equal keys leave nothing to chance.
    """
    return df.orderBy(*keys, *[c for c in df.columns if c not in keys]).limit(n)


def layer_counts(spark: SparkSession, layers: dict[str, str]) -> DataFrame:
    """Rows per written layer, read back from the parquet footers."""
    counts = [
        spark.read.parquet(path).agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("layer"), "rows"
        )
        for name, path in layers.items()
    ]
    table = counts[0]
    for count in counts[1:]:
        table = table.unionByName(count)
    return table


def schema_report(df: DataFrame) -> DataFrame:
    """The schema as rows."""
    fields = [
        (i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)
    ]
    return df.sparkSession.createDataFrame(
        fields, "ordinal int, name string, type string, nullable boolean"
    )


def column_report(df: DataFrame) -> DataFrame:
    """The schema as rows, with each column's rows and missing values from one aggregate."""
    columns = [F.col(f"`{name}`") for name in df.columns]
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.array(*[F.count_if(c.isNull()) for c in columns]).alias("missing"),
    )
    return (
        schema_report(df)
        .crossJoin(F.broadcast(counted))  # a single row
        .withColumn("missing", F.get("missing", F.col("ordinal")))
    )
