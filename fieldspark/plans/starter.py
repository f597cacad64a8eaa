"""The two starter tables: literal rows, and a filter on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def first(spark: SparkSession, keep_null_ids: bool = True) -> DataFrame:
    """Ids 1 and null, or only 1."""
    one = spark.range(1).select(F.lit(1).alias("id"))
    missing = spark.range(1).select(F.lit(None).cast("int").alias("id"))
    rows = one.unionByName(missing)
    return rows if keep_null_ids else rows.where(F.col("id").isNotNull())


def second(first_rows: DataFrame) -> DataFrame:
    return first_rows.where(F.col("id") == 1)
