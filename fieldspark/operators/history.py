"""Results of checks over time: every run is kept, and held against the run before."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_CHECK = ("check_name", "model", "column_name")


def of_run(results: DataFrame, run_id: str, ran_at: str) -> DataFrame:
    """Check results as rows of the history. ``ran_at`` is a timestamp, which orders the runs."""
    return results.select(F.lit(run_id).alias("run_id"), F.lit(ran_at).cast("timestamp_ntz").alias("ran_at"), *results.columns)


def changes(history: DataFrame) -> DataFrame:
    """Every result with the failures of the same check in the run before, the change since, and what
    became of the check: ``first``, ``same``, ``better``, ``worse``, ``broken`` (it passed before) or
    ``fixed``. A run that was recorded twice counts once. There are as many rows as checks and runs,
    so a window for each check is small.
    """
    once = history.dropDuplicates(["run_id", *_CHECK])
    before = F.lag("failures").over(Window.partitionBy(*_CHECK).orderBy("ran_at", "run_id"))
    change = F.col("failures") - F.col("failures_before")
    trend = (
        F.when(F.col("failures_before").isNull(), "first")
        .when(change == 0, "same")
        .when(F.col("failures_before") == 0, "broken")
        .when(F.col("failures") == 0, "fixed")
        .when(change > 0, "worse").otherwise("better")
    )
    return once.withColumn("failures_before", before).withColumn("change", change).withColumn("trend", trend)


def alerts(history: DataFrame, least_growth: float = 0.0) -> DataFrame:
    """The checks of the latest run that broke, or whose failures grew by more than a share of those before."""
    latest = history.agg(F.max(F.struct("ran_at", "run_id")).alias("last")).select("last.run_id")
    now = changes(history).join(F.broadcast(latest), "run_id")  # one row
    return now.where((F.col("trend") == "broken") | (F.col("change") > F.col("failures_before") * least_growth))
