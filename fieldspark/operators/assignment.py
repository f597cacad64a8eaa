"""Worker assignments per route."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_assignments(bridge: DataFrame) -> DataFrame:
    """One row per (route_id, employee_id): number of bridge rows, and whether any is main
    (true over false over unknown). Repeats collapse before the shuffle."""
    return bridge.groupBy("route_id", "employee_id").agg(
        F.count(F.lit(1)).alias("assignments"), F.bool_or("main_employee").alias("main_employee")
    )


def primary_assignment(bridge: DataFrame) -> DataFrame:
    """One row per route: its first assignment, main ones first, then the lowest employee
    id (missing ids last), and the number of all its assignments.

    This is ``row_number() = 1`` and ``count(*)`` over the route, written as aggregates:
    both combine before the shuffle, where a window would sort a whole hot route in one task.
    """
    main, employee = F.col("main_employee"), F.col("employee_id")
    priority = F.struct(
        F.when(main, 0).otherwise(1).alias("rank"),
        employee.isNull().alias("no_id"),
        employee,
        main.isNull().alias("no_main"),
        main,
    )
    return (
        distinct_assignments(bridge)
        .groupBy("route_id")
        .agg(F.min(priority).alias("first"), F.sum("assignments").alias("workers_assigned_count"))
        .select(
            "route_id",
            F.col("first.employee_id").alias("employee_id"),
            F.col("first.main_employee").alias("main_employee"),
            "workers_assigned_count",
        )
    )
