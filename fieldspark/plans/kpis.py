"""KPI tables for the portfolio and operations reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.functions.dates import STATE_ACTIVE, AsOf, effective_state
from fieldspark.functions.metrics import DONE_STATUSES, INCIDENT, VISIT_STATUSES, rate
from fieldspark.operators.assignment import primary_assignment


def _pooled():
    """Totals over campaigns. Rates are pooled (sum over sum), not averaged."""
    return [
        F.count(F.lit(1)).alias("campaigns"),
        F.sum("total_visits").alias("total_visits"),
        F.sum("completed_visits").alias("completed_visits"),
        F.sum(F.col("total_visits") - F.col("completed_visits")).alias("pending_visits"),
        rate(F.sum("completed_visits"), F.sum("total_visits")).alias("completion_rate"),
    ]


def with_effective_state(performance: DataFrame, as_of: AsOf = None) -> DataFrame:
    state = effective_state(F.col("campaign_state"), F.col("campaign_end_date"), as_of)
    return performance.withColumn("effective_state", state)


def active_only(performance: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The report's filter on active campaigns, by effective state."""
    return with_effective_state(performance, as_of).where(F.col("effective_state") == STATE_ACTIVE)


def portfolio_totals(performance: DataFrame) -> DataFrame:
    """Campaigns, visits, pending visits and completion over the whole portfolio, one row."""
    return performance.agg(*_pooled())


def state_totals(performance: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Totals per effective state, with how many campaigns had a blank state."""
    blank = F.count_if(F.col("campaign_state").isNull()).alias("blank_states")
    return with_effective_state(performance, as_of).groupBy("effective_state").agg(*_pooled(), blank)


def active_campaigns(performance: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Completion of each active campaign."""
    return active_only(performance, as_of).select(
        "campaign_id", "campaign_name",
        F.trunc("campaign_start_date", "month").alias("start_month"),
        "total_visits", "completed_visits", "completion_rate",
    )


def active_by_start_month(performance: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Pooled completion of active campaigns per start month."""
    month = F.trunc("campaign_start_date", "month").alias("start_month")
    return active_only(performance, as_of).groupBy(month).agg(*_pooled())


def portfolio_rollup(performance: DataFrame) -> DataFrame:
    """Totals per client and project, per client, and overall (``level`` 0, 1 and 2)."""
    level = (F.grouping("client_id") + F.grouping("project_id")).cast("int").alias("level")
    return (
        performance.rollup("client_id", "project_id")
        .agg(level, *_pooled())
        .select("level", "client_id", "project_id", "campaigns", "total_visits",
                "completed_visits", "pending_visits", "completion_rate")
    )


def active_workers(workers: DataFrame) -> DataFrame:
    """Workers and active workers, one row."""
    return workers.agg(
        F.count("employee_id").alias("workers"),
        F.count(F.when(F.col("employee_active_status"), F.col("employee_id"))).alias("active_workers"),
    )


def worker_status(visits: DataFrame, bridge: DataFrame, workers: DataFrame) -> DataFrame:
    """Visits by status for the primary worker of each visit's route. The row without a
    worker holds the unassigned visits. Visits are counted per route before any join."""
    status = F.col("visit_status")
    known = [F.count_if(status == s).alias(f"{s.lower()}_visits") for s in VISIT_STATUSES]
    other = F.count_if(status.isNull() | ~status.isin(*VISIT_STATUSES)).alias("other_visits")
    per_route = visits.groupBy("route_id").agg(F.count(F.lit(1)).alias("visits"), *known, other)
    measures = [c for c in per_route.columns if c != "route_id"]
    primary = primary_assignment(bridge).select(F.col("route_id").alias("worker_route"), "employee_id")
    per_worker = (
        per_route.join(primary, F.col("route_id") == F.col("worker_route"), "left")
        .groupBy("employee_id")
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
    names = workers.select(
        F.col("employee_id").alias("worker_key"), F.col("employee_first_name").alias("employee_name")
    )
    return per_worker.join(names, F.col("employee_id") == F.col("worker_key"), "left").select(
        "employee_id", "employee_name", *measures
    )


def of_worker(status: DataFrame, name: str) -> DataFrame:
    """The report's worker selection, by name."""
    return status.where(F.col("employee_name") == name)


def unassigned_visits(status: DataFrame) -> DataFrame:
    """Visits without a worker and their share, one row; takes ``worker_status`` rows."""
    unassigned = F.sum(F.when(F.col("employee_id").isNull(), F.col("visits")).otherwise(0))
    total = F.sum("visits")
    return status.agg(
        total.alias("total_visits"),
        unassigned.alias("unassigned_visits"),
        rate(unassigned, total).alias("unassigned_share"),
    )


def worker_load(status: DataFrame) -> DataFrame:
    """Load, completion and incidence share per assigned worker; takes ``worker_status`` rows."""
    done = sum((F.col(f"{s.lower()}_visits") for s in DONE_STATUSES[1:]), F.col("ok_visits"))
    incidents = F.col(f"{INCIDENT.lower()}_visits")
    return (
        status.where(F.col("employee_id").isNotNull())
        .select(
            "employee_id", "employee_name", "visits",
            done.alias("completed_visits"),
            incidents.alias("incid_visits"),
            rate(done, F.col("visits")).alias("completion_rate"),
            rate(incidents, F.col("visits")).alias("incidence_rate"),
        )
    )
