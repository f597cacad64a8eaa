"""The checks declared on staging tables and marts, and the quality report."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.functions.dates import CAMPAIGN_STATES
from fieldspark.functions.metrics import QUESTION_TYPES, VISIT_STATUSES
from fieldspark.operators.checks import (
    WARN, AcceptedValues, Check, MaxInvalidShare, NoOutliers, NotNull, OrderedDates, Relationships, Unique,
    run_checks,
)
from fieldspark.operators.profile import QUARTILES, cardinalities, exact_quantiles, fences, null_counts, value_counts
from fieldspark.plans.entities import ENTITIES, Entity


def staging_model(name: str) -> str:
    return f"stg_{name}"


def mart_model(name: str) -> str:
    return f"mart_{name}"


def _entity_checks(entity: Entity) -> Iterable[Check]:
    model = staging_model(entity.name)
    yield NotNull(model=model, column=entity.key)
    yield Unique(model=model, column=entity.key)
    for ref in entity.references:
        if ref.required:
            yield NotNull(model=model, column=ref.fk)
        yield Relationships(
            model=model, column=ref.fk, parent=staging_model(ref.parent),
            parent_column=ENTITIES[ref.parent].key, severity=ref.check_severity,
        )


def _key_checks(model: str, column: str, parent: str) -> list[Check]:
    return [
        NotNull(model=model, column=column),
        Unique(model=model, column=column),
        Relationships(model=model, column=column, parent=staging_model(parent), parent_column=column),
    ]


STAGING_CHECKS: list[Check] = [c for e in ENTITIES.values() for c in _entity_checks(e)]

MART_CHECKS: list[Check] = [
    *_key_checks(mart_model("campaign_performance"), "campaign_id", "campaigns"),
    *_key_checks(mart_model("visit_responses"), "answer_id", "responses"),
    NotNull(model=mart_model("visit_responses"), column="visit_id"),
    Relationships(
        model=mart_model("visit_responses"), column="visit_id",
        parent=staging_model("visits"), parent_column="visit_id",
    ),
    Relationships(
        model=mart_model("visit_responses"), column="question_id",
        parent=staging_model("questions"), parent_column="question_id",
    ),
]

# Checks the reports need beyond the keys; they warn only. The unique codes keep lookups
# by code from repeating rows.
DOMAIN_CHECKS: list[Check] = [
    AcceptedValues(model="stg_visits", column="visit_status", values=VISIT_STATUSES, severity=WARN),
    AcceptedValues(model="stg_questions", column="question_type", values=QUESTION_TYPES, severity=WARN),
    AcceptedValues(model="stg_campaigns", column="campaign_state", values=CAMPAIGN_STATES, severity=WARN),
    Unique(model="stg_projects", column="project_code", severity=WARN),
    Unique(model="stg_clients", column="client_code", severity=WARN),
    OrderedDates(
        model="stg_campaigns", column="campaign_start_date", end_column="campaign_end_date", severity=WARN
    ),
    OrderedDates(model="stg_routes", column="route_start_date", end_column="route_end_date", severity=WARN),
]


def share_checks(max_share: float) -> list[Check]:
    """A threshold on invalid references for every reference flag."""
    return [
        MaxInvalidShare(
            model=staging_model(e.name), column=ref.flag, max_share=max_share, severity=WARN
        )
        for e in ENTITIES.values()
        for ref in e.references
    ]


# Numbers whose extremes deserve a look.
OUTLIER_CHECKS: list[Check] = [
    NoOutliers(model="stg_campaigns", column="visit_duration_minutes", severity=WARN),
    NoOutliers(model="stg_route_employee", column="ip_percentage", severity=WARN),
]


def _measures(cells: dict[str, dict[str, Column]], one_row: DataFrame) -> DataFrame:
    """(column_name, measure, value) from one row, without the missing ones."""
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.lit(m).alias("measure"), value.cast("double").alias("value"))
        for c, measures in cells.items() for m, value in measures.items()
    ]
    return one_row.select(F.explode(F.array(*entries)).alias("e")).select("e.*").where("value IS NOT NULL")


def profile_model(df: DataFrame, exact: bool = False) -> DataFrame:
    """(column_name, measure, value) of every column: ``rows``, ``nulls`` and ``distinct_values``; of numbers
    ``minimum``, ``q1``, ``median``, ``q3``, ``maximum`` and ``outliers``; of dates ``first_date`` and
    ``last_date``, in days since 1970. With ``exact`` distinct values are counted, and ``top_rows`` gives
    the rows of the most frequent one; otherwise they are estimated by sketches. Quantiles are exact."""
    kinds = dict(df.dtypes)
    numbers = [c for c, k in kinds.items() if k in ("int", "bigint", "float", "double")]
    dates = [c for c, k in kinds.items() if k == "date"]
    quartiles = exact_quantiles(df, numbers) if numbers else {}
    outside = {
        c: F.count_if((F.col(c).cast("double") < F.lit(low)) | (F.col(c).cast("double") > F.lit(high)))
        for c in numbers for low, high in [fences(quartiles[c][0], quartiles[c][-1])] if low is not None
    }
    days = lambda c: F.datediff(F.col(c), F.lit("1970-01-01").cast("date"))
    wide = df.agg(
        *[F.min(c).alias(f"least__{c}") for c in numbers], *[F.max(c).alias(f"most__{c}") for c in numbers],
        *[n.alias(f"outliers__{c}") for c, n in outside.items()],
        *[F.min(days(c)).alias(f"least__{c}") for c in dates], *[F.max(days(c)).alias(f"most__{c}") for c in dates],
        F.count(F.lit(1)).alias("all_rows"),
    )
    cells: dict[str, dict[str, Column]] = {}
    for c in numbers:
        cells[c] = {"minimum": F.col(f"least__{c}"), "maximum": F.col(f"most__{c}")}
        cells[c] |= {m: F.lit(q) for m, q in zip(("q1", "median", "q3"), quartiles[c]) if q is not None}
        if c in outside:
            cells[c]["outliers"] = F.col(f"outliers__{c}")
    cells |= {c: {"first_date": F.col(f"least__{c}"), "last_date": F.col(f"most__{c}")} for c in dates}
    if exact:
        # Values are told apart by their text; zeros of both signs are one value.
        zeros = {c: F.col(c) + F.lit(0).cast(k) for c, k in kinds.items() if k in ("float", "double")}
        per_value = value_counts(df.withColumns(zeros) if zeros else df, df.columns).groupBy("column_name")
        distinct = per_value.agg(
            F.count("value").alias("distinct_count"), F.max(F.when(F.col("value").isNotNull(), F.col("row_count"))).alias("top_rows")
        )
    else:
        distinct = cardinalities(df, df.columns, exact=False).withColumn("top_rows", F.lit(None).cast("bigint"))
    counts = null_counts(df).join(distinct, "column_name", "left").select(
        "column_name",
        F.explode(F.create_map(
            F.lit("rows"), F.col("row_count"), F.lit("nulls"), F.col("null_count"),
            F.lit("distinct_values"), F.coalesce("distinct_count", F.lit(0)), F.lit("top_rows"), F.col("top_rows"),
        )).alias("measure", "value"),
    )
    counts = counts.where("value IS NOT NULL").withColumn("value", F.col("value").cast("double"))
    return counts.unionByName(_measures(cells, wide)) if cells else counts


def quality_report(
    tables: Mapping[str, DataFrame], checks: Iterable[Check], exact: bool = False
) -> DataFrame:
    """One long table ``(model, column_name, measure, value)``: the failures of each check, and the
    profile of every column of every model."""
    found = run_checks(tables, checks).select(
        "model", "column_name",
        F.concat(F.lit("failures_"), F.col("check_name")).alias("measure"),
        F.col("failures").cast("double").alias("value"),
    )
    profiles = [
        profile_model(df, exact).select(F.lit(model).alias("model"), "column_name", "measure", "value")
        for model, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, [found, *profiles])
