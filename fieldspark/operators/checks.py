"""Declarative data checks.

Every check yields one result row with its number of failures. All checks of one model that
look at single rows share one aggregation, hence one scan; the others are one-row DataFrames.
A run is the union of these, so Spark executes the checks of a layer as one job. Child keys
and repeated values are counted per value before any shuffle or join, so a hot key costs
one row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.operators.profile import is_outlier

ERROR, WARN = "error", "warn"


@dataclass(frozen=True, kw_only=True)
class Check:
    """A rule on one column of one model."""

    model: str
    column: str
    severity: str = ERROR

    name = "check"

    def failing_values(self, tables: Mapping[str, DataFrame]) -> DataFrame | None:
        """The failing values as text, ``key``, each with its ``row_count``; None for rules about a
        whole column."""
        return None


def _counted(values: DataFrame, key: Column) -> DataFrame:
    return values.groupBy(key.cast("string").alias("key")).agg(F.count(F.lit(1)).alias("row_count"))


class RowCheck(Check):
    """A rule that an aggregate over the model's rows can count."""

    def failing(self, table: DataFrame) -> Column:
        """The number of failures, as an aggregate."""
        raise NotImplementedError


class TableCheck(Check):
    """A rule that needs grouping or other tables."""

    def failures(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """One row with the number of ``failures``."""
        raise NotImplementedError


@dataclass(frozen=True, kw_only=True)
class NotNull(RowCheck):
    name = "not_null"

    def failing(self, table):
        return F.count_if(F.col(self.column).isNull())

    def failing_values(self, tables):
        missing = F.col(self.column).isNull()
        return _counted(tables[self.model].where(missing), F.lit(None))


@dataclass(frozen=True, kw_only=True)
class Unique(TableCheck):
    """Counts the non-null values that occur more than once."""

    name = "unique"

    def failures(self, tables):
        counts = tables[self.model].groupBy(self.column).agg(F.count(F.lit(1)).alias("n"))
        repeated = F.col(self.column).isNotNull() & (F.col("n") > 1)
        return counts.agg(F.count_if(repeated).alias("failures"))

    def failing_values(self, tables):
        present = tables[self.model].where(F.col(self.column).isNotNull())
        return _counted(present, F.col(self.column)).where("row_count > 1")


@dataclass(frozen=True, kw_only=True)
class Relationships(TableCheck):
    """Counts the child rows whose non-null key has no parent row."""

    parent: str
    parent_column: str

    name = "relationships"

    def _orphans(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """Keys without a parent, each with its rows, counted before the join."""
        child = (
            tables[self.model]
            .where(F.col(self.column).isNotNull())
            .groupBy(F.col(self.column).alias("_child"))
            .agg(F.count(F.lit(1)).alias("n"))
        )
        parent = tables[self.parent].select(F.col(self.parent_column).alias("_parent"))
        return child.join(parent, F.col("_child") == F.col("_parent"), "left_anti")

    def failures(self, tables):
        return self._orphans(tables).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))

    def failing_values(self, tables):
        return self._orphans(tables).select(F.col("_child").cast("string").alias("key"), F.col("n").alias("row_count"))


@dataclass(frozen=True, kw_only=True)
class AcceptedValues(TableCheck):
    """Counts the distinct non-null values outside a list."""

    values: Sequence[str]

    name = "accepted_values"

    def failures(self, tables):
        seen = tables[self.model].select(self.column).distinct()
        return seen.agg(F.count_if(~F.col(self.column).isin(*self.values)).alias("failures"))

    def failing_values(self, tables):
        return _counted(tables[self.model].where(~F.col(self.column).isin(*self.values)), F.col(self.column))


@dataclass(frozen=True, kw_only=True)
class MaxInvalidShare(RowCheck):
    """Fails (with the number of false flags) when too many rows have a false flag."""

    max_share: float

    name = "max_invalid_share"

    def failing(self, table):
        invalid = F.count_if(~F.col(self.column))
        too_many = invalid > F.lit(self.max_share) * F.count(F.lit(1))
        return F.when(too_many, invalid).otherwise(0)


@dataclass(frozen=True, kw_only=True)
class OrderedDates(RowCheck):
    """Counts the rows whose interval ends before it starts."""

    end_column: str

    name = "ordered_dates"

    def failing(self, table):
        return F.count_if(F.col(self.column) > F.col(self.end_column))

    def failing_values(self, tables):
        inverted = tables[self.model].where(F.col(self.column) > F.col(self.end_column))
        return _counted(inverted, F.concat_ws(" > ", self.column, self.end_column))


@dataclass(frozen=True, kw_only=True)
class NoOutliers(RowCheck):
    """Counts the values outside the quartile fences."""

    name = "no_outliers"

    def failing(self, table):
        return F.count_if(is_outlier(table, self.column))

    def failing_values(self, tables):
        table = tables[self.model]
        return _counted(table.where(is_outlier(table, self.column)), F.col(self.column))


def _described(check: Check, failures: Column) -> Column:
    failures = failures.cast("bigint")
    return F.struct(
        F.lit(check.name).alias("check_name"),
        F.lit(check.model).alias("model"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.severity).alias("severity"),
        failures.alias("failures"),
        F.when(failures > 0, check.severity).otherwise("pass").alias("outcome"),
    )


def _row_checks(table: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    counts = table.agg(*[c.failing(table).alias(f"n{i}") for i, c in enumerate(checks)])
    results = F.array(*[_described(c, F.col(f"n{i}")) for i, c in enumerate(checks)])
    return counts.select(F.explode(results).alias("result")).select("result.*")


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """One row per check: name, model, column, severity, failures and outcome."""
    by_model: dict[str, list[RowCheck]] = {}
    parts: list[DataFrame] = []
    for check in checks:
        if isinstance(check, RowCheck):
            by_model.setdefault(check.model, []).append(check)
        else:
            failures = check.failures(tables)
            result = failures.select(_described(check, F.col("failures")).alias("result"))
            parts.append(result.select("result.*"))
    parts += [_row_checks(tables[model], group) for model, group in by_model.items()]
    return reduce(DataFrame.unionByName, parts)


def failing_rows(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame | None:
    """What fails, not only how often: a row (check_name, model, column_name, key, row_count) for each
    value of a column that fails a check. Values are counted before they are joined or moved."""
    parts = []
    for check in checks:
        values = check.failing_values(tables)
        if values is not None:
            named = [F.lit(v).alias(n) for n, v in (("check_name", check.name), ("model", check.model), ("column_name", check.column))]
            parts.append(values.select(*named, "key", "row_count"))
    return reduce(DataFrame.unionByName, parts) if parts else None


class ChecksFailed(Exception):
    """Raised when a check of error severity has failures."""


def enforce(results: DataFrame) -> None:
    """Raise when an error-severity check failed; warnings do not block."""
    failed = results.where(F.col("outcome") == ERROR).collect()  # one row per declared check
    if failed:
        lines = [f"{r.check_name} {r.model}.{r.column_name}: {r.failures}" for r in failed]
        raise ChecksFailed("; ".join(lines))
