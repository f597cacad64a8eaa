"""Table profiling: nulls, cardinality, distribution, outliers, date ranges.

Every profile is one pass over the columns it needs, or a count per value that combines
before the shuffle. Quantiles are exact: sketches bracket the wanted ranks, counts at the
brackets' ends say where in them the ranks lie, and so on until an end is the quantile. Two
aggregations over all columns together leave about one row in 2,500 in a bracket, so the number
of passes follows from the number of rows, not from the values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.functions.dates import date_shape, mixed_date
from fieldspark.operators.ranks import global_rank

SKETCH_ACCURACY = 10_000
QUARTILES = (0.25, 0.5, 0.75)


def _long_form(one_row: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Turn one wide row (``field__column``) into a row per profiled column."""
    entries = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{f}__{c}").alias(f) for f in fields])
        for c in columns
    ]
    return one_row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows and nulls per column, in a single aggregation."""
    columns = list(columns or df.columns)
    wide = df.agg(
        *[F.count(F.lit(1)).alias(f"row_count__{c}") for c in columns],
        *[F.count_if(F.col(c).isNull()).alias(f"null_count__{c}") for c in columns],
    )
    return _long_form(wide, columns, ["row_count", "null_count"])


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (column, value), values as text, for any number of columns in one shuffle."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    return (
        df.select(F.explode(F.array(*cells)).alias("cell"))
        .groupBy("cell.column_name", "cell.value")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def cardinalities(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Distinct non-null values per column; ``exact=False`` uses sketches and no wide shuffle."""
    if exact:
        return value_counts(df, columns).groupBy("column_name").agg(
            F.count("value").alias("distinct_count")
        )
    wide = df.agg(*[F.approx_count_distinct(c).alias(f"distinct_count__{c}") for c in columns])
    return _long_form(wide, columns, ["distinct_count"])


def top_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All values of the columns with their rows and their rank in the column, the most frequent
    first, ties by value (nulls last). Ranks are made of counts, not of rows, and a column with very
    many values is ranked by many tasks."""
    order = [F.desc("row_count"), F.asc_nulls_last("value")]
    return global_rank(value_counts(df, columns), ["column_name"], order, "value_rank")


def _numbers(df: DataFrame, column: str) -> DataFrame:
    value = F.col(column).cast("double").alias("v")
    return df.select(value).where(F.col("v").isNotNull() & ~F.isnan("v"))


@dataclass
class _Wanted:
    """A quantile under way: its rank among all values, and the open range that holds it, with the
    number of values up to the range and within it."""

    column: int
    rank: int
    below: int
    within: int
    low: float | None = None
    high: float | None = None
    found: float | None = None

    def inside(self) -> Column:
        value = F.col(f"v{self.column}")
        ok = value.isNotNull()
        if self.low is not None:
            ok = ok & (value > F.lit(self.low))
        return ok if self.high is None else ok & (value < F.lit(self.high))

    def bracket(self) -> list[float]:
        """Shares of the range within which a sketch surely has the rank."""
        at, slack = (self.rank - self.below) / self.within, 2 / SKETCH_ACCURACY
        return [max(0.0, at - slack), min(1.0, at + slack)]

    def narrow(self, ends: list[tuple[float, int, int]]) -> None:
        """Take in (value, rows below it, rows up to it) of values of the range."""
        for value, less, upto in ends:
            if less < self.rank <= upto:
                self.found = value
                return
            if upto < self.rank and (self.low is None or value > self.low):
                self.low, self.below = value, upto
        for value, less, _ in reversed(ends):
            if self.rank <= less and (self.high is None or value < self.high):
                self.high, self.within = value, less - self.below


def _placed(numbers: DataFrame, ends: list[tuple[int, float]]) -> list[tuple[int, float, int, int]]:
    """(column, value, rows below it, rows up to it) of each value, in one pass."""
    sums = []
    for k, (i, value) in enumerate(ends):
        sums.append(F.count_if(F.col(f"v{i}") < F.lit(value)).alias(f"less{k}"))
        sums.append(F.count_if(F.col(f"v{i}") <= F.lit(value)).alias(f"upto{k}"))
    ranks = numbers.agg(*sums).first()
    return [(i, value, ranks[f"less{k}"], ranks[f"upto{k}"]) for k, (i, value) in enumerate(ends)]


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float] = QUARTILES
) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns: the smallest values with at least each share of the rows
    up to them; null for a column without numbers. Infinities are values like any other, NaN is not.
    """
    numbers = df.select(*[
        F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"v{i}") for i, c in enumerate(columns)
    ])
    slack = 2 / SKETCH_ACCURACY
    shares = sorted({min(1.0, max(0.0, p + d)) for p in probabilities for d in (-slack, 0, slack)})
    first = numbers.agg(
        *[F.count(f"v{i}").alias(f"n{i}") for i in range(len(columns))],
        *[F.percentile_approx(f"v{i}", shares, SKETCH_ACCURACY).alias(f"s{i}") for i in range(len(columns))],
    ).first()
    counts = [first[f"n{i}"] for i in range(len(columns))]
    wanted = [
        [_Wanted(i, max(1, math.ceil(p * n)), 0, n) if n else None for p in probabilities] for i, n in enumerate(counts)
    ]
    every = [w for per_column in wanted for w in per_column if w]
    ends = {(i, value) for i, n in enumerate(counts) if n for value in first[f"s{i}"]}
    while open_ones := [w for w in every if w.found is None]:
        placed = _placed(numbers, sorted(ends))
        for w in open_ones:
            w.narrow([p[1:] for p in placed if p[0] == w.column])
        open_ones = [w for w in open_ones if w.found is None]
        if open_ones:
            sketches = [
                F.percentile_approx(F.when(w.inside(), F.col(f"v{w.column}")), w.bracket(), SKETCH_ACCURACY) for w in open_ones
            ]
            found = numbers.agg(*[s.alias(f"s{k}") for k, s in enumerate(sketches)]).first()
            ends = {(w.column, value) for w, sketch in zip(open_ones, found) for value in sketch}
    return {c: [w and w.found for w in per_column] for c, per_column in zip(columns, wanted)}


def quantile_values(
    df: DataFrame, column: str, probabilities: Sequence[float] = QUARTILES
) -> list[float | None]:
    """Exact quantiles of one column."""
    return exact_quantiles(df, [column], probabilities)[column]


def quantiles(df: DataFrame, column: str) -> DataFrame:
    """Minimum, quartiles, maximum and mean of a number, one row."""
    q1, median, q3 = (F.lit(q).cast("double") for q in quantile_values(df, column))
    return _numbers(df, column).agg(
        F.min("v").alias("minimum"), q1.alias("q1"), median.alias("median"), q3.alias("q3"),
        F.max("v").alias("maximum"), F.avg("v").alias("mean"),
    )


def fences(q1: float | None, q3: float | None, factor: float = 1.5) -> tuple[float | None, float | None]:
    """Quartile fences: values outside them count as outliers."""
    if q1 is None or q3 is None:
        return None, None
    spread = 0.0 if q1 == q3 else q3 - q1  # equal infinities have no spread
    return q1 - factor * spread, q3 + factor * spread


def iqr_fences(df: DataFrame, column: str, factor: float = 1.5) -> tuple[float | None, float | None]:
    """The quartile fences of a number."""
    return fences(*quantile_values(df, column, (0.25, 0.75)), factor)


def is_outlier(df: DataFrame, column: str, factor: float = 1.5) -> Column:
    """Whether a value lies outside the quartile fences of its column."""
    low, high = iqr_fences(df, column, factor)
    return (F.col(column) < F.lit(low)) | (F.col(column) > F.lit(high))


def outliers(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """The rows whose value lies outside the quartile fences."""
    return df.where(is_outlier(df, column, factor))


def date_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Range and format mix of raw date columns, a row for each, in one pass."""
    shapes = ("iso", "day_first", "blank", "other")
    checked = df.select(*[
        c for i, raw in enumerate(columns)
        for c in (mixed_date(F.col(raw)).alias(f"d{i}"), date_shape(F.col(raw)).alias(f"s{i}"))
    ])
    wide = checked.agg(*[
        a for i, c in enumerate(columns)
        for a in (
            F.min(f"d{i}").alias(f"first_date__{c}"), F.max(f"d{i}").alias(f"last_date__{c}"),
            *[F.count_if(F.col(f"s{i}") == s).alias(f"{s}_rows__{c}") for s in shapes],
        )
    ])
    return _long_form(wide, columns, ["first_date", "last_date", *[f"{s}_rows" for s in shapes]])


def inverted_intervals(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """The rows whose interval ends before it starts."""
    return df.where(start > end)
