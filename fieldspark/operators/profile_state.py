"""Profiles of growing tables: a state is kept for each part of a table and merged into a report.

The state of a part and column holds its rows, nulls and extremes, a sketch of its different values and
one of its numbers. Sketches merge, so a report of a table that has grown reads its new parts once, and
otherwise a few kilobytes for each part and column that is already known.
"""

from __future__ import annotations

import time
from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.sources.tables import Warehouse

LAYER = "profile_state"
#: Sizes of the sketches, and the errors that come with them: three standard errors of the number of
#: different values, as a share of it, and the error of a quantile's rank, as a share of the rows.
HLL_BITS, KLL_K = 12, 400
DISTINCT_ERROR, RANK_ERROR = 3 * 1.04 / 2 ** (HLL_BITS / 2), 0.01
_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def column_state(df: DataFrame, part: str, columns: Sequence[str]) -> DataFrame:
    """The state of each part and column, in one grouped pass over the table."""
    kinds = dict(df.dtypes)
    measures, entries = [], []
    for i, c in enumerate(columns):
        value = F.col(c)
        number = F.nanvl(value.cast("double"), F.lit(None).cast("double")) if kinds[c].startswith(_NUMBERS) else F.lit(None).cast("double")
        measures += [
            F.count_if(value.isNull()).alias(f"nulls{i}"), F.min(number).alias(f"least{i}"), F.max(number).alias(f"most{i}"),
            F.hll_sketch_agg(value.cast("string"), HLL_BITS).alias(f"distinct{i}"),
            F.kll_sketch_agg_double(number, KLL_K).alias(f"numbers{i}"),
        ]
        entries.append(F.struct(
            F.lit(c).alias("column_name"), F.col("_rows").alias("row_count"), F.col(f"nulls{i}").alias("null_count"),
            F.col(f"least{i}").alias("least"), F.col(f"most{i}").alias("most"),
            F.col(f"distinct{i}").alias("distinct_sketch"), F.col(f"numbers{i}").alias("number_sketch"),
        ))
    wide = df.groupBy(F.col(part).cast("string").alias("part")).agg(F.count(F.lit(1)).alias("_rows"), *measures)
    return wide.select("part", F.explode(F.array(*entries)).alias("e")).select("part", "e.*")


class ProfileState:
    """The stored state of one table. Parts are values of a column, such as a month or a day of arrival:
    many rows each, and few enough to list."""

    def __init__(self, house: Warehouse, name: str) -> None:
        self._house, self._name = house, name

    def _stored(self) -> DataFrame | None:
        """The latest state of each part and column."""
        if not self._house.exists(LAYER, self._name):
            return None
        log = self._house.read(LAYER, self._name)
        newest = Window.partitionBy("part", "column_name").orderBy(F.desc("added"))
        return log.withColumn("_at", F.row_number().over(newest)).where("_at = 1").drop("_at")

    def parts(self) -> set[str | None]:
        stored = self._stored()
        return set() if stored is None else {r[0] for r in stored.select("part").distinct().collect()}

    def add(self, df: DataFrame, part: str, columns: Sequence[str], changed: Collection[str] = ()) -> int:
        """Take in the parts of a table that aren't known yet, and those that ``changed``; the others are
        not read where ``part`` is a partition column. Returns how many parts were read."""
        known = self.parts() - set(changed)
        text = F.col(part).cast("string")
        named = [p for p in known if p is not None]
        new = df.where(F.coalesce(~text.isin(named), F.lit(None not in known))) if known else df
        state = column_state(new, part, columns).withColumn("added", F.lit(time.time_ns()))
        stored = self._stored()
        whole = state if stored is None else stored.unionByName(state)
        before = len(self.parts())
        self._house.write(LAYER, self._name, whole.coalesce(1))
        return len(self.parts()) - before + len(set(changed) & self.parts())

    def report(self) -> DataFrame:
        """A row for each column: parts, row_count, null_count, least and most; estimates of the different
        values and the quartiles, and the errors they may have."""
        merged = self._stored().groupBy("column_name").agg(
            F.count_distinct(F.coalesce("part", F.lit(""))).alias("parts"), F.sum("row_count").alias("row_count"),
            F.sum("null_count").alias("null_count"), F.min("least").alias("least"), F.max("most").alias("most"),
            F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_values"),
            F.kll_merge_agg_double("number_sketch", KLL_K).alias("_numbers"),
        )
        quartiles = [
            F.when(F.col("least").isNotNull(), F.kll_sketch_get_quantile_double("_numbers", F.lit(p))).alias(name)
            for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
        ]
        return merged.select(
            "column_name", "parts", "row_count", "null_count", "least", "most", "distinct_values", *quartiles,
            F.lit(DISTINCT_ERROR).alias("distinct_error"), F.lit(RANK_ERROR).alias("rank_error"),
        )
