"""Exact quantiles of a number within groups, for all groups in the same few jobs.

A first grouped pass counts each group and sketches the neighbourhood of every wanted rank: two values
that surely have the rank between them. A second one counts, for each such bracket, the rows below and
inside it; brackets that still hold too many different values are sketched again within themselves. The
values left inside brackets are counted, and the value at the rank is the quantile. Rows are only
sketched and counted where they lie, so a group with a third of all rows costs no task more than its
share; what is shuffled is a row a group and task, and in the end some thousandths of the values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.operators.lookup import lookup
from fieldspark.operators.profile import QUARTILES, SKETCH_ACCURACY
from fieldspark.sources.tables import written

#: Different values inside a bracket that are ranked; brackets with more are narrowed further.
RANKED_VALUES = 1_000_000

#: Shares at which a bracket is sketched again, as the share asked for differs from group to group.
_GRID = [i / 500 for i in range(501)]

_GROUP, _VALUE = "_group", "_value"


def _inside(k: int) -> Column:
    return (F.col(_VALUE) >= F.col(f"low{k}")) & (F.col(_VALUE) <= F.col(f"high{k}"))


def group_quantiles(
    df: DataFrame, group: str, column: str, names: Sequence[str] = ("q1", "median", "q3"), probabilities: Sequence[float] = QUARTILES
) -> DataFrame:
    """A row for each value of ``group`` (null is one): ``group``, ``n`` and under ``names`` the smallest
    values with at least each share of the group's numbers up to them. Nulls and NaN are no numbers; a group without
    numbers has null quantiles. ``df`` is read several times, so it should be a table."""
    number = F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))
    rows = df.select(F.struct(F.col(group).alias("g")).alias(_GROUP), number.alias(_VALUE))
    numbers = rows.where(F.col(_VALUE).isNotNull())
    ks = range(len(probabilities))
    size = F.count(_VALUE)
    first = rows.groupBy(_GROUP).agg(size.alias("n"), F.percentile_approx(_VALUE, _around(probabilities), SKETCH_ACCURACY).alias("s"))
    brackets = first.select(
        F.col(_GROUP), "n",
        *[F.greatest(F.ceil(F.col("n") * p), F.lit(1)).alias(f"rank{k}") for k, p in enumerate(probabilities)],
        *[F.get("s", F.lit(2 * k)).alias(f"low{k}") for k in ks], *[F.get("s", F.lit(2 * k + 1)).alias(f"high{k}") for k in ks],
    )
    before = math.inf
    while True:
        brackets = written(brackets)
        joined = _with_brackets(numbers, brackets, ks)
        counts = joined.groupBy(_GROUP).agg(
            *[F.count_if(F.col(_VALUE) < F.col(f"low{k}")).alias(f"below{k}") for k in ks],
            *[F.count_if(_inside(k)).alias(f"inside{k}") for k in ks],
            *[F.approx_count_distinct(F.when(_inside(k), F.col(_VALUE))).alias(f"values{k}") for k in ks],
        )
        placed = written(brackets.join(counts.withColumnRenamed(_GROUP, "_counted"), F.col(_GROUP) == F.col("_counted"), "left").drop("_counted"))
        missed = [~(F.col(f"rank{k}") > F.col(f"below{k}")) | ~(F.col(f"rank{k}") <= F.col(f"below{k}") + F.col(f"inside{k}")) for k in ks]
        wide = [F.col(f"values{k}") > RANKED_VALUES for k in ks]
        state = placed.agg(
            F.coalesce(F.sum(F.expr(" + ".join(f"values{k}" for k in ks))), F.lit(0)).alias("values"),
            F.count_if(_any(missed)).alias("missed"), F.count_if(_any(wide)).alias("wide"),
        ).first()
        if not state["missed"] and (not state["wide"] or state["values"] >= before):
            break  # nothing left to narrow, or narrowing no longer helps
        before = state["values"] if not state["missed"] else math.inf
        brackets = _narrowed(numbers, placed, ks, missed, wide)
    return _picked(numbers, placed, group, names, ks)


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions])


def _around(probabilities: Sequence[float]) -> list[float]:
    slack = 2 / SKETCH_ACCURACY
    return [min(1.0, max(0.0, p + d)) for p in probabilities for d in (-slack, slack)]


def _with_brackets(numbers: DataFrame, brackets: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Rows with the brackets of their group; hot groups are dealt over tasks where brackets are too many to broadcast."""
    sides = brackets.select(F.col(_GROUP).alias("_of"), *[f"{c}{k}" for k in ks for c in ("low", "high")])
    return lookup(numbers, sides, _GROUP, "_of", hot_from=numbers, spread_by=[_VALUE])


def _narrowed(numbers: DataFrame, placed: DataFrame, ks: Sequence[int], missed: list[Column], wide: list[Column]) -> DataFrame:
    """Brackets sketched again within themselves where they hold too many rows; where a sketch missed the
    rank, the bracket is opened on both sides first."""
    low = [F.when(missed[k], F.lit(float("-inf"))).otherwise(F.col(f"low{k}")) for k in ks]
    high = [F.when(missed[k], F.lit(float("inf"))).otherwise(F.col(f"high{k}")) for k in ks]
    below = [F.when(missed[k], 0).otherwise(F.col(f"below{k}")) for k in ks]
    inside = [F.when(missed[k], F.col("n")).otherwise(F.col(f"inside{k}")) for k in ks]
    at = [F.when(missed[k] | wide[k], (F.col(f"rank{k}") - below[k]) / inside[k]) for k in ks]
    opened = written(placed.select(
        _GROUP, "n", *[f"rank{k}" for k in ks],
        *[c for k in ks for c in (low[k].alias(f"low{k}"), high[k].alias(f"high{k}"), at[k].alias(f"at{k}"))],
    ))
    joined = _with_brackets(numbers, opened, ks)
    grids = joined.groupBy(F.col(_GROUP).alias("_of")).agg(
        *[F.percentile_approx(F.when(_inside(k), F.col(_VALUE)), _GRID, SKETCH_ACCURACY).alias(f"grid{k}") for k in ks]
    )
    both = opened.join(grids, F.col(_GROUP) == F.col("_of"), "left")
    steps, slack = len(_GRID) - 1, 2.0 / SKETCH_ACCURACY
    lows = [F.get(f"grid{k}", F.greatest(F.floor((F.col(f"at{k}") - slack) * steps), F.lit(0)).cast("int")) for k in ks]
    highs = [F.get(f"grid{k}", F.least(F.ceil((F.col(f"at{k}") + slack) * steps), F.lit(steps)).cast("int")) for k in ks]
    return both.select(
        _GROUP, "n", *[f"rank{k}" for k in ks],
        *[F.when(F.col(f"at{k}").isNull(), F.col(f"low{k}")).otherwise(lows[k]).alias(f"low{k}") for k in ks],
        *[F.when(F.col(f"at{k}").isNull(), F.col(f"high{k}")).otherwise(highs[k]).alias(f"high{k}") for k in ks],
    )


def _picked(numbers: DataFrame, placed: DataFrame, group: str, names: Sequence[str], ks: Sequence[int]) -> DataFrame:
    """The value at each rank, from the rows inside the brackets, counted by value."""
    joined = _with_brackets(numbers, placed, ks)
    cells = F.array(*[F.when(_inside(k), F.lit(k)) for k in ks])
    counted = (
        joined.select(_GROUP, _VALUE, F.explode(F.array_compact(cells)).alias("k"))
        .groupBy(_GROUP, "k", _VALUE).agg(F.count(F.lit(1)).alias("rows"))
    )
    upto = F.sum("rows").over(Window.partitionBy(_GROUP, "k").orderBy(_VALUE))
    ranks = placed.select(
        F.col(_GROUP).alias("_of"),
        F.explode(F.array(*[
            F.struct(F.lit(k).alias("k"), F.col(f"rank{k}").alias("rank"), F.col(f"below{k}").alias("below")) for k in ks
        ])).alias("w"),
    ).select("_of", F.col("w.k").alias("_k"), "w.rank", "w.below")
    summed = counted.withColumn("upto", upto)
    found = summed.join(ranks, (F.col(_GROUP) == F.col("_of")) & (F.col("k") == F.col("_k")))
    reached = found.where(F.col("below") + F.col("upto") >= F.col("rank"))
    values = reached.groupBy(F.col("_of").alias("_found")).agg(*[F.min(F.when(F.col("k") == k, F.col(_VALUE))).alias(names[k]) for k in ks])
    whole = placed.select(_GROUP, "n").join(values, F.col(_GROUP) == F.col("_found"), "left")
    return whole.select(F.col(f"{_GROUP}.g").alias(group), "n", *names)


def group_outliers(df: DataFrame, group: str, column: str, factor: float = 1.5) -> DataFrame:
    """The rows whose number lies outside the quartile fences of its group."""
    quartiles = written(group_quantiles(df, group, column, ("_q1", "_q3"), (0.25, 0.75)))
    spread = F.when(F.col("_q1") == F.col("_q3"), 0.0).otherwise(F.col("_q3") - F.col("_q1"))  # equal infinities have no spread
    fences = quartiles.select(
        F.struct(F.col(group).alias("g")).alias("_of"),
        (F.col("_q1") - factor * spread).alias("_low"), (F.col("_q3") + factor * spread).alias("_high"),
    )
    keyed = df.withColumn(_GROUP, F.struct(F.col(group).alias("g")))
    joined = lookup(keyed, fences, _GROUP, "_of", hot_from=keyed.select(_GROUP), spread_by=[column])
    number = F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))
    return joined.where((number < F.col("_low")) | (number > F.col("_high"))).select(df.columns)
