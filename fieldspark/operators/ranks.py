"""Ranks of all rows of a group without bringing the group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.sources.tables import written

_AT, _PART, _BASE = "_at", "_part", "_rank_base"
#: Bits of ``monotonically_increasing_id`` that number the rows of a partition.
_ROW_BITS = 33


def global_rank(df: DataFrame, groups: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """The rows with their row number in their group, from 1 on, in the given order.

    Rows are sorted over ranges of (groups, order), so a group of any size is dealt over as many
    tasks as its share of the rows asks for, and numbered by their place in the range. A row's rank is
    that number and the rows of its group in the ranges before. ``groups`` must be few (columns or
    models, not keys): the driver gets a row for each group and for each range. The sorted rows are
    written, as ranges are drawn from samples and must be the same in both passes.
    """
    sort = [*[F.col(g).asc_nulls_first() for g in groups], *order]
    ranged = df.repartitionByRange(*sort).sortWithinPartitions(*sort)
    rows = written(ranged.withColumn(_AT, F.monotonically_increasing_id()))
    part = F.shiftright(_AT, _ROW_BITS).alias(_PART)
    heads = rows.groupBy(part, *groups).agg(F.min(_AT).alias("first"), F.count(F.lit(1)).alias("n"))
    before: dict[tuple, int] = {}
    bases = []
    for head in sorted(heads.collect(), key=lambda h: h["first"]):
        group = tuple(head[g] for g in groups)
        bases.append((head[_PART], *group, head["first"] - before.get(group, 0) - 1))
        before[group] = before.get(group, 0) + head["n"]
    named = [T.StructField(f"_of_{g}", df.schema[g].dataType) for g in groups]
    schema = T.StructType([T.StructField(_PART, T.LongType()), *named, T.StructField(_BASE, T.LongType())])
    on = F.shiftright(_AT, _ROW_BITS) == F.col(_PART)
    for g in groups:
        on = on & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    based = rows.join(F.broadcast(df.sparkSession.createDataFrame(bases, schema)), on)
    return based.select(*df.columns, (F.col(_AT) - F.col(_BASE)).alias(name))
