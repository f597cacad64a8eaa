"""The most frequent values of columns, found by sketches and counted exactly.

A first pass keeps a frequent-items sketch for each column in every task; sketches merge, so only they
are shuffled. A second pass counts the sketches' candidates alone, and combines before the shuffle.
A value that is no candidate has fewer rows than the sketch may be wrong by, so the top of a column is
exact if the last count in it is above that. Where it isn't, as values are all about equally rare, the
column is read again with a larger sketch, unless the values found are too rare for that one too. In the
end all values of the columns left are counted, in one pass over all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.operators.profile import value_counts

#: Items that a sketch tracks, in one pass after the other.
TRACKED = (1 << 10, 1 << 14)
#: Share of the rows, times the items tracked, that bounds the rows of a value that isn't reported: a
#: sketch of 4/3 as many slots is off by 3.5 / slots, and values up to twice that may be left out.
_LEFT_OUT = 2 * 3.5 * 3 / 4

_RESULT = T.StructType([
    T.StructField("column_name", T.StringType()), T.StructField("value", T.StringType()),
    T.StructField("row_count", T.LongType()), T.StructField("value_rank", T.LongType()),
])


def _candidates(df: DataFrame, columns: Sequence[str], tracked: int) -> tuple[dict[str, int], list[tuple[str, str]]]:
    """Non-null rows of each column and the candidates of its sketch."""
    texts = df.select(*[F.col(c).cast("string").alias(f"v{i}") for i, c in enumerate(columns)])
    found = texts.agg(
        *[F.count(f"v{i}").alias(f"n{i}") for i in range(len(columns))],
        *[F.expr(f"approx_top_k(v{i}, {tracked}, {tracked}) FILTER (WHERE v{i} IS NOT NULL)").alias(f"t{i}") for i in range(len(columns))],
    ).first()
    rows = {c: found[f"n{i}"] for i, c in enumerate(columns)}
    return rows, [(c, item[0]) for i, c in enumerate(columns) for item in found[f"t{i}"] or () if item[0] is not None]


def _counted(df: DataFrame, candidates: list[tuple[str, str]]) -> dict[str, list[tuple[str, int]]]:
    """Exact rows of the candidates of each column, the most frequent first, ties by value."""
    columns = sorted({c for c, _ in candidates})
    wanted = df.sparkSession.createDataFrame(candidates, "column_name string, value string")
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    counts = (
        df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
        .join(F.broadcast(wanted), ["column_name", "value"], "left_semi")  # as many as the sketches track
        .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    found: dict[str, list[tuple[str, int]]] = {c: [] for c in columns}
    for column, value, n in counts.collect():
        found[column].append((value, n))
    return {c: sorted(v, key=lambda x: (-x[1], x[0].encode())) for c, v in found.items()}


def _all_counted(df: DataFrame, columns: Sequence[str], k: int) -> list[tuple]:
    """The top of columns from the counts of all their values: each task passes on ``k`` values a column."""
    best = Window.partitionBy("column_name").orderBy(F.desc("row_count"), F.asc("value"))
    counts = value_counts(df, columns).where("value IS NOT NULL")
    top = counts.withColumn("value_rank", F.row_number().over(best)).where(F.col("value_rank") <= k)
    return [(r.column_name, r.value, r.row_count, r.value_rank) for r in top.collect()]


def frequent_values(df: DataFrame, columns: Sequence[str], k: int, tracked: Sequence[int] = TRACKED) -> DataFrame:
    """The ``k`` most frequent non-null values of each column as text: rows (column_name, value, row_count,
    value_rank), exact, ties by value. The driver gets the candidates, as many as are tracked."""
    result: list[tuple] = []
    sketched, counted_whole = list(columns), []
    sizes = [max(size, 2 * k) for size in tracked]
    for i, size in enumerate(sizes):
        if not sketched:
            break
        rows, candidates = _candidates(df, sketched, size)
        counted = _counted(df, candidates) if candidates else {}
        again = []
        for c in sketched:
            best = counted.get(c, [])
            complete = sum(n for _, n in best) == rows[c]  # no other values are there
            last = best[k - 1][1] if len(best) >= k else 0
            if complete or last > _LEFT_OUT * rows[c] / size:
                result += [(c, value, n, j) for j, (value, n) in enumerate(best[:k], 1)]
            elif any(last > _LEFT_OUT * rows[c] / larger for larger in sizes[i + 1:]):
                again.append(c)
            else:
                counted_whole.append(c)
        sketched = again
    if rest := counted_whole + sketched:
        result += _all_counted(df, rest, k)
    return df.sparkSession.createDataFrame(result, _RESULT)
