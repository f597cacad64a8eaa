"""Equi-join lookups that hold when the looked-up side is large and keys are skewed.

A side is broadcast only when the optimizer's size estimate of it is under the session's
``spark.sql.autoBroadcastJoinThreshold``. A side that is itself a join may hold more than the tables
it is made of: if those are small it is left to adaptive execution, which broadcasts it once its
size is known. Beyond that the join shuffles on the key. Given a table with the key column, hot
keys are split: keys are counted (repeats combine before that shuffle), and a key with more rows
than an even share of a shuffle partition is divided into salts of about that many rows each. Its
rows on the left take a salt from a hash, its matches on the right are repeated once per salt. There are no more
hot keys than shuffle partitions and twice as many salts, which bounds the broadcast and the
repetition. Counts are exact, so both sides agree on the salts even if a lost executor makes
Spark compute them again. Null keys, which never match, are spread as well. Without such a
table adaptive execution splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.sources.estimates import UNKNOWN, estimated_bytes

#: Rows beyond which a key is split; by default the rows divided by the shuffle partitions.
HOT_ROWS: int | None = None
NULL_SALTS = 1 << 20

#: A column of ``hot_from`` that says how many rows each of its rows stands for.
ROWS = "_rows_of_key"

_HOT, _SALTS, _SALT, _REF_SALT = "_hot_key", "_hot_salts", "_salt", "_ref_salt"


def fits_broadcast(frames: Sequence[DataFrame]) -> bool:
    """Whether the frames together are estimated under the session's broadcast limit."""
    size = sum(estimated_bytes(f) for f in frames)
    if size >= UNKNOWN:
        return False
    conf = frames[0].sparkSession._jsparkSession.sessionState().conf()
    return size <= conf.autoBroadcastJoinThreshold()


def hot_keys(keys: DataFrame, column: str, parts: int | None = None) -> DataFrame:
    """Keys with more than their share of rows, and into how many salts each is divided. The share is that
    of one of ``parts``, by default of a shuffle partition."""
    rows = F.sum(ROWS) if ROWS in keys.columns else F.count(F.lit(1))
    counts = keys.groupBy(F.col(column).alias(_HOT)).agg(rows.alias("n"))
    if HOT_ROWS is None:
        parts = parts or int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        limit = F.ceil(counts.select(F.sum("n")).scalar() / parts)
    else:
        limit = F.lit(HOT_ROWS)
    hot = counts.where(F.col(_HOT).isNotNull() & (F.col("n") > limit))
    return hot.select(_HOT, F.ceil(F.col("n") / limit).cast("int").alias(_SALTS))


def _spread(
    left: DataFrame, right: DataFrame, fk: str, key: str, how: str, spread_by: Sequence[str],
    hot_from: DataFrame,
) -> DataFrame:
    hot = F.broadcast(hot_keys(hot_from, fk))
    salts = F.when(F.col(fk).isNull(), NULL_SALTS).otherwise(F.coalesce(F.col(_SALTS), F.lit(1)))
    salted = (
        left.join(hot, F.col(fk) == F.col(_HOT), "left")
        .withColumn(_SALT, F.pmod(F.xxhash64(*spread_by), salts).cast("int"))
        .drop(_HOT, _SALTS)
    )
    every_salt = F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1)
    repeated = (
        right.join(hot, F.col(key) == F.col(_HOT), "left")
        .withColumn(_REF_SALT, F.explode(every_salt))
        .drop(_HOT, _SALTS)
    )
    on: Column = (F.col(fk) == F.col(key)) & (F.col(_SALT) == F.col(_REF_SALT))
    return salted.join(repeated, on, how).drop(_SALT, _REF_SALT)


def lookup(
    left: DataFrame,
    right: DataFrame,
    fk: str,
    key: str,
    *,
    how: str = "left",
    sized_by: Sequence[DataFrame] | None = None,
    hot_from: DataFrame | Callable[[], DataFrame] | None = None,
    spread_by: Sequence[str] = (),
    keep_key: bool = False,
) -> DataFrame:
    """Join ``right`` to ``left`` on ``left.fk = right.key``.

    The two sides must not share column names. ``sized_by`` gives the tables ``right`` is
    made of, when it is itself a join. ``hot_from`` is a
    table with the values of ``fk`` (stored, or one whose shuffle the plan can reuse), or a function that
    makes it when it is needed; with a column ``ROWS`` its rows stand for as many. Its hot keys are split
    by a hash of the ``spread_by`` columns, which tell the rows of a key apart.
    """
    small = fits_broadcast([right] if sized_by is None else sized_by)
    if small and sized_by is None:
        joined = left.join(F.broadcast(right), F.col(fk) == F.col(key), how)
    elif small or hot_from is None:
        joined = left.join(right, F.col(fk) == F.col(key), how)
    else:
        joined = _spread(left, right, fk, key, how, spread_by, hot_from() if callable(hot_from) else hot_from)
    return joined if keep_key else joined.drop(key)
