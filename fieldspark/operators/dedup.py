"""Latest version per key."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, key: str, version: str, untied: Collection[str] = ()) -> DataFrame:
    """One row per key: the one with the highest ``version``, missing versions last.

    Ties are broken by all remaining columns, so reruns give the same row; those in ``untied``, which
    follow from others, are left out. Spark turns
    the rank filter into a per-partition limit before the shuffle: a key with very many
    copies leaves one row per input partition. Rows without a key form one group.
    """
    ties = [F.col(c).asc_nulls_last() for c in df.columns if c not in (key, version, *untied)]
    newest_first = Window.partitionBy(key).orderBy(F.col(version).desc_nulls_last(), *ties)
    return df.withColumn("_rank", F.row_number().over(newest_first)).where("_rank = 1").drop("_rank")
