"""Key sets, reference flags and attributes recovered from another table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.operators.lookup import lookup

NullPolicy = Literal["valid", "invalid"]


def key_set(df: DataFrame, key: Column, name: str) -> DataFrame:
    """The distinct values of a key expression; repeats collapse before the shuffle."""
    return df.select(key.alias(name)).distinct()


def with_fk_flag(
    df: DataFrame,
    fk: str,
    keys: DataFrame,
    key: str,
    flag: str,
    *,
    null_fk: NullPolicy,
    hot_from: DataFrame | None = None,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Add ``flag``: whether ``fk`` occurs among the parent's keys. ``null_fk`` says how a
    missing reference counts. ``keys`` must not repeat a key, see ``key_set``."""
    parent = keys.select(F.col(key).alias("_ref"))
    joined = lookup(df, parent, fk, "_ref", hot_from=hot_from, spread_by=spread_by, keep_key=True)
    found = F.col("_ref").isNotNull()
    valid = F.col(fk).isNull() | found if null_fk == "valid" else found
    return joined.withColumn(flag, valid).drop("_ref")


def highest_per_key(df: DataFrame, key: Column, value: Column, key_name: str, name: str) -> DataFrame:
    """One value per key, the highest in string order; missing values are ignored."""
    return df.groupBy(key.alias(key_name)).agg(F.max(value).alias(name))
