"""Descriptions: of columns as ``comment`` metadata that Parquet tables carry along, and of tables and
columns in the catalog, from where the data dictionary lists them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.operators.profile import null_counts


def described(columns: Iterable[str], comments: Mapping[str, str]) -> list[Column]:
    """The columns to select, with comments attached where there are any."""
    return [
        F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c)
        for c in columns
    ]


def data_dictionary(spark: SparkSession, tables: Iterable[str]) -> DataFrame:
    """A row for each column of tables of the catalog: table_name, about (the table), position from 1 on,
    column_name, description (null without one), row_count and null_count. One pass over each table."""
    parts = []
    for name in tables:
        about = spark.catalog.getTable(name).description
        listed = [(i, c.name, c.description) for i, c in enumerate(spark.catalog.listColumns(name), 1)]
        columns = spark.createDataFrame(listed, "position int, column_name string, description string")
        counted = null_counts(spark.table(name)).join(F.broadcast(columns), "column_name")
        parts.append(counted.select(
            F.lit(name).alias("table_name"), F.lit(about).alias("about"), "position", "column_name", "description",
            "row_count", "null_count",
        ))
    return reduce(DataFrame.unionByName, parts)
