"""A balance of -0.0: its raw longitude is a minus sign before the text of a negative zero, ``--0.0``."""

import math

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fieldspark.functions import casts
from tests.test_late_numbers import TABLES
from workload.compare import connect, differences
from workload.oracle import ORACLE_SQL
from workload.queries import REGISTRY

BALANCES = (-700.0, -0.0, 1400.0, 2800.0)


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """The same tables with that balance, and with 0.0 in its place, whose text the SQL can read."""
    made = []
    for name, sign in (("negative", -1.0), ("positive", 1.0)):
        made.append(str(tmp_path_factory.mktemp(name)))
        for table, (schema, rows) in TABLES.items():
            if table == "customer":
                balances = [b or math.copysign(0.0, sign) for b in BALANCES]
                rows = [(k, n, k, b, s) for (k, n, _, _, s), b in zip(rows, balances)]
            pq.write_table(spark.createDataFrame(rows, schema).toArrow(), f"{made[-1]}/{table}.parquet")
    return made


@pytest.mark.parametrize("name", [
    "check_not_null", "check_unique", "data_dictionary", "stg_visits_incremental", "stg_responses_incremental",
])
def test_negative_zero_stops_no_query(spark, folders, name):
    negative, positive = folders
    assert differences(REGISTRY[name](spark, negative), connect(positive), ORACLE_SQL[name]) == []


@pytest.mark.parametrize("name, numbers", [
    ("stg_pos", ["intervention_point_latitude", "intervention_point_longitude"]), ("quality_report", ["value"]),
])
def test_negative_zero_gives_the_rows_of_zero(spark, folders, name, numbers):
    negative, positive = folders
    df = REGISTRY[name](spark, negative).withColumns({c: F.col(c) + F.lit(0.0) for c in numbers})  # -0.0 + 0.0 is 0.0
    sql = f"SELECT * REPLACE ({', '.join(f'{c} + CAST(0 AS DOUBLE) AS {c}' for c in numbers)}) FROM ({ORACLE_SQL[name]})"
    assert differences(df, connect(positive), sql) == []


def test_only_zeros_may_have_signs_that_mean_nothing(spark):
    def cast(*values):
        return [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(casts.real(F.col("v"))).collect()]

    assert cast("--0.0", " -+0 ", "-0.0", "-1.5", None) == [0.0, 0.0, 0.0, -1.5, None]
    for bad in ("--1.5", "--0.1", "-", "--", "0-0", "x"):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            cast(bad)
