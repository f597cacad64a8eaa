"""Failing values, and results over time."""

import os

import pytest
from pyspark.sql import functions as F

from fieldspark.operators import checks as ck
from fieldspark.operators import history
from fieldspark.operators.checks import ChecksFailed
from fieldspark.plans.entities import Settings
from fieldspark.plans.job import check, read_staging, run
from fieldspark.sources.tables import Warehouse
from tests.raw_fixture import AS_OF, write_raw



def test_failing_values_of_every_kind_of_check(spark):
    child = spark.createDataFrame(
        [(1, 1, "x", 1.0, 5, 3), (1, 9, "y", 2.0, 1, 2), (2, 9, "z", 2.0, 1, 1), (None, None, None, 900.0, None, 1)] + [(i, 1, "x", 1.5, 1, 1) for i in range(3, 20)],
        "id int, fk int, kind string, v double, a int, b int",
    )
    tables = {"child": child, "parent": spark.createDataFrame([(1,), (2,)], "id int")}
    found = ck.failing_rows(tables, [
        ck.NotNull(model="child", column="id"), ck.Unique(model="child", column="id"),
        ck.Relationships(model="child", column="fk", parent="parent", parent_column="id"),
        ck.AcceptedValues(model="child", column="kind", values=["x"]),
        ck.OrderedDates(model="child", column="a", end_column="b"), ck.NoOutliers(model="child", column="v"),
        ck.MaxInvalidShare(model="child", column="kind", max_share=0.1),
    ])
    assert {(r.check_name, r.column_name, r.key, r.row_count) for r in found.collect()} == {
        ("not_null", "id", None, 1), ("unique", "id", "1", 2), ("relationships", "fk", "9", 2),
        ("accepted_values", "kind", "y", 1), ("accepted_values", "kind", "z", 1),
        ("ordered_dates", "a", "5 > 3", 1),
        # the quartiles are equal here, so every other value is an outlier
        ("no_outliers", "v", "900.0", 1), ("no_outliers", "v", "1.0", 1), ("no_outliers", "v", "2.0", 2),
    }


def results(spark, numbers):
    rows = [("unique", "m", c, "error", n, "pass" if n == 0 else "error") for c, n in numbers.items()]
    return spark.createDataFrame(rows, "check_name string, model string, column_name string, severity string, failures bigint, outcome string")


def test_changes_from_run_to_run(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    runs = [{"a": 0, "b": 4, "c": 4, "d": 2}, {"a": 3, "b": 0, "c": 4, "d": 9, "e": 1}, {"a": 3, "b": 0, "c": 1, "d": 10, "e": 1}]
    for i, numbers in enumerate(runs, 1):
        log = house.append("checks", "history", history.of_run(results(spark, numbers), f"r{i}", f"2026-01-0{i} 00:00:00"))
    log = house.append("checks", "history", history.of_run(results(spark, runs[2]), "r3", "2026-01-03 00:00:00"))  # recorded twice
    found = {(r.run_id, r.column_name): (r.change, r.trend) for r in history.changes(log).collect()}
    assert len(found) == 14
    assert [found["r2", c][1] for c in "abcde"] == ["broken", "fixed", "same", "worse", "first"]
    assert [found["r3", c] for c in "abcde"] == [(0, "same"), (0, "same"), (-3, "better"), (1, "worse"), (0, "same")]
    assert {r.column_name for r in history.alerts(log).collect()} == {"d"}
    assert history.alerts(log, least_growth=0.5).collect() == []


def test_the_job_keeps_failures_and_history(spark, tmp_path):
    raw, root = write_raw(tmp_path), str(tmp_path / "house")
    settings = Settings(as_of=AS_OF)
    run(spark, raw, root, "staging", settings)
    house = Warehouse(spark, root)
    for day in ("one", "two"):
        with pytest.raises(ChecksFailed):
            check(house, read_staging(house), "staging", day)
    failures = house.read("checks", "failures_staging")
    assert failures.where("check_name = 'relationships' AND column_name = 'client_id'").select("key", "row_count").collect() == [("9", 1)]
    assert any(d.startswith("check_name=") for d in os.listdir(house.path("checks", "failures_staging")))
    changes = house.read("checks", "changes_staging")
    assert {r.trend for r in changes.where(F.col("run_id") == "two").select("trend").distinct().collect()} == {"same"}
    results = house.read("checks", "results_staging")
    counted = failures.groupBy("check_name", "model", "column_name").agg(F.sum("row_count").alias("rows"))
    orphans = results.join(counted, ["check_name", "model", "column_name"]).where("check_name = 'relationships'")
    assert orphans.where("rows <> failures").isEmpty() and not orphans.isEmpty()
