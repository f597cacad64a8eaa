"""Every registered query against its SQL, and the shape of its plan."""

import os

import pytest

import __spark_entry__ as entry_point
from fieldspark.operators import lookup as lookups
from fieldspark.plans.job import RawFiles, build_marts, build_staging
from fieldspark.sources.tables import Warehouse
from workload.compare import connect, differences
from workload.queries import REGISTRY, SETTINGS
from workload.raw_tables import RawTables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(entry_point.queries())
    assert set(REGISTRY) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_its_sql(spark, con, name):
    df = entry_point.queries()[name](spark, SF)
    assert differences(df, con, entry_point.oracle_sql()[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan


@pytest.mark.parametrize("name", ["stg_visits", "stg_responses", "mart_visit_responses", "mart_campaign_performance"])
def test_query_without_broadcasts(spark, con, no_broadcast, monkeypatch, name):
    monkeypatch.setattr(lookups, "HOT_ROWS", 2)
    df = entry_point.queries()[name](spark, SF)
    assert differences(df, con, entry_point.oracle_sql()[name]) == []


def test_job_on_csv_files_gives_the_same_marts(spark, con, tmp_path):
    raw = RawTables(spark, SF)
    for name, df in raw.items():
        df.repartition(3).write.option("header", True).option("escape", '"').csv(f"{tmp_path}/raw/raw_{name}.csv")
    house = Warehouse(spark, str(tmp_path / "house"))
    tables = build_staging(RawFiles(spark, str(tmp_path / "raw")), house, SETTINGS)
    build_marts(house, tables)
    for name in ("mart_campaign_performance", "mart_visit_responses"):
        assert differences(house.read("marts", name), con, entry_point.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry_point.entry(spark).count() == 150
