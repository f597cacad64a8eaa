"""Tables of many computed columns: session settings, task sizes, frequent values and marts read from written staging."""

import math
import os

import pytest
from pyspark.sql import functions as F

from fieldspark.operators.frequent import frequent_values
from fieldspark.sources.estimates import estimated_bytes
from fieldspark.sources.tables import WIDE_TABLES, balanced, set_for_wide_tables
from workload.queries import REGISTRY
from workload.raw_tables import RawTables


def test_settings_replace_defaults_only(spark):
    names = [name for name, _, _ in WIDE_TABLES]
    before = [spark.conf.get(n) for n in names]
    try:
        for name, default, _ in WIDE_TABLES:
            spark.conf.set(name, default)
        RawTables(spark, "/nowhere")
        assert [spark.conf.get(n) for n in names] == [value for _, _, value in WIDE_TABLES]
        spark.conf.set(names[0], "20000")
        set_for_wide_tables(spark)
        assert spark.conf.get(names[0]) == "20000"
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)


def test_tasks_of_an_unsplittable_scan_follow_its_bytes(spark, tmp_path):
    path = str(tmp_path / "one_file")
    spark.range(50_000).select(F.rand(1).alias("v")).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    wanted = math.ceil(estimated_bytes(df) / 10_000)
    assert wanted > 20
    spread = balanced(df, min_tasks=16, task_bytes=10_000)
    assert spread.rdd.getNumPartitions() == wanted and spread.count() == 50_000
    assert balanced(df, min_tasks=16, task_bytes=1 << 30).rdd.getNumPartitions() == 16


def test_columns_of_rare_values_are_counted_in_one_pass(spark, monkeypatch):
    """Values too rare for the larger sketch too are not sketched again, and their columns share a pass."""
    df = spark.range(3_000).select(*[F.concat(F.lit(c), "id").alias(c) for c in "abc"])
    frame, grouped, sketched = type(df), [], []
    group, agg = frame.groupBy, frame.agg
    monkeypatch.setattr(frame, "groupBy", lambda self, *c: grouped.append(self) or group(self, *c))
    monkeypatch.setattr(frame, "agg", lambda self, *c: sketched.append(self) or agg(self, *c))
    found = frequent_values(df, ["a", "b", "c"], 2, (16, 64)).collect()
    assert sorted(map(tuple, found)) == sorted((c, f"{c}{v}", 1, i) for c in "abc" for i, v in ((1, 0), (2, 1)))
    assert len(grouped) == 2  # the candidates of one sketch, then all values of all columns
    assert len(sketched) == 1


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the given tables")
@pytest.mark.parametrize("name", ["mart_campaign_performance", "mart_visit_responses", "kpi_portfolio_totals"])
def test_marts_read_written_staging(spark, name):
    """No raw row is cleaned or ranked again in the plan of a mart: it reads each staging table as written."""
    df = REGISTRY[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "customer" not in plan and "lineitem" not in plan
    assert all("/staging/" in f for f in df.inputFiles())
