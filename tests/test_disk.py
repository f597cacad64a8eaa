"""What stays on disk while tables are built: the shuffle files of one step, not of all."""

import os

import pytest
from pyspark.sql import functions as F

from fieldspark.plans import job, marts
from fieldspark.plans.entities import ENTITIES
from fieldspark.sources.buckets import write_bucketed
from fieldspark.sources.tables import SHUFFLE_CLEANUP, Warehouse
from workload.queries import ANSWERS, REGISTRY, SETTINGS
from workload.raw_tables import RawTables

SF = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (found.apply(i).getName() for i in range(found.size())) if name.startswith("shuffle_")}


def shuffled(spark):
    return spark.range(3_000).repartition(5, "id").groupBy((F.col("id") % 100).alias("k")).agg(F.max("id").alias("v"))


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    house, before = Warehouse(spark, str(tmp_path)), shuffle_files(spark)
    written = house.write("any", "t", shuffled(spark))
    assert not shuffle_files(spark) - before
    job.write_together(house, "any", {n: lambda: shuffled(spark) for n in "abc"})
    assert not shuffle_files(spark) - before
    write_bucketed(house, "any", "b", written, "k", 4)
    assert not shuffle_files(spark) - before
    assert written.count() == 100 and spark.conf.get(SHUFFLE_CLEANUP) == "false"
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    house.write("any", "t", shuffled(spark))
    assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    spark.conf.unset(SHUFFLE_CLEANUP)


def rows(df):
    return sorted(map(str, df.collect()))


@given
def test_large_tables_are_staged_in_steps(spark, tmp_path, monkeypatch):
    raw = RawTables(spark, SF)
    names = ("campaigns", "routes", "route_employee", "workers")
    whole = job.build_staging(raw, Warehouse(spark, f"{tmp_path}/whole"), SETTINGS, names)
    wrote, write = [], Warehouse.write
    monkeypatch.setattr(job, "TOGETHER_BYTES", 0)
    monkeypatch.setattr(Warehouse, "write", lambda self, layer, name, *rest: wrote.append((layer, name)) or write(self, layer, name, *rest))
    steps = job.build_staging(raw, Warehouse(spark, f"{tmp_path}/steps"), SETTINGS, names)
    assert [n for layer, n in wrote if layer == "latest"] == ["routes", "route_employee"]
    for n in names:
        assert steps[n].schema == whole[n].schema and rows(steps[n]) == rows(whole[n])
    scratch = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    assert not [d for d, _, _ in os.walk(scratch) if "/latest/" in d]
    assert not any(ENTITIES[n].references for n in names if ("latest", n) not in wrote)


@given
def test_visits_are_written_before_answers_meet_them(spark, tmp_path):
    df = REGISTRY["mart_visit_responses"](spark, SF)
    assert any("/parts/visit_details/" in f for f in df.inputFiles())
    assert not any("stg_visits/" in f or "stg_route_employee/" in f for f in df.inputFiles())
    house = Warehouse(spark, str(tmp_path))
    tables = job.build_staging(RawTables(spark, SF), house, SETTINGS, ANSWERS)
    wanted = rows(marts.visit_responses(tables))
    assert rows(df) == wanted
    job.build_facts(house, tables, 4)
    mart = job.responses_from_facts(house, tables)
    assert any("/facts/visit_details_even/" in f for f in mart.inputFiles()) and rows(mart) == wanted


@given
def test_the_bucketed_mart_without_broadcasts(spark, tmp_path, no_broadcast):
    house = Warehouse(spark, str(tmp_path))
    tables = job.build_staging(RawTables(spark, SF), house, SETTINGS, ANSWERS)
    job.build_facts(house, tables, 4)
    mart = job.responses_from_facts(house, tables)
    assert rows(mart) == rows(marts.visit_responses(tables))
