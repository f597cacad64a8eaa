"""Numbers of parents that are bad: what reads them fails, and what reads only the parents' keys does not."""

import datetime as dt

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fieldspark.operators import checks as ck
from fieldspark.plans.entities import ENTITIES, Settings
from fieldspark.plans.increments import StagingStore
from fieldspark.plans.quality import staging_model
from fieldspark.plans.staging import stage
from fieldspark.sources.tables import Warehouse, folders
from workload import queries
from workload.compare import connect, differences
from workload.oracle import ORACLE_SQL
from workload.queries import REGISTRY

SETTINGS = Settings(as_of=dt.date(2026, 6, 5))
LARGE = 10_000_000_000  # added to a nation key, it makes a postal code beyond 32 bits
DAY = dt.datetime(1996, 3, 1)
TABLES = {
    "customer": ("c_custkey bigint, c_name string, c_nationkey bigint, c_acctbal double, c_mktsegment string", [
        (k, f"C{k}", k % 2 * LARGE + k, 700.0 * k, s) for k, s in enumerate(("BUILDING", "HOUSEHOLD", "MACHINERY", "FURNITURE"), 1)
    ]),
    "supplier": ("s_suppkey bigint, s_name string, s_nationkey bigint, s_acctbal double", [
        (k, f"S{k}", k, 2500.0 * k) for k in range(1, 4)
    ]),
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double", [
        (k, f"P{k}", "B1", t, 10 * k, 900.0 + k) for k, t in enumerate(("SMALL", "PROMO", "LARGE"), 1)
    ]),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string", [
            (k, k % 4 + 1, "FOP"[k % 3], 40_000.0 * k, DAY + dt.timedelta(days=150 * k), ("1-URGENT", "3-MEDIUM", "5-LOW")[k % 3])
            for k in range(1, 9)
        ],
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz", [
            (k, k % 3 + 1, k % 3 + 1, n, 6.0 * k, 10.0 * k, 0.01 * n, 0.02, "RAN"[k % 3], "OF"[k % 2], DAY + dt.timedelta(days=150 * k))
            for k in range(1, 9) for n in (1, 2)
        ],
    ),
    "events": ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string", [(1, DAY, 1, "a", 1.0, "{}")]),
}


@pytest.fixture(scope="module")
def large_codes(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("large"))
    for name, (schema, rows) in TABLES.items():
        pq.write_table(spark.createDataFrame(rows, schema).toArrow(), f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", [
    "check_not_null", "stg_visits_incremental", "stg_responses_incremental", "check_marts", "mart_visit_responses_bucketed",
])
def test_large_postal_codes_stop_no_query_that_does_without_them(spark, large_codes, name):
    df = REGISTRY[name](spark, large_codes)
    assert df.count() > 0
    assert differences(df, connect(large_codes), ORACLE_SQL[name]) == []


def test_the_bucketed_mart_stages_only_what_it_reads(spark, large_codes, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "session_warehouse", lambda spark: Warehouse(spark, str(tmp_path)))
    queries.mart_visit_responses_bucketed(spark, large_codes)
    assert set(folders(spark, f"{tmp_path}/staging")) == {staging_model(n) for n in queries.ANSWERS}
    assert "pos" not in queries.ANSWERS


def test_unique_keys_are_checked_without_the_codes(spark, large_codes):
    found = {r.model: r.failures for r in REGISTRY["check_unique"](spark, large_codes).collect()}
    assert len(found) == len(ENTITIES) and set(found.values()) == {0}


@pytest.mark.parametrize("name", ["stg_pos", "quality_report", "data_dictionary"])
def test_large_postal_codes_stop_what_reads_them(spark, large_codes, name):
    with pytest.raises(Exception, match="not a whole number: 01000000"):
        REGISTRY[name](spark, large_codes).collect()


def test_postal_codes_of_32_bits_are_those_of_the_sql(spark, tmp_path):
    schema, rows = TABLES["customer"]
    largest = 2**31 - 1 - 8000  # the nation key of the largest postal code
    near = [(k, name, largest - 4 + k, balance, segment) for k, name, _, balance, segment in rows]
    for kind in ("int", "bigint"):
        folder = tmp_path / kind
        folder.mkdir()
        table = spark.createDataFrame(near, schema.replace("c_nationkey bigint", f"c_nationkey {kind}"))
        pq.write_table(table.toArrow(), str(folder / "customer.parquet"))
        df = REGISTRY["stg_pos"](spark, str(folder))
        assert max(r.intervention_point_postal_code for r in df.collect()) == 2**31 - 1
        assert differences(df, connect(str(folder)), ORACLE_SQL["stg_pos"]) == []


@pytest.mark.parametrize("name", ["stg_pos", "quality_report", "data_dictionary"])
def test_large_postal_codes_stop_the_sql_of_what_reads_them(large_codes, name):
    with pytest.raises(duckdb.ConversionException, match="to INT32"):
        connect(large_codes).execute(ORACLE_SQL[name]).fetchall()


def pos(spark, *rows):
    """Raw points of sale: key, postal code and day."""
    df = spark.createDataFrame(rows, "intervention_point_id string, intervention_point_postal_code string, updated_at string")
    return df.select("*", *[F.lit(None).cast("string").alias(c.name) for c in ENTITIES["pos"].cleaned if c.name not in df.columns])


def test_a_bad_number_of_any_version_fails_what_reads_it(spark):
    staged = stage("pos", pos(spark, ("1", "x1", "2020-01-01"), ("1", "08001", "2021-01-01"), ("2", None, "2021-01-01")), settings=SETTINGS)
    with pytest.raises(Exception, match="not a whole number: x1"):
        staged.collect()
    declared = [ck.NotNull(model="pos", column="intervention_point_id"), ck.Unique(model="pos", column="intervention_point_id")]
    assert [r.failures for r in ck.run_checks({"pos": staged}, declared).collect()] == [0, 0]
    lenient = stage("pos", pos(spark, ("1", "x1", "2020-01-01")), settings=Settings(strict_ids=False))
    assert [r.intervention_point_postal_code for r in lenient.collect()] == [None]


def test_a_stored_bad_number_waits_for_a_better_version(spark, tmp_path):
    store = StagingStore(Warehouse(spark, str(tmp_path)), SETTINGS, buckets=2)
    store.merge({"pos": pos(spark, ("1", "x1", "2020-01-01"), ("2", "08002", "2020-01-01"))})
    assert sorted(r[0] for r in store.read("pos").select("intervention_point_id").collect()) == [1, 2]
    with pytest.raises(Exception, match="not a whole number: x1"):
        store.read("pos").collect()
    store.merge({"pos": pos(spark, ("1", "08001", "2021-01-01"))})
    assert sorted(r.intervention_point_postal_code for r in store.read("pos").collect()) == [8001, 8002]
