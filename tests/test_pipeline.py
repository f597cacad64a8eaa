import csv
import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from fieldspark.operators import lookup as lookups
from fieldspark.operators.checks import ChecksFailed
from fieldspark.plans import kpis, marts, starter
from fieldspark.plans.entities import ENTITIES, Settings
from fieldspark.plans.job import RawFiles, read_staging, run
from fieldspark.plans.quality import MART_CHECKS, STAGING_CHECKS, quality_report
from fieldspark.plans.staging import StagedTables, stage
from fieldspark.sources.raw_csv import read_raw
from fieldspark.sources.tables import Warehouse, scratch_warehouse
from tests.raw_fixture import AS_OF, CSV, write_raw

SETTINGS = Settings(as_of=AS_OF)
D = dt.date


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    raw = write_raw(tmp_path_factory.mktemp("raw"))
    root = tmp_path_factory.mktemp("house")
    for layer in ("staging", "marts", "kpis"):
        run(spark, raw, str(root), layer, SETTINGS, export_dir=str(root / "export"))
    # The fixture has an orphan project client and an orphan question campaign.
    with pytest.raises(ChecksFailed, match="relationships stg_projects.client_id: 1"):
        run(spark, raw, str(root), "checks", SETTINGS)
    return Warehouse(spark, str(root))


def by_key(df, key):
    return {r[key]: r for r in df.collect()}


def staged(house, name):
    return by_key(house.read("staging", f"stg_{name}"), ENTITIES[name].key)


def test_every_staging_table_has_its_columns_and_one_row_per_key(house):
    for name, entity in ENTITIES.items():
        df = house.read("staging", f"stg_{name}")
        assert tuple(df.columns) == entity.output
        lines = [line.split(",")[0].strip() for line in CSV[name].strip().split("\n")[1:]]
        assert sorted(str(r[0]) for r in df.select(entity.key).collect()) == sorted(set(lines))


def test_clients(house):
    c = staged(house, "clients")
    assert (c[1].client_name, c[1].client_code, c[1].client_country) == ("Alfa", "CLI1", "SPAIN")
    assert (c[2].client_name, c[2].client_code, c[2].client_sector) == ("Beta", "CLI2", None)
    assert (c[3].client_code, c[3].client_country, c[3].created_at) == (None, None, None)
    assert not c[1].is_client_billable and not c[1].is_active


def test_projects(house):
    p = staged(house, "projects")
    assert (p[1].project_code, p[2].project_code) == ("PRJ1", "PRJ_UNK_2")
    assert (p[1].client_code, p[3].client_code, p[3].project_name) == ("CLI1", None, "Tres")
    assert (p[1].fk_client_id_valid, p[4].fk_client_id_valid) == (True, False)
    assert (p[2].project_exportable, p[3].project_exportable) == (False, None)


def test_campaigns(house):
    c = staged(house, "campaigns")
    assert [c[i].campaign_status for i in (1, 2, 3, 4)] == ["ACTIVA", "CERRADA", "PROGRAMADA", None]
    assert [c[i].campaign_is_active_by_date for i in (1, 2, 3, 4)] == [True, False, False, None]
    assert (c[2].campaign_code, c[2].project_code) == ("CPG_UNK_2", "PRJ_UNK_2")
    assert (c[2].campaign_start_date, c[2].visit_duration_minutes) == (D(2026, 2, 15), 0.0)
    assert (c[1].campaign_name, c[4].campaign_name) == ("Campaña 1", "Campaña 4")
    assert (c[2].campaign_state, c[3].is_active) == (None, None)


def test_workers_pos_and_bridge(house):
    w, p, b = staged(house, "workers"), staged(house, "pos"), staged(house, "route_employee")
    assert (w[11].employee_contract_type, w[1].employee_contract_type) == ("INDEF", None)
    assert (w[2].employee_address_province, w[2].employee_active_status) == ("SORIA", None)
    assert p[1].intervention_point_postal_code == 8001
    assert (p[1].intervention_point_province, p[1].intervention_point_address) == ("PALMAS, LAS", "Calle 1, 2")
    assert (b[2].deleted_at, b[1].ip_percentage) == (D(2026, 1, 5), None)
    assert all(r.fk_route_id_valid and r.fk_employee_id_valid for r in b.values())


def test_visits(house):
    v = staged(house, "visits")
    assert [v[i].visit_status for i in (1, 2, 3, 4, 5)] == ["OK", "INCID", "NOVIS", "INFO", None]
    assert [v[i].visit_time for i in (1, 2, 3)] == ["09:30:00", None, None]
    assert v[2].visit_date == D(2026, 1, 10)
    assert [v[i].fk_route_id_valid for i in (1, 3, 4)] == [True, True, False]


def test_questions_and_responses(house):
    q, r = staged(house, "questions"), staged(house, "responses")
    assert [q[i].question_type for i in (1, 2, 3)] == ["S", "N", "X"]
    assert (q[2].question_code, q[2].question_name) == (None, "Precio, IVA incl.")
    assert [q[i].fk_campaign_id_valid for i in (1, 3)] == [True, False]
    assert (r[1].answer, r[2].answer, r[3].answer, r[4].answer) == ("Sí", '12,50 "IVA"', None, "No")
    assert [r[i].fk_question_id_valid for i in (1, 3, 5)] == [True, False, True]
    assert all(x.fk_visit_id_valid for x in r.values())


def test_campaign_performance(house):
    m = by_key(house.read("marts", "mart_campaign_performance"), "campaign_id")
    one = m[1]
    assert (one.total_visits, one.completed_visits, one.not_visited_visits, one.incid_visits) == (4, 3, 1, 1)
    assert (one.routes_total, one.routes_with_visits) == (2, 1)
    assert (one.workers_assigned, one.main_workers_assigned) == (3, 2)
    assert (one.worker_ids, one.worker_names) == ("1, 11, 2", "Ana, Luis")
    assert (one.completion_rate, one.route_execution_rate, one.incidence_rate) == (0.75, 0.5, 0.25)
    assert (one.project_name, one.client_id, one.client_name) == ("Uno", 1, "Alfa")
    # project found by code only, then neither by id nor by code
    assert (m[3].project_id, m[3].project_name, m[3].client_name) == (3, "Tres", "Beta")
    assert (m[4].project_id, m[4].project_name, m[4].client_id, m[4].client_name) == (78, None, 1, "Alfa")
    assert (m[3].total_visits, m[3].worker_ids, m[3].completion_rate) == (0, "", 0.0)


def test_visit_responses(house):
    m = by_key(house.read("marts", "mart_visit_responses"), "answer_id")
    assert len(m) == 5
    assert (m[1].employee_id, m[1].employee_name, m[1].is_main_employee) == (1, "Ana", True)
    assert (m[1].workers_assigned_count, m[4].workers_assigned_count) == (3, 0)
    assert (m[4].employee_id, m[4].route_id) == (None, None)
    assert [m[i].question_type for i in (1, 2, 3, 5)] == ["S", "N", "T", "X"]
    assert (m[5].employee_id, m[5].is_main_employee) == (2, False)
    assert (m[5].project_id, m[5].project_name, m[5].client_id) == (2, "Dos", 2)


def test_invariants(house):
    m = house.read("marts", "mart_campaign_performance")
    total = m.agg({"total_visits": "sum"}).first()[0]
    known = house.read("staging", "stg_visits").where("fk_campaign_id_valid").count()
    assert total == known
    assert m.where("completed_visits + not_visited_visits > total_visits").count() == 0
    assert m.where("completion_rate NOT BETWEEN 0 AND 1 OR incidence_rate NOT BETWEEN 0 AND 1").count() == 0
    assert house.read("marts", "mart_visit_responses").count() == house.read("staging", "stg_responses").count()


def test_marts_are_the_same_without_broadcasts(spark, house, no_broadcast, monkeypatch):
    monkeypatch.setattr(lookups, "HOT_ROWS", 1)
    tables = read_staging(house)
    for name, mart in (("campaign_performance", marts.campaign_performance), ("visit_responses", marts.visit_responses)):
        want = house.read("marts", f"mart_{name}")
        got = mart(tables)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_raw_file_is_read_once_even_when_hot_keys_are_split(spark, house, tmp_path, no_broadcast, monkeypatch):
    monkeypatch.setattr(lookups, "HOT_ROWS", 1)
    raw = read_raw(spark, write_raw(tmp_path), "visits")
    df = stage("visits", raw, read_staging(house), SETTINGS)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan csv") == 1 and "ReusedExchange" in final


def test_lazy_staging_equals_written_staging(spark, house, tmp_path):
    lazy = StagedTables(RawFiles(spark, write_raw(tmp_path)), SETTINGS)
    assert set(lazy) == set(ENTITIES) and len(lazy) == 10
    for name in ("clients", "visits", "responses"):
        want = house.read("staging", f"stg_{name}")
        assert sorted(map(str, lazy[name].collect())) == sorted(map(str, want.collect()))


def test_kpis(spark, house):
    totals = house.read("kpis", "portfolio_totals").first()
    assert (totals.campaigns, totals.total_visits, totals.pending_visits) == (4, 5, 2)
    assert totals.completion_rate == 0.6
    states = {r.effective_state: r.campaigns for r in house.read("kpis", "state_totals").collect()}
    assert states == {"Activa": 2, "Cerrada": 1, "En preparación": 1}
    months = {str(r.start_month): r.completed_visits for r in house.read("kpis", "active_by_start_month").collect()}
    assert months == {"2026-01-01": 3, "None": 0}
    assert house.read("kpis", "active_workers").first() == (3, 1)
    assert house.read("kpis", "unassigned_visits").first() == (5, 2, 0.4)
    load = house.read("kpis", "worker_load").orderBy("employee_id").collect()
    assert [(r.employee_id, r.visits, r.completed_visits, r.incidence_rate) for r in load] == [
        (1, 2, 2, 0.5), (2, 1, 0, 0.0)]
    status = house.read("kpis", "worker_status")
    assert kpis.of_worker(status, "Ana").count() == 2
    levels = {}
    for r in house.read("kpis", "portfolio_rollup").collect():
        levels[r.level] = levels.get(r.level, 0) + r.total_visits
    assert levels == {0: 5, 1: 5, 2: 5}


def test_check_results(house):
    found = {
        (r.model, r.column_name, r.check_name): (r.failures, r.outcome)
        for r in house.read("checks", "results_all").collect()
    }
    assert found["stg_projects", "client_id", "relationships"] == (1, "error")
    assert found["stg_visits", "route_id", "relationships"] == (1, "warn")
    assert found["stg_questions", "question_type", "accepted_values"] == (1, "warn")
    assert found["stg_responses", "answer_id", "unique"] == (0, "pass")
    assert found["mart_visit_responses", "question_id", "relationships"] == (0, "pass")
    kinds = [c.name for c in STAGING_CHECKS + MART_CHECKS]
    assert [kinds.count(k) for k in ("not_null", "unique", "relationships")] == [21, 12, 14]


def test_full_run_stops_at_errors_but_not_at_warnings(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    raw, root = write_raw(tmp_path / "raw"), str(tmp_path / "house")
    with pytest.raises(ChecksFailed):
        run(spark, raw, root, "all", SETTINGS)
    assert not (tmp_path / "house" / "marts").exists()
    clean = {
        "projects": CSV["projects"].replace("4,Cuatro,PRJ4,9", "4,Cuatro,PRJ4,2"),
        "questions": CSV["questions"].replace("3,9,CAM9", "3,1,CAM1"),
    }
    run(spark, write_raw(tmp_path / "raw", clean), root, "all", SETTINGS)
    house = Warehouse(spark, root)
    staging, mart = (house.read("checks", f"results_{n}") for n in ("staging", "marts"))
    assert {r.outcome for r in staging.collect()} == {"pass", "warn"}
    assert {r.outcome for r in mart.collect()} == {"pass"}
    assert house.read("kpis", "portfolio_totals").first().campaigns == 4
    run(spark, raw, root, "checks-marts", SETTINGS)


def test_export_is_plain_csv(house):
    files = glob.glob(f"{house.root}/export/mart_campaign_performance/*.csv")
    rows = [r for f in files for r in csv.DictReader(open(f, encoding="utf-8"))]
    two = next(r for r in rows if r["campaign_id"] == "2")
    assert (two["campaign_state"], two["is_active"], two["campaign_start_date"]) == ("", "false", "2026-02-15")
    three = next(r for r in rows if r["campaign_id"] == "3")
    assert (three["worker_ids"], three["is_active"]) == ("", "")
    assert next(r for r in rows if r["campaign_id"] == "1")["worker_ids"] == "1, 11, 2"


def test_codes_shared_by_two_projects_repeat_the_campaign(spark, tmp_path):
    shared = {"projects": CSV["projects"].replace("4,Cuatro,PRJ4", "4,Cuatro,PRJ3")}
    tables = StagedTables(RawFiles(spark, write_raw(tmp_path, shared)), SETTINGS)
    rows = marts.campaign_performance(tables).where("campaign_id = 3").collect()
    assert sorted(r.project_id for r in rows) == [3, 4]


def test_raw_columns_are_matched_by_name(spark, tmp_path):
    (tmp_path / "raw_clients.csv").write_text(
        "sector,client_name,client_id,company_id,country,created_at,updated_at_sys\nFarma,Alfa,01,1,,,\n"
    )
    row = read_raw(spark, str(tmp_path), "clients").first()
    assert (row.client_id, row.sector, row.country) == ("01", "Farma", None)


def test_quoted_line_breaks_need_multi_line(spark, tmp_path):
    (tmp_path / "raw_clients.csv").write_text(
        'client_id,client_name,company_id,country,sector,created_at,updated_at_sys\n1,"a\nb",1,,,,\n'
    )
    assert read_raw(spark, str(tmp_path), "clients", multi_line=True).first().client_name == "a\nb"


def test_without_a_day_it_is_today(spark, tmp_path):
    raw = read_raw(spark, write_raw(tmp_path), "campaigns")
    today = Settings(as_of=str(dt.datetime.now(dt.timezone.utc).date()))
    now, then = (by_key(stage("campaigns", raw, settings=s), "campaign_id") for s in (Settings(), today))
    assert {k: v.campaign_status for k, v in now.items()} == {k: v.campaign_status for k, v in then.items()}
    assert any(v.campaign_status for v in now.values())


def test_wide_ids(spark, tmp_path):
    big = CSV["workers"] + "5000000000,Eva,True,,,,1,2020-01-01,2025-01-01\n"
    raw = read_raw(spark, write_raw(tmp_path, {"workers": big}), "workers")
    wide = StagedTables({"workers": raw}, Settings(id_type="bigint"))["workers"]
    assert 5000000000 in by_key(wide, "employee_id")


def test_catalog_table_and_scratch_folder(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    house.save_as_table("staging", "demo", spark.range(3))
    assert spark.table("staging_demo").count() == 3
    with scratch_warehouse(spark) as scratch:
        assert scratch.write("any", "t", spark.range(4)).count() == 4
        shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
        assert scratch.root.startswith(shared)
        folder = scratch.root.removeprefix("file:")
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    house.write("staging", "demo", spark.range(3))
    with pytest.raises(Exception, match="no rows today"):
        house.write("staging", "demo", spark.range(3).select(F.raise_error(F.lit("no rows today")).cast("long").alias("id")))
    assert house.read("staging", "demo").count() == 3
    assert house.write("staging", "demo", house.read("staging", "demo").where("id > 0")).count() == 2


CLIENT_FILES = {
    "a.csv": "client_id,client_name,company_id,country,sector,created_at,updated_at_sys\n1,Alfa,9,ES,Farma,2024-01-01,2024-01-01\n",
    "b.csv": "client_name,client_id,company_id,country,sector,created_at,updated_at_sys\nBeta,2,9,ES,Farma,2024-01-01,2024-01-01\n",
    "c.csv": "client_id,extra,client_name,company_id,country,sector,created_at,updated_at_sys\n3,x,Gama,9,ES,Farma,2024-01-01,2024-01-01\n",
}


def client_folder(tmp_path, files):
    folder = tmp_path / "raw_clients.csv"
    folder.mkdir()
    for name, text in files.items():
        (folder / name).write_text(text, encoding="utf-8")
    return str(tmp_path)


def test_files_of_a_folder_are_matched_by_their_own_headers(spark, tmp_path):
    got = read_raw(spark, client_folder(tmp_path, CLIENT_FILES), "clients")
    assert sorted((r.client_id, r.client_name, r.country) for r in got.collect()) == [("1", "Alfa", "ES"), ("2", "Beta", "ES"), ("3", "Gama", "ES")]


def test_a_file_without_a_column_is_named(spark, tmp_path):
    folder = client_folder(tmp_path, {**CLIENT_FILES, "d.csv": "client_id,client_name\n4,Delta\n"})
    with pytest.raises(ValueError, match="d.csv: missing or repeated columns"):
        read_raw(spark, folder, "clients")


def test_quality_report(spark, house):
    models = {f"stg_{n}": df for n, df in read_staging(house).items()}
    report = quality_report(models, STAGING_CHECKS, exact=True)
    found = {(r.model, r.column_name, r.measure): r.value for r in report.collect()}
    assert {(m, c) for m, c, _ in found} >= {(m, c) for m, df in models.items() for c in df.columns}
    assert found["stg_workers", "employee_contract_type", "nulls"] == 1
    assert found["stg_workers", "employee_first_name", "distinct_values"] == 2
    assert found["stg_projects", "client_id", "failures_relationships"] == 1


def test_descriptions_travel_with_the_tables(house):
    visits = house.read("staging", "stg_visits").schema
    assert visits["visit_id"].metadata["comment"].startswith("Key.")
    assert "may be missing" in visits["route_id"].metadata["comment"]
    mart = house.read("marts", "mart_visit_responses").schema
    assert "one row per answer" in mart["answer_id"].metadata["comment"]


def test_starter_tables(spark):
    first = starter.first(spark)
    assert sorted(map(tuple, first.collect()), key=str) == [(1,), (None,)]
    assert [r.id for r in starter.second(first).collect()] == [1]
    assert [r.id for r in starter.first(spark, keep_null_ids=False).collect()] == [1]


def test_mart_reads_only_the_columns_it_needs(house):
    plan = marts.campaign_performance(read_staging(house))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<visit_id:int,campaign_id:int,visit_status:string>" in plan
    assert "answer" not in plan
