"""Malformed lines, one-file exports, and the options of the job."""

import csv
import gzip
import os

import pytest

from fieldspark.plans.entities import Settings
from fieldspark.plans.job import RawFiles, read_staging, run
from fieldspark.sources.raw_csv import TooManyMalformed, export_one_csv, read_with_quarantine
from fieldspark.sources.tables import Warehouse
from tests.raw_fixture import AS_OF, CSV, write_raw

SETTINGS = Settings(as_of=AS_OF)
HEADER = "client_id,client_name,company_id,country,sector,created_at,updated_at_sys\n"
GOOD = ['{},"Alfa, S.L.",1,spain,Farma,2021-01-01,2023-01-01\n'.format(i) for i in range(1, 41)]
FEW, MANY = '50,"a, ""b"" c",1\n', '51,"x,y",1,spain,Farma,2021-01-01,2023-01-01,extra,more\n'


def client_files(tmp_path):
    folder = tmp_path / "raw" / "raw_clients.csv"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text(HEADER + "".join(GOOD[:20]) + FEW)
    (folder / "b.csv").write_text(HEADER + MANY + "".join(GOOD[20:]) + "52\n")
    return str(tmp_path / "raw")


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    rows = read_with_quarantine(house, client_files(tmp_path), "clients", max_share=0.1)
    bad = house.read("quarantine", "raw_clients").collect()
    assert sorted((os.path.basename(r.file), r.line, r.fields, r.reason) for r in bad) == [
        ("a.csv", FEW.strip(), 3, "too few fields"), ("b.csv", MANY.strip(), 9, "too many fields"), ("b.csv", "52", 1, "too few fields"),
    ]
    assert rows.count() + len(bad) == len(GOOD) + 3
    assert rows.select("client_id").where("client_id > 40").isEmpty()  # also when few columns are read
    assert {r.client_name for r in rows.collect()} == {"Alfa, S.L."}


def test_too_many_malformed_lines_stop_the_read_once_kept(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    with pytest.raises(TooManyMalformed, match="3 of 43 lines"):
        read_with_quarantine(house, client_files(tmp_path), "clients", max_share=0.05)
    assert house.read("quarantine", "raw_clients").count() == 3


def test_an_empty_folder_has_nothing_to_keep(spark, tmp_path):
    (tmp_path / "raw_clients.csv").mkdir()
    assert read_with_quarantine(Warehouse(spark, str(tmp_path / "h")), str(tmp_path), "clients").count() == 0


def test_unsplittable_files_are_spread(spark, tmp_path):
    with gzip.open(tmp_path / "raw_clients.csv.gz", "wt") as f:
        f.write(HEADER + "".join(GOOD))
    os.makedirs(tmp_path / "g" / "raw_clients.csv")
    os.link(tmp_path / "raw_clients.csv.gz", tmp_path / "g" / "raw_clients.csv" / "a.csv.gz")
    assert RawFiles(spark, str(tmp_path / "g"), min_tasks=5)["clients"].rdd.getNumPartitions() == 5


def test_one_file_exports(spark, tmp_path):
    df = spark.createDataFrame([(2, None, True), (1, 'a "b", c', None)], "id int, t string, f boolean").repartition(2)
    for _ in range(2):
        export_one_csv(df, str(tmp_path / "out.csv"))
    with open(tmp_path / "out.csv", encoding="utf-8") as f:
        assert list(csv.reader(f)) == [["id", "t", "f"], ["1", 'a "b", c', ""], ["2", "", "true"]]
    assert [n for n in os.listdir(tmp_path) if not n.startswith(".")] == ["out.csv"]


def test_job_options(spark, tmp_path):
    bad = {"pos": CSV["pos"].strip() + "\n7,short\n"}
    raw, root = write_raw(tmp_path, bad), str(tmp_path / "house")
    run(spark, raw, root, "staging", SETTINGS, min_tasks=3, max_malformed=0.5, catalog=True)
    house = Warehouse(spark, root)
    assert [r.reason for r in house.read("quarantine", "raw_pos").collect()] == ["too few fields"]
    assert read_staging(house)["pos"].count() == 2
    about = house.read("catalog", "data_dictionary").where("table_name = 'staging_stg_pos' AND position = 1").first()
    assert (about.about, about.row_count) == ("Points of sale with address and position.", 2)
    assert about.description.startswith("Key.")
    assert spark.catalog.getTable("staging_stg_visits").description.startswith("Visits")
    run(spark, raw, root, "marts", SETTINGS, export_dir=str(tmp_path / "out"), one_file=True)
    assert sorted(n for n in os.listdir(tmp_path / "out") if n.endswith(".csv")) == ["mart_campaign_performance.csv", "mart_visit_responses.csv"]
    run(spark, raw, root, "profile", SETTINGS, exact=True)
    assert not house.read("profile", "quality_report").where("measure = 'top_rows'").isEmpty()
    top = house.read("profile", "frequent_values").where("model = 'stg_workers' AND column_name = 'employee_first_name'")
    assert [(r.value, r.row_count) for r in top.orderBy("value_rank").collect()] == [("Ana", 2), ("Luis", 1)]
