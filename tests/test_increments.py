"""Staging merged from increments against staging built from all rows."""

import os

import pytest

from fieldspark.plans.entities import ENTITIES, Settings
from fieldspark.plans.increments import StagingStore, merged
from fieldspark.plans.job import RawFiles, read_staging, run
from fieldspark.plans.staging import StagedTables
from fieldspark.sources.tables import Warehouse
from tests.raw_fixture import AS_OF, CSV, write_raw

SETTINGS = Settings(as_of=AS_OF)


def rows(df):
    return sorted(map(str, df.collect()))


def part(lines, take):
    """A raw file with its header and the lines for which ``take`` holds."""
    header, *body = lines.strip().split("\n")
    return "\n".join([header, *[line for i, line in enumerate(body) if take(i)]]) + "\n"


def files_of(store, name):
    """The stored files of every bucket."""
    return {
        bucket: frozenset(f for f in os.listdir(f"{store._folder(name, version)}/_key_bucket={bucket}") if f.endswith(".parquet"))
        for bucket, version in store._manifest(name).items()
    }


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    return StagedTables(RawFiles(spark, write_raw(tmp_path_factory.mktemp("all"))), SETTINGS)


def test_two_parts_equal_the_whole(spark, tmp_path, whole):
    halves = []
    for k in (1, 0):  # children arrive before some of their parents
        (tmp_path / str(k)).mkdir()
        halves.append(RawFiles(spark, write_raw(tmp_path / str(k), {n: part(t, lambda i: i % 2 == k) for n, t in CSV.items()})))
    store = merged(Warehouse(spark, str(tmp_path / "house")), halves, SETTINGS, buckets=5)
    for name in ENTITIES:
        assert rows(store.read(name)) == rows(whole[name]), name
    for name in ("visits", "projects"):
        again = files_of(store, name)
        store.vacuum(name)
        assert files_of(store, name) == again and rows(store.read(name)) == rows(whole[name])


def test_only_touched_buckets_are_written(spark, tmp_path, whole):
    store = StagingStore(Warehouse(spark, str(tmp_path / "house")), SETTINGS, buckets=16)
    store.merge(RawFiles(spark, write_raw(tmp_path)))
    before = {n: files_of(store, n) for n in ENTITIES}
    (tmp_path / "more").mkdir()
    header = CSV["clients"].split("\n")[0]
    new = RawFiles(spark, write_raw(tmp_path / "more", {"clients": f"{header}\n9,Nueva,1,spain,Farma,2021-01-01,2023-01-01\n"}))
    touched = store.merge({"clients": new["clients"]})
    assert {n: len(b) for n, b in touched.items() if b} == {"clients": 1, "projects": 1}  # project 4 waited for client 9
    for name in ENTITIES:
        after = files_of(store, name)
        assert {b for b in after if after[b] != before[name].get(b)} == touched[name]
    assert [r.fk_client_id_valid for r in store.read("projects").where("project_id = 4").collect()] == [True]
    assert store.read("clients").where("client_id = 9").first().client_code == "CLI9"
    again = store.merge({"clients": new["clients"]})  # the same rows change nothing
    assert again["projects"] == set()
    assert store.read("clients").count() == whole["clients"].count() + 1


def test_older_versions_don_t_replace_newer_ones(spark, tmp_path):
    store = StagingStore(Warehouse(spark, str(tmp_path / "house")), SETTINGS, buckets=3)
    raw = RawFiles(spark, write_raw(tmp_path))
    store.merge({"clients": raw["clients"].where("updated_at_sys = '2023-01-01'")})
    store.merge({"clients": raw["clients"]})
    assert store.read("clients").where("client_id = 2").first().client_name == "Beta"


def test_another_number_of_buckets_is_refused(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    raw = RawFiles(spark, write_raw(tmp_path))
    StagingStore(house, SETTINGS, buckets=3).merge({"pos": raw["pos"]})
    with pytest.raises(ValueError, match="stored in 3 buckets"):
        StagingStore(house, SETTINGS, buckets=4).merge({"pos": raw["pos"]})


def test_the_job_merges(spark, tmp_path, whole):
    root = str(tmp_path / "house")
    run(spark, write_raw(tmp_path), root, "staging", SETTINGS, merge=True)
    (tmp_path / "more").mkdir()
    (tmp_path / "more" / "raw_pos.csv").write_text(CSV["pos"].strip().replace("2,pdv2", "3,pdv3") + "\n", encoding="utf-8")
    run(spark, str(tmp_path / "more"), root, "staging", SETTINGS, merge=True)
    tables = read_staging(Warehouse(spark, root), SETTINGS)
    assert sorted(r[0] for r in tables["pos"].select("intervention_point_id").collect()) == [1, 2, 3]
    assert rows(tables["responses"]) == rows(whole["responses"])
    run(spark, str(tmp_path), root, "marts", SETTINGS, merge=True)
    assert Warehouse(spark, root).read("marts", "mart_visit_responses").count() == whole["responses"].count()
