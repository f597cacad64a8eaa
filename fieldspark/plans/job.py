"""The batch job: raw CSV to staging, marts, KPI tables and check results.

    python -m fieldspark.plans.job --raw DIR --warehouse DIR --select LAYER

Every table is written as Parquet and read back by what builds on it, so each raw file is
parsed once, a lost executor only repeats the table being written, and join planning sees
real table sizes. Tables that do not need each other are written at the same time.
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Callable, Collection, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import cache, partial, reduce

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.operators import history
from fieldspark.operators.checks import Check, enforce, failing_rows, run_checks
from fieldspark.operators.frequent import frequent_values
from fieldspark.plans import kpis, marts
from fieldspark.plans.describe import data_dictionary
from fieldspark.plans.entities import ENTITIES, Settings
from fieldspark.plans.increments import StagingStore
from fieldspark.plans.quality import (
    DOMAIN_CHECKS, MART_CHECKS, OUTLIER_CHECKS, STAGING_CHECKS, mart_model, quality_report, share_checks,
    staging_model,
)
from fieldspark.plans.staging import raw_keys, stage, stage_clients
from fieldspark.sources.buckets import bucket_count, read_bucketed, write_bucketed
from fieldspark.sources.estimates import UNKNOWN, estimated_bytes
from fieldspark.sources.raw_csv import export_csv, export_one_csv, read_raw, read_with_quarantine
from fieldspark.sources.tables import Warehouse, scratch_warehouse, set_for_wide_tables

LAYERS = ("staging", "marts", "kpis", "checks", "checks-staging", "checks-marts", "profile", "all")
MAX_INVALID_SHARE = 0.1
PARALLEL_WRITES = 4
#: Tables made of more bytes than that, as estimated, are written one after the other: one has tasks enough for all
#: executors, and the shuffle files of several would add up.
TOGETHER_BYTES = 256 << 20
#: Values that the profile lists of each column.
TOP_VALUES = 10
MARTS = {
    "campaign_performance": marts.campaign_performance,
    "visit_responses": marts.visit_responses,
}


class RawFiles(Mapping[str, DataFrame]):
    """The raw CSV tables of a folder, read when first used. With ``quarantine`` (a warehouse) malformed
    lines are kept there, up to ``max_malformed`` of a table."""

    def __init__(
        self, spark: SparkSession, folder: str, multi_line: bool = False, min_tasks: int | None = None,
        quarantine: Warehouse | None = None, max_malformed: float = 0.01,
    ) -> None:
        def read(name: str) -> DataFrame:
            if quarantine:
                return read_with_quarantine(quarantine, folder, name, max_malformed, multi_line, min_tasks)
            return read_raw(spark, folder, name, multi_line, min_tasks)

        self._read = cache(read)

    def __getitem__(self, name: str) -> DataFrame:
        return self._read(name)

    def __iter__(self) -> Iterator[str]:
        return iter(ENTITIES)

    def __len__(self) -> int:
        return len(ENTITIES)


def is_large(*sources: DataFrame) -> bool:
    """Whether what is made of these tables is large, as far as their size is known."""
    return TOGETHER_BYTES < sum(size for size in map(estimated_bytes, sources) if size < UNKNOWN)


def write_together(
    house: Warehouse, layer: str, tables: Mapping[str, Callable[[], DataFrame]], large: Collection[str] = ()
) -> dict[str, DataFrame]:
    """Plan and write independent tables at the same time; their Spark jobs share the executors. ``large`` ones are
    written one by one, after the others."""
    small = [n for n in tables if n not in large]
    with ThreadPoolExecutor(max_workers=PARALLEL_WRITES) as pool:
        written = dict(zip(small, pool.map(lambda name: house.write(layer, name, tables[name]()), small)))
    written |= {n: house.write(layer, n, tables[n]()) for n in tables if n in large}
    return {n: written[n] for n in tables}


def build_staging(
    raw: Mapping[str, DataFrame], house: Warehouse, settings: Settings,
    names: Collection[str] = tuple(ENTITIES), layer: str = "staging",
) -> dict[str, DataFrame]:
    """Write staging tables, parents first, and return them by entity name. Large ones are deduplicated and
    flagged in two steps, so that the shuffle files of the first are gone in the second."""
    staged: dict[str, DataFrame] = {}

    def make(name: str, **kept: Callable[[DataFrame], DataFrame]) -> DataFrame:
        if name == "clients":
            return stage_clients(raw["clients"], raw["projects"], settings)
        parents = {ref.parent for ref in ENTITIES[name].references}
        keys = {p: staged[p] if p in staged else raw_keys(p, raw[p], settings) for p in parents}
        return stage(name, raw[name], keys, settings, **kept)

    while waiting := [n for n in ENTITIES if n in names and n not in staged]:
        ready = [n for n in waiting if not any(ref.parent in waiting for ref in ENTITIES[n].references)]
        large = [n for n in ready if ENTITIES[n].references and is_large(raw[n])]
        written = write_together(house, layer, {staging_model(n): partial(make, n) for n in ready if n not in large})
        for name in large:
            with scratch_warehouse(house.spark) as scratch:
                model = staging_model(name)
                written[model] = house.write(layer, model, make(name, kept=partial(scratch.write, "latest", name)))
        staged |= {n: written[staging_model(n)] for n in ready}
    return staged


def present(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The raw tables whose files are there: an increment brings some."""
    found = {}
    for name in ENTITIES:
        try:
            found[name] = raw[name]
        except FileNotFoundError:
            continue
    return found


def read_staging(house: Warehouse, settings: Settings | None = None) -> dict[str, DataFrame]:
    """The staged tables; with ``settings`` those of the store that merges new rows."""
    if settings is not None:
        return StagingStore(house, settings).tables()
    return {name: house.read("staging", staging_model(name)) for name in ENTITIES}


FACTS = ("visits", "responses")


def written_details(house: Warehouse, layer: str, tables: Mapping[str, DataFrame], visits: DataFrame | None = None) -> DataFrame:
    """Write the sides that visits look up, and then the visits with them."""
    parts = marts.response_parts(tables)
    written = write_together(house, layer, {n: partial(parts.__getitem__, n) for n in parts}, parts if is_large(*tables.values()) else ())
    return house.write(layer, "visit_details", marts.visit_details({**tables, "visits": visits or tables["visits"]}, written))


def build_facts(house: Warehouse, tables: Mapping[str, DataFrame], buckets: int | None = None) -> None:
    """Write visits and responses in the same buckets of visits, by default as many as their size asks
    for, and in these buckets the visits with all that they look up."""
    count = buckets or max(bucket_count(tables[n]) for n in FACTS)
    facts = {n: write_bucketed(house, "facts", n, tables[n], "visit_id", count) for n in FACTS}
    with scratch_warehouse(house.spark) as scratch:
        details = written_details(scratch, "facts", tables, facts["visits"].even)
        write_bucketed(house, "facts", "visit_details", details, "detail_visit_id", count)


def responses_from_facts(house: Warehouse, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The response mart from the tables of ``build_facts``."""
    visits, responses = (read_bucketed(house, "facts", n) for n in FACTS)
    return marts.bucketed_visit_responses(tables, visits, responses, read_bucketed(house, "facts", "visit_details"))


def responses_in_steps(house: Warehouse, tables: Mapping[str, DataFrame], layer: str = "parts") -> DataFrame:
    """The response mart, its visits with all that they look up written before the answers meet them: only the files of
    one step's shuffles are there at a time."""
    return marts.visit_responses(tables, written_details(house, layer, tables))


def build_marts(house: Warehouse, tables: Mapping[str, DataFrame], bucketed: bool = False) -> None:
    responses = mart_model("visit_responses")
    made = {mart_model(n): partial(mart, tables) for n, mart in MARTS.items()}
    with scratch_warehouse(house.spark) as scratch:
        made[responses] = partial(responses_from_facts, house, tables) if bucketed else partial(responses_in_steps, scratch, tables)
        write_together(house, "marts", made, made if is_large(*tables.values()) else ())


def build_kpis(house: Warehouse, tables: Mapping[str, DataFrame], settings: Settings) -> None:
    performance = house.read("marts", mart_model("campaign_performance"))
    status = house.write(
        "kpis", "worker_status",
        kpis.worker_status(tables["visits"], tables["route_employee"], tables["workers"]),
    )
    write_together(house, "kpis", {
        "portfolio_totals": partial(kpis.portfolio_totals, performance),
        "state_totals": partial(kpis.state_totals, performance, settings.as_of),
        "active_campaigns": partial(kpis.active_campaigns, performance, settings.as_of),
        "active_by_start_month": partial(kpis.active_by_start_month, performance, settings.as_of),
        "portfolio_rollup": partial(kpis.portfolio_rollup, performance),
        "active_workers": partial(kpis.active_workers, tables["workers"]),
        "unassigned_visits": partial(kpis.unassigned_visits, status),
        "worker_load": partial(kpis.worker_load, status),
    })


def staging_checks() -> list[Check]:
    """Keys and references, and as warnings domains, shares of invalid references and outliers."""
    return [*STAGING_CHECKS, *DOMAIN_CHECKS, *share_checks(MAX_INVALID_SHARE), *OUTLIER_CHECKS]


def profile(house: Warehouse, tables: Mapping[str, DataFrame], exact: bool = False) -> DataFrame:
    """Write the quality report of all staging tables, and the most frequent values of their columns."""
    models = {staging_model(n): df for n, df in tables.items()}
    top = [
        frequent_values(df, df.columns, TOP_VALUES).select(F.lit(m).alias("model"), "*") for m, df in models.items()
    ]
    house.write("profile", "frequent_values", reduce(DataFrame.unionByName, top))
    return house.write("profile", "quality_report", quality_report(models, staging_checks(), exact))


def register(house: Warehouse) -> DataFrame:
    """Declare staging and marts in the catalog with their descriptions, and write the data dictionary."""
    about = {("staging", staging_model(n)): e.about for n, e in ENTITIES.items()}
    about |= {("marts", mart_model(n)): (MARTS[n].__doc__ or "").split("\n")[0] for n in MARTS}
    names = [house.register(layer, name, text) for (layer, name), text in about.items() if house.exists(layer, name)]
    return house.write("catalog", "data_dictionary", data_dictionary(house.spark, names))


def check(
    house: Warehouse, tables: Mapping[str, DataFrame], layer: str = "all", run_id: str | None = None
) -> DataFrame:
    """Run the declared checks on staging, marts or both and keep the results, their history and
    changes, and the values that failed; raise on errors."""
    models = {staging_model(n): df for n, df in tables.items()}
    checks = [] if layer == "marts" else staging_checks()
    if layer != "staging":
        models |= {mart_model(n): house.read("marts", mart_model(n)) for n in MARTS}
        checks += MART_CHECKS
    results = house.write("checks", f"results_{layer}", run_checks(models, checks))
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    log = house.append("checks", "history", history.of_run(results, run_id or uuid.uuid4().hex, now.isoformat(" ")))
    house.write("checks", f"changes_{layer}", history.changes(log).where(F.col("model").isin(*models)))
    failed = {(r.check_name, r.model, r.column_name) for r in results.where("failures > 0").collect()}  # one row a check
    found = failing_rows(models, [c for c in checks if (c.name, c.model, c.column) in failed])
    if found is not None:
        house.write("checks", f"failures_{layer}", found, partition_by=["check_name"])
    enforce(results)
    return results


def run(
    spark: SparkSession, raw_dir: str, warehouse: str, layer: str = "all",
    settings: Settings = Settings(), export_dir: str | None = None, multi_line: bool = False,
    buckets: int | None = None, merge: bool = False, min_tasks: int | None = None,
    max_malformed: float | None = None, exact: bool = False, one_file: bool = False, catalog: bool = False,
) -> None:
    """Build one layer, run the checks, or do everything. In a full run the checks of a layer come
    before what builds on it: errors stop the run there, warnings do not. With ``buckets`` (0: as
    many as their size asks for) the facts are bucketed by visit before the marts. With ``merge`` the
    raw files hold new rows only, which are merged into the stored ones. ``min_tasks`` spreads raw files
    that can't be split. With ``max_malformed`` malformed lines go to quarantine, up to that share of a
    table. ``exact`` profiles count distinct values instead of estimating them. ``one_file``
    exports one CSV file a mart. ``catalog`` declares the tables with their descriptions at the end."""
    set_for_wide_tables(spark)
    house, full = Warehouse(spark, warehouse), layer == "all"
    if full or layer == "staging":
        quarantine = None if max_malformed is None else house
        raw = RawFiles(spark, raw_dir, multi_line, min_tasks, quarantine, max_malformed or 0.0)
        if merge:
            StagingStore(house, settings).merge(present(raw))
        else:
            build_staging(raw, house, settings)
    if layer == "staging":
        if catalog:
            register(house)
        return
    tables = read_staging(house, settings if merge else None)
    if full:
        check(house, tables, "staging")
    if full or layer == "marts":
        if buckets is not None:
            build_facts(house, tables, buckets)
        build_marts(house, tables, buckets is not None)
        if export_dir:
            for name in map(mart_model, MARTS):
                export = export_one_csv if one_file else export_csv
                export(house.read("marts", name), f"{export_dir}/{name}{'.csv' if one_file else ''}")
    if full:
        check(house, tables, "marts")
    if full or layer == "kpis":
        build_kpis(house, tables, settings)
    if full or layer == "profile":
        profile(house, tables, exact)
    if layer.startswith("checks"):
        check(house, tables, layer.removeprefix("checks").lstrip("-") or "all")
    if catalog:
        register(house)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--raw", required=True, help="folder with the raw_<table>.csv files")
    parser.add_argument("--warehouse", required=True, help="shared folder for the tables")
    parser.add_argument("--select", choices=LAYERS, default="all")
    parser.add_argument("--as-of", help="day the date rules use, yyyy-MM-dd; default today")
    parser.add_argument("--id-type", choices=["int", "bigint"], default="int")
    parser.add_argument("--lenient-ids", action="store_true", help="make bad ids null instead of failing")
    parser.add_argument("--multi-line", action="store_true", help="fields may hold line breaks")
    parser.add_argument("--one-file", action="store_true", help="export one CSV file for each mart")
    parser.add_argument("--min-tasks", type=int, help="spread raw files that cannot be split over as many tasks")
    parser.add_argument("--max-malformed", type=float, help="share of malformed lines that go to quarantine; more, or without it any, stop the read")
    parser.add_argument("--exact", action="store_true", help="count distinct values in the profile instead of estimating them")
    parser.add_argument("--catalog", action="store_true", help="declare the tables with their descriptions in the catalog")
    parser.add_argument("--merge", action="store_true", help="the raw files hold new rows; use the store they are merged into")
    parser.add_argument("--buckets", type=int, help="bucket the facts by visit; 0 chooses the number by their size")
    parser.add_argument("--export", help="folder for CSV copies of the marts")
    args = parser.parse_args()
    conf = SparkConf().setIfMissing("spark.app.name", "fieldspark").setIfMissing("spark.ui.enabled", "false")
    spark = SparkSession.builder.config(conf=conf).getOrCreate()
    settings = Settings(as_of=args.as_of, id_type=args.id_type, strict_ids=not args.lenient_ids)
    run(
        spark, args.raw, args.warehouse, args.select, settings, args.export, args.multi_line, args.buckets, args.merge,
        args.min_tasks, args.max_malformed, args.exact, args.one_file, args.catalog,
    )


if __name__ == "__main__":
    main()
