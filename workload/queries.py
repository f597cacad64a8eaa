"""Registered queries: each runs a part of the engine over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.functions import casts, dates, text
from fieldspark.functions.metrics import distinct_when, rate, sorted_text
from fieldspark.operators import checks as ck
from fieldspark.operators import history, profile
from fieldspark.operators.assignment import primary_assignment
from fieldspark.operators.frequent import frequent_values
from fieldspark.operators.group_quantiles import group_outliers, group_quantiles
from fieldspark.operators.keys import highest_per_key, key_set
from fieldspark.operators.profile_state import ProfileState
from fieldspark.plans import describe, kpis, marts, quality
from fieldspark.plans.entities import ENTITIES, ROUTE_PREFIX, Settings
from fieldspark.plans.increments import merged
from fieldspark.plans.job import (
    MARTS, build_facts, build_marts, build_staging, responses_from_facts, responses_in_steps, staging_checks, write_together,
)
from fieldspark.plans.quality import mart_model
from fieldspark.plans.staging import StagedTables, cleaned_latest, raw_keys, stage
from fieldspark.sources.tables import Warehouse, kept_rows, scratch_warehouse, session_warehouse
from workload.oracle import AS_OF
from workload.raw_tables import RawTables, given, raw_table

Query = Callable[[SparkSession, str], DataFrame]

# The given tables have 64-bit keys; the engine's default is 32-bit.
SETTINGS = Settings(as_of=AS_OF, id_type="bigint")
REGISTRY: dict[str, Query] = {}


def _id(name: str):
    return casts.ident(F.col(name), "bigint")


def _id_text(value):
    return casts.ident(value, "bigint")


def _query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _over_raw(name: str, table: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    REGISTRY[name] = lambda spark, sf_dir: fn(raw_table(spark, sf_dir, table))


def _staged(spark: SparkSession, sf_dir: str) -> StagedTables:
    return StagedTables(RawTables(spark, sf_dir), SETTINGS)


def _over_staged(name: str, fn: Callable[[Mapping[str, DataFrame]], DataFrame]) -> None:
    REGISTRY[name] = lambda spark, sf_dir: fn(_staged(spark, sf_dir))


def _written(house: Warehouse, spark: SparkSession, sf_dir: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Staging tables written once, as in the job, for what reads them many times."""
    return build_staging(RawTables(spark, sf_dir), house, SETTINGS, list(names))


def _over_written(name: str, needed: Iterable[str], fn: Callable[[Mapping[str, DataFrame]], DataFrame]) -> None:
    """A query on staging tables that it reads several times each."""
    REGISTRY[name] = lambda spark, sf_dir: fn(_written(session_warehouse(spark), spark, sf_dir, needed))


# Staging tables that the marts read.
PERFORMANCE = ("clients", "projects", "campaigns", "workers", "routes", "route_employee", "visits")
ANSWERS = ("clients", "projects", "campaigns", "questions", "workers", "route_employee", "visits", "responses")


# --- column functions -------------------------------------------------------------------

_over_raw("clean_text", "pos", lambda raw: raw.select(
    _id("intervention_point_id").alias("point"),
    text.label(F.col("intervention_point_address")).alias("label_form"),
    text.text(F.col("intervention_point_address")).alias("text_form"),
    text.code(F.col("intervention_point_address")).alias("code_form"),
    text.category(F.col("intervention_point_province")).alias("category_form"),
))
_over_raw("strict_casts", "route_employee", lambda raw: raw.select(
    _id("route_employee_id").alias("assignment"),
    _id("employee_id").alias("employee"),
    casts.boolean(F.col("main_employee")).alias("main"),
    casts.real(F.col("ip_percentage")).alias("share"),
    casts.float_or_zero(F.col("ip_percentage")).alias("share_or_zero"),
    _id_text(F.concat(F.trim("employee_id"), F.lit(".5"))).alias("half"),
    _id("route_id").cast("string").alias("route_text"),
))
_over_raw("optional_ids", "responses", lambda raw: raw.select(
    _id("answer_id").alias("answer"),
    casts.optional_ident(F.col("question_id"), "bigint").alias("question"),
))
_over_raw("mixed_dates", "visits", lambda raw: raw.select(
    _id("visit_id").alias("visit"),
    dates.mixed_date(F.col("visit_date")).alias("day"),
    dates.mixed_timestamp(F.col("updated_at_sys")).alias("version"),
    dates.date_shape(F.col("visit_date")).alias("shape"),
))
_over_raw("time_of_day", "visits", lambda raw: raw.select(
    _id("visit_id").alias("visit"), dates.time_of_day(F.col("visit_time")).alias("clock"),
))
_over_raw("imputed_codes", "routes", lambda raw: raw.select(
    _id("route_id").alias("route"),
    text.imputed_code(F.col("route_code"), ROUTE_PREFIX, _id("route_id")).alias("code"),
))


@_query
def event_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return given(spark, sf_dir, "events").select(
        "event_id",
        dates.mixed_date(moment).alias("day"),
        dates.mixed_timestamp(moment).alias("moment"),
        dates.time_of_day(F.date_format("ts", "HH:mm:ss")).alias("clock"),
    )


@_query
def lifecycle_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    campaigns = stage("campaigns", raw_table(spark, sf_dir, "campaigns"), settings=SETTINGS)
    state = dates.effective_state(F.col("campaign_state"), F.col("campaign_end_date"), AS_OF)
    return campaigns.select(
        "campaign_id", "campaign_status", "campaign_is_active_by_date", state.alias("effective_state")
    )


# --- operators --------------------------------------------------------------------------


@_query
def defaults_after_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = (
        given(spark, sf_dir, "orders")
        .where(F.col("o_orderstatus") == "F")
        .groupBy("o_custkey")
        .agg(F.count("o_orderkey").alias("closed_visits"), F.max("o_orderpriority").alias("priority"))
    )
    joined = given(spark, sf_dir, "customer").join(closed, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.fillna(0, ["closed_visits"]).fillna("", ["priority"]).select(
        F.col("c_custkey").alias("campaign"), "closed_visits", "priority",
        F.lit(False).alias("is_client_billable"),
    )


_over_raw(
    "latest_versions", "responses", lambda raw: cleaned_latest(raw, ENTITIES["responses"], SETTINGS)
)
_over_raw("distinct_keys", "responses", lambda raw: key_set(raw, _id("visit_id"), "visit_id"))
_over_raw("code_recovery", "projects", lambda raw: highest_per_key(
    raw, _id("client_id"), text.category(F.col("client_code")), "client_id", "client_code"
))


def _register_flag(name: str, entity: str, fk: str) -> None:
    columns = [ENTITIES[entity].key, fk, f"fk_{fk}_valid"]
    _over_staged(name, lambda t: t[entity].select(*columns))


_register_flag("fk_flag", "route_employee", "employee_id")
_register_flag("fk_flag_null_valid", "visits", "route_id")
_register_flag("fk_flag_null_invalid", "responses", "question_id")


@_query
def distinct_conditional_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    missed = text.category(F.col("visit_status")) == "NOVIS"
    return raw_table(spark, sf_dir, "visits").groupBy(_id("campaign_id").alias("campaign")).agg(
        F.count_distinct("visit_id").alias("visits"),
        distinct_when(missed, F.col("visit_id")).alias("not_visited"),
    )


@_query
def distinct_sorted_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = raw_table(spark, sf_dir, "route_employee").select(
        _id("route_id").alias("route"), _id("employee_id").cast("string").alias("employee")
    ).distinct()
    return pairs.groupBy("route").agg(sorted_text(F.collect_list("employee")).alias("workers"))


@_query
def safe_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_campaign = given(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count("o_orderkey").alias("visits"), F.count_if(F.col("o_orderstatus") == "F").alias("closed")
    )
    customers = given(spark, sf_dir, "customer").select(F.col("c_custkey").alias("campaign"))
    joined = customers.join(per_campaign, F.col("campaign") == F.col("o_custkey"), "left")
    return joined.select("campaign", rate(F.col("closed"), F.col("visits")).alias("closed_rate"))


@_query
def union_and_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"))
    suppliers = given(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    missing = spark.range(1).select(F.lit(None).cast("bigint").alias("id"))
    return orders.unionByName(suppliers).unionByName(missing).where(F.col("id") == 1)


_over_staged("primary_assignment", lambda t: primary_assignment(t["route_employee"]))
_over_written("dual_path_lookup", PERFORMANCE, lambda t: marts.campaign_performance(t).select(
    "campaign_id", "project_id", "project_name", "client_id", "client_name"
))
_over_staged("bridge_workers", lambda t: marts.worker_lists(t["routes"], t["route_employee"], t["workers"]))
_over_staged("route_counts", lambda t: marts.route_counts(t["routes"], t["visits"]))

# --- staging tables and marts -----------------------------------------------------------

for _name in ENTITIES:
    _over_staged(f"stg_{_name}", lambda t, name=_name: t[name])
_over_written("mart_campaign_performance", PERFORMANCE, marts.campaign_performance)


@_query
def mart_visit_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The response mart, built in steps on written staging."""
    house = session_warehouse(spark)
    return responses_in_steps(house, _written(house, spark, sf_dir, ANSWERS), "staging/parts")


@_query
def mart_visit_responses_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The response mart from facts bucketed by visit."""
    house = session_warehouse(spark)
    tables = _written(house, spark, sf_dir, ANSWERS)
    build_facts(house, tables, buckets=16)
    return responses_from_facts(house, tables)


def _with_parents(name: str) -> set[str]:
    return {name}.union(*[_with_parents(ref.parent) for ref in ENTITIES[name].references])


def _over_increments(name: str) -> None:
    """A staging table after merging the rows created before a day, then the others."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw, made = RawTables(spark, sf_dir), F.coalesce(F.col("created_at") < "1997-06-01", F.lit(False))
        needed = _with_parents(name) | ({"projects"} if name == "clients" else set())
        parts = [{n: raw[n].where(p) for n in needed} for p in (made, ~made)]
        return merged(session_warehouse(spark), parts, SETTINGS, buckets=8).read(name)

    REGISTRY[f"stg_{name}_incremental"] = query


for _name in ("clients", "visits", "responses"):
    _over_increments(_name)

# --- KPIs -------------------------------------------------------------------------------


def _over_performance(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    _over_written(name, PERFORMANCE, lambda t: fn(marts.campaign_performance(t)))


def _over_worker_status(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    _over_staged(name, lambda t: fn(kpis.worker_status(t["visits"], t["route_employee"], t["workers"])))


_over_performance("kpi_portfolio_totals", kpis.portfolio_totals)
_over_performance("kpi_state_totals", lambda p: kpis.state_totals(p, AS_OF))
_over_performance("kpi_active_campaigns", lambda p: kpis.active_campaigns(p, AS_OF))
_over_performance("kpi_active_by_start_month", lambda p: kpis.active_by_start_month(p, AS_OF))
_over_performance("kpi_portfolio_rollup", kpis.portfolio_rollup)
_over_staged("kpi_active_workers", lambda t: kpis.active_workers(t["workers"]))
_over_worker_status("kpi_worker_status", lambda s: s)
_over_worker_status("kpi_worker_selection", lambda s: kpis.of_worker(s, "Nombre 7"))
_over_worker_status("kpi_unassigned_visits", kpis.unassigned_visits)
_over_worker_status("kpi_worker_load", kpis.worker_load)

# --- checks and profiles ----------------------------------------------------------------


def _models(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {quality.staging_model(n): tables[n] for n in tables}


def _of_type(kind: type) -> list[ck.Check]:
    return [c for c in quality.STAGING_CHECKS if isinstance(c, kind)]


# One aggregation or one grouping per table: nothing is read twice, so nothing is written.
_over_staged("check_not_null", lambda t: ck.run_checks(_models(t), _of_type(ck.NotNull)))
_over_staged("check_unique", lambda t: ck.run_checks(_models(t), _of_type(ck.Unique)))
_over_staged("check_invalid_shares", lambda t: ck.run_checks(_models(t), quality.share_checks(0.1)))
_over_staged("check_domains", lambda t: ck.run_checks(
    _models({n: t[n] for n in ("visits", "questions", "campaigns", "projects", "clients", "routes")}),
    quality.DOMAIN_CHECKS,
))


@_query
def check_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only keys are asked for: children are reduced to them when written, without flags; entities that
    are only referred to give their raw keys, which are those of the staged table."""
    declared, raw = _of_type(ck.Relationships), RawTables(spark, sf_dir)
    with scratch_warehouse(spark) as house:
        names = {quality.staging_model(n): n for n in ENTITIES}
        columns: dict[str, set[str]] = {}
        for check in declared:
            columns.setdefault(names[check.model], set()).add(check.column)
        parents = {names[c.parent] for c in declared}
        made = {
            n: partial(lambda n: cleaned_latest(raw[n], ENTITIES[n], SETTINGS).select(ENTITIES[n].key, *sorted(columns[n])), n)
            for n in columns
        } | {n: partial(lambda n: raw_keys(n, raw[n], SETTINGS), n) for n in parents - set(columns)}
        return kept_rows(ck.run_checks(_models(write_together(house, "keys", made)), declared))


@_query
def check_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of the marts against the staging tables that these are built on. Other parents, like points
    of sale, give their raw keys to the flags, as for the marts by themselves."""
    with scratch_warehouse(spark) as house:
        tables = _written(house, spark, sf_dir, {*PERFORMANCE, *ANSWERS})
        build_marts(house, tables)
        written = {mart_model(n): house.read("marts", mart_model(n)) for n in MARTS}
        return kept_rows(ck.run_checks({**_models(tables), **written}, quality.MART_CHECKS))


@_query
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch_warehouse(spark) as house:
        models = _models(_written(house, spark, sf_dir, ENTITIES))
        return kept_rows(quality.quality_report(models, staging_checks(), exact=True))


@_query
def check_raw_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks on raw tables, where they do find failures."""
    tables = {f"raw_{n}": raw_table(spark, sf_dir, n) for n in ("visits", "responses")}
    return ck.run_checks(tables, [
        ck.NotNull(model="raw_visits", column="route_id"),
        ck.Unique(model="raw_visits", column="visit_id"),
        ck.Unique(model="raw_responses", column="answer_id", severity=ck.WARN),
        ck.Relationships(
            model="raw_responses", column="visit_id", parent="raw_visits", parent_column="visit_id"
        ),
    ])


def _raw_checks() -> list[ck.Check]:
    return [
        ck.NotNull(model="raw_visits", column="route_id"),
        ck.Unique(model="raw_visits", column="visit_id"),
        ck.Unique(model="raw_responses", column="answer_id", severity=ck.WARN),
        ck.Relationships(model="raw_responses", column="visit_id", parent="raw_visits", parent_column="visit_id"),
    ]


@_query
def check_failing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value that fails a check on raw tables, with its rows."""
    tables = {f"raw_{n}": raw_table(spark, sf_dir, n) for n in ("visits", "responses")}
    return ck.failing_rows(tables, _raw_checks())


@_query
def check_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks on the raw tables as they were on a day, and on all of them, held against each other."""
    house = session_warehouse(spark)
    tables = {f"raw_{n}": raw_table(spark, sf_dir, n) for n in ("visits", "responses")}
    then = {n: df.where("created_at < '1997-06-01'") for n, df in tables.items()}
    for run_id, ran_at, some in (("one", "1997-06-01 00:00:00", then), ("two", "1998-12-31 00:00:00", tables)):
        log = house.append("checks", "history", history.of_run(ck.run_checks(some, _raw_checks()), run_id, ran_at))
    return history.changes(log)


@_query
def check_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = [ck.NoOutliers(model="events", column="value", severity=ck.WARN)]
    return ck.run_checks({"events": given(spark, sf_dir, "events")}, declared)


def _date_columns(raw: DataFrame) -> list[str]:
    return [c for c in raw.columns if c.endswith("_date") or c.endswith("_at") or c.endswith("_sys")]


_over_raw("profile_nulls", "visits", profile.null_counts)
_over_raw("profile_cardinality", "visits", lambda raw: profile.cardinalities(raw, raw.columns))
_over_raw("profile_distribution", "visits", lambda raw: profile.value_counts(raw, raw.columns))
_over_raw("profile_top_values", "responses", lambda raw: profile.top_values(
    raw, ["question_id", "question_type"]
).withColumn("value_rank", F.col("value_rank").cast("int")))
_over_raw("profile_frequent_values", "responses", lambda raw: frequent_values(raw, raw.columns, 20))
_over_raw("profile_dates", "campaigns", lambda raw: profile.date_profile(raw, _date_columns(raw)))


@_query
def data_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions of the staging tables as the catalog has them, with rows and nulls of each column."""
    house = session_warehouse(spark)
    _written(house, spark, sf_dir, ENTITIES)
    names = [house.register("staging", quality.staging_model(n), e.about) for n, e in ENTITIES.items()]
    return describe.data_dictionary(spark, names)


@_query
def profile_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = profile.quantiles(given(spark, sf_dir, "lineitem"), "l_extendedprice")
    return summary.withColumn("mean", F.round("mean", 2))


@_query
def profile_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.outliers(given(spark, sf_dir, "events"), "value").select("event_id", "event_type", "value")


@_query
def profile_group_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles of prices by supplier, and of all rows of the open line status as one hot group."""
    lines = given(spark, sf_dir, "lineitem")
    keyed = lines.withColumn("supplier", F.when(F.col("l_linestatus") != "O", F.col("l_suppkey")))
    return group_quantiles(keyed, "supplier", "l_extendedprice")


@_query
def profile_group_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose value is an outlier among those of its type."""
    return group_outliers(given(spark, sf_dir, "events"), "event_type", "value").select("event_id", "event_type", "value")


@_query
def profile_merged_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of orders by month, of which those up to a day were taken in first, and whether its
    estimates of different values are within their error."""
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
    orders = given(spark, sf_dir, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    state = ProfileState(session_warehouse(spark), "orders")
    state.add(orders.where("o_orderdate < '1995-01-01'"), "month", columns)
    state.add(orders, "month", columns)
    exact = profile.cardinalities(orders, columns)
    near = F.abs(F.col("distinct_values") - F.col("distinct_count")) <= F.col("distinct_error") * F.col("distinct_count")
    return state.report().join(exact, "column_name").select(
        "column_name", "parts", "row_count", "null_count", "least", "most", near.alias("distinct_within_error")
    )


@_query
def profile_inverted_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    campaigns = stage("campaigns", raw_table(spark, sf_dir, "campaigns"), settings=SETTINGS)
    start, end = F.col("campaign_start_date"), F.col("campaign_end_date")
    return profile.inverted_intervals(campaigns, start, end).select(
        "campaign_id", "campaign_start_date", "campaign_end_date"
    )
