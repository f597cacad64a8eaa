"""Business marts over the staging tables.

Both marts rely on staging for one row per key. Facts are aggregated before they are
joined, so no join multiplies visits by assignments; dimension attributes reach the
response mart through the smaller visit side, and responses are shuffled at most once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.functions.metrics import DONE_STATUSES, INCIDENT, NOT_VISITED, rate, sorted_text
from fieldspark.operators.assignment import distinct_assignments, primary_assignment
from fieldspark.operators.lookup import ROWS, lookup
from fieldspark.plans.describe import described
from fieldspark.sources.buckets import BucketedTable

Tables = Mapping[str, DataFrame]

# Mart columns, in order.
CAMPAIGN_PERFORMANCE = (
    "campaign_id", "campaign_name", "project_id", "project_name", "client_id", "client_name",
    "campaign_start_date", "campaign_end_date", "campaign_state", "is_active", "campaign_status",
    "campaign_is_active_by_date", "total_visits", "completed_visits", "not_visited_visits",
    "incid_visits", "routes_total", "routes_with_visits", "workers_assigned",
    "main_workers_assigned", "worker_ids", "worker_names", "completion_rate",
    "route_execution_rate", "incidence_rate",
)
VISIT_RESPONSES = (
    "answer_id", "visit_id", "question_id", "campaign_id", "project_id", "project_name",
    "client_id", "client_name", "campaign_name", "intervention_point_id", "route_id",
    "employee_id", "employee_name", "is_main_employee", "workers_assigned_count",
    "employee_active_status", "employee_contract_type", "employee_address_province",
    "visit_date", "visit_time", "visit_status", "visit_type", "is_client_billable",
    "question_name", "question_category", "question_order", "question_is_highlighted",
    "image_associated", "question_type", "answer", "expected_answer", "fk_visit_id_valid",
    "fk_question_id_valid", "created_at", "updated_at_sys",
)

CAMPAIGN_COMMENTS = {
    "campaign_id": "Key: one row per campaign, for business KPIs.",
    "completion_rate": "Completed visits over recorded visits.",
    "route_execution_rate": "Routes with a visit over all routes.",
    "incidence_rate": "Visits with an incidence over recorded visits.",
}
RESPONSE_COMMENTS = {
    "answer_id": "Key: one row per answer, flat for BI.",
    "visit_id": "Visit of the answer.",
    "question_id": "Question of the answer; may be missing.",
    "employee_id": "Primary worker of the visit's route.",
}


def _renamed(df: DataFrame, **names: str) -> DataFrame:
    """Keep some columns under new names, given as ``new=old``."""
    return df.select(*[F.col(old).alias(new) for new, old in names.items()])


def _projects_by_id(projects: DataFrame) -> DataFrame:
    return _renamed(
        projects, by_id_project_id="project_id", by_id_project_name="project_name",
        by_id_client_id="client_id",
    )


def _projects_by_code(projects: DataFrame) -> DataFrame:
    return _renamed(
        projects, by_code_key="project_code", by_code_project_id="project_id",
        by_code_project_name="project_name", by_code_client_id="client_id",
    )


def _clients_by_id(clients: DataFrame) -> DataFrame:
    return _renamed(clients, client_by_id="client_id", client_by_id_name="client_name")


def _clients_by_code(clients: DataFrame) -> DataFrame:
    return _renamed(
        clients, client_by_code_key="client_code", client_by_code="client_id",
        client_by_code_name="client_name",
    )


def _project_client_id():
    return F.coalesce("by_id_client_id", "by_code_client_id")


def visit_counts(visits: DataFrame) -> DataFrame:
    """Visits per campaign by outcome. Visit ids are unique, so plain counts are distinct counts."""
    status, visit = F.col("visit_status"), F.col("visit_id")
    return visits.groupBy(F.col("campaign_id").alias("visits_of")).agg(
        F.count(visit).alias("total_visits"),
        F.count(F.when(status.isin(*DONE_STATUSES), visit)).alias("completed_visits"),
        F.count(F.when(status == NOT_VISITED, visit)).alias("not_visited_visits"),
        F.count(F.when(status == INCIDENT, visit)).alias("incid_visits"),
    )


def route_counts(routes: DataFrame, visits: DataFrame) -> DataFrame:
    """Routes per campaign, and those visited at least once (by any campaign's visit)."""
    visited = visits.select(F.col("route_id").alias("visited_id")).where("visited_id IS NOT NULL").distinct()
    return (
        routes.select("campaign_id", "route_id")
        .join(visited, F.col("route_id") == F.col("visited_id"), "left")
        .groupBy(F.col("campaign_id").alias("routes_of"))
        .agg(
            F.count("route_id").alias("routes_total"),
            F.count("visited_id").alias("routes_with_visits"),
        )
    )


def worker_lists(routes: DataFrame, bridge: DataFrame, workers: DataFrame) -> DataFrame:
    """Workers per campaign: counts and sorted lists. Assignments collapse to one row per
    (campaign, worker) first, so a list never holds more than the distinct workers."""
    route = _renamed(routes, workers_of="campaign_id", assigned_route="route_id")
    assigned = lookup(
        distinct_assignments(bridge), route, "route_id", "assigned_route", how="inner",
        hot_from=bridge, spread_by=["employee_id"],
    )
    per_worker = assigned.groupBy("workers_of", "employee_id").agg(
        F.bool_or("main_employee").alias("is_main")
    )
    names = _renamed(workers, worker_key="employee_id", first_name="employee_first_name")
    named = lookup(
        per_worker, names, "employee_id", "worker_key", hot_from=bridge, spread_by=["workers_of"]
    )
    employee = F.col("employee_id")
    return named.groupBy("workers_of").agg(
        F.count(employee).alias("workers_assigned"),
        F.count(F.when(F.col("is_main"), employee)).alias("main_workers_assigned"),
        sorted_text(F.collect_list(employee.cast("string"))).alias("worker_ids"),
        sorted_text(F.collect_set("first_name")).alias("worker_names"),
    )


def _of_campaigns(routes: DataFrame, campaigns: DataFrame) -> DataFrame:
    """The routes of known campaigns: lists of others would be made in vain."""
    return routes.join(campaigns.select("campaign_id"), "campaign_id", "left_semi")


def campaign_performance(t: Tables) -> DataFrame:
    """One row per campaign: owner, dates, visit counts, routes, workers and rates."""
    owned = lookup(
        t["campaigns"], _projects_by_id(t["projects"]), "project_id", "by_id_project_id",
        hot_from=t["campaigns"], spread_by=["campaign_id"], keep_key=True,
    )
    owned = lookup(
        owned, _projects_by_code(t["projects"]), "project_code", "by_code_key",
        hot_from=t["campaigns"], spread_by=["campaign_id"],
    ).withColumn("project_client_id", _project_client_id())

    def client_weights() -> DataFrame:
        """Campaigns of each client, from counts by project: the joins above are not run again."""
        counted = t["campaigns"].groupBy("project_id", "project_code").agg(F.count(F.lit(1)).alias(ROWS))
        by_id, by_code = _projects_by_id(t["projects"]), _projects_by_code(t["projects"])
        weighed = counted.join(by_id, F.col("project_id") == F.col("by_id_project_id"), "left")
        weighed = weighed.join(by_code, F.col("project_code") == F.col("by_code_key"), "left")
        return weighed.select(_project_client_id().alias("project_client_id"), ROWS)

    owned = lookup(
        owned, _clients_by_id(t["clients"]), "project_client_id", "client_by_id",
        hot_from=client_weights, spread_by=["campaign_id"],
    ).withColumnRenamed("client_code", "campaign_client_code")
    owned = lookup(
        owned, _clients_by_code(t["clients"]), "campaign_client_code", "client_by_code_key",
        hot_from=t["campaigns"].select(F.col("client_code").alias("campaign_client_code")), spread_by=["campaign_id"],
    )

    # Both uses of the routes ask for the same rows, so a lazy plan shares their shuffle.
    routes = t["routes"].where(F.col("route_id").isNotNull())

    def same_campaign(other: str):
        return F.col("campaign_id") == F.col(other)

    joined = (
        owned.join(visit_counts(t["visits"]), same_campaign("visits_of"), "left")
        .join(route_counts(routes, t["visits"]), same_campaign("routes_of"), "left")
        .join(
            worker_lists(_of_campaigns(routes, t["campaigns"]), t["route_employee"], t["workers"]),
            same_campaign("workers_of"), "left",
        )
    )
    counts = [c for c in CAMPAIGN_PERFORMANCE if c.endswith(("_visits", "_total", "_assigned"))]
    filled = joined.fillna(0, counts).fillna("", ["worker_ids", "worker_names"])
    return filled.withColumns(
        {
            "project_id": F.coalesce("by_id_project_id", "by_code_project_id", "project_id"),
            "project_name": F.coalesce("by_id_project_name", "by_code_project_name"),
            "client_id": F.coalesce("project_client_id", "client_by_code"),
            "client_name": F.coalesce("client_by_id_name", "client_by_code_name"),
            "completion_rate": rate(F.col("completed_visits"), F.col("total_visits")),
            "route_execution_rate": rate(F.col("routes_with_visits"), F.col("routes_total")),
            "incidence_rate": rate(F.col("incid_visits"), F.col("total_visits")),
        }
    ).select(*described(CAMPAIGN_PERFORMANCE, CAMPAIGN_COMMENTS))


def _campaign_owners(t: Tables) -> DataFrame:
    """Campaigns with the project found by id and the client found by code."""
    campaigns = _renamed(
        t["campaigns"], owner_campaign_id="campaign_id", campaign_name="campaign_name",
        campaign_project_id="project_id", campaign_project_code="project_code",
        campaign_client_code="client_code",
    )
    by_id = lookup(
        campaigns, _projects_by_id(t["projects"]), "campaign_project_id", "by_id_project_id",
        hot_from=campaigns, spread_by=["owner_campaign_id"],
    )
    return lookup(
        by_id, _clients_by_code(t["clients"]), "campaign_client_code", "client_by_code_key",
        hot_from=campaigns, spread_by=["owner_campaign_id"],
    )


def _route_workers(t: Tables) -> DataFrame:
    """The primary worker of each route with their attributes."""
    primary = _renamed(
        primary_assignment(t["route_employee"]), worker_route_id="route_id",
        employee_id="employee_id", is_main_employee="main_employee",
        workers_assigned_count="workers_assigned_count",
    )
    workers = _renamed(
        t["workers"], worker_key="employee_id", employee_name="employee_first_name",
        employee_active_status="employee_active_status",
        employee_contract_type="employee_contract_type",
        employee_address_province="employee_address_province",
    )
    return lookup(
        primary, workers, "employee_id", "worker_key", hot_from=primary, spread_by=["worker_route_id"]
    )


def response_parts(t: Tables) -> dict[str, DataFrame]:
    """The joined sides that visits look up. Written, they have a known size and are made once."""
    return {"campaign_owners": _campaign_owners(t), "route_workers": _route_workers(t)}


def visit_details(t: Tables, parts: Tables | None = None) -> DataFrame:
    """Visits with campaign, project, client and primary worker, keyed by ``detail_visit_id``. With
    ``parts`` (written ``response_parts``) nothing but the visits is left to join."""
    visits = t["visits"].select(
        F.col("visit_id").alias("detail_visit_id"), "campaign_id",
        F.col("project_code").alias("visit_project_code"), "intervention_point_id", "route_id",
        "visit_date", "visit_time", "visit_status", "visit_type", "is_client_billable",
    )
    spread = {"hot_from": t["visits"], "spread_by": ["detail_visit_id"]}
    owners, workers = (parts["campaign_owners"], parts["route_workers"]) if parts else (_campaign_owners(t), _route_workers(t))
    df = lookup(
        visits, owners, "campaign_id", "owner_campaign_id",
        sized_by=None if parts else [t["campaigns"], t["projects"], t["clients"]], **spread,
    ).withColumn("any_project_code", F.coalesce("campaign_project_code", "visit_project_code"))

    def project_weights() -> DataFrame:
        """Visits of each project code, from counts by campaign: visits are not joined again to count."""
        counted = t["visits"].groupBy("campaign_id", "project_code").agg(F.count(F.lit(1)).alias(ROWS))
        weighed = counted.join(owners, F.col("campaign_id") == F.col("owner_campaign_id"), "left")
        return weighed.withColumn("any_project_code", F.coalesce("campaign_project_code", "project_code"))

    def client_weights() -> DataFrame:
        by_code = _projects_by_code(t["projects"])
        weighed = project_weights().join(by_code, F.col("any_project_code") == F.col("by_code_key"), "left")
        return weighed.select(_project_client_id().alias("project_client_id"), ROWS)

    df = lookup(
        df, _projects_by_code(t["projects"]), "any_project_code", "by_code_key",
        hot_from=lambda: project_weights().select("any_project_code", ROWS), spread_by=["detail_visit_id"],
    ).withColumn("project_client_id", _project_client_id())
    df = lookup(
        df, _clients_by_id(t["clients"]), "project_client_id", "client_by_id",
        hot_from=client_weights, spread_by=["detail_visit_id"],
    )
    df = lookup(
        df, workers, "route_id", "worker_route_id",
        sized_by=None if parts else [t["route_employee"], t["workers"]], **spread,
    )
    return df.select(
        "detail_visit_id",
        "campaign_id",
        F.coalesce("campaign_project_id", "by_code_project_id").alias("project_id"),
        F.coalesce("by_id_project_name", "by_code_project_name").alias("project_name"),
        F.coalesce("project_client_id", "client_by_code").alias("client_id"),
        F.coalesce("client_by_id_name", "client_by_code_name").alias("client_name"),
        "campaign_name", "intervention_point_id", "route_id", "employee_id", "employee_name",
        "is_main_employee", "workers_assigned_count", "employee_active_status",
        "employee_contract_type", "employee_address_province", "visit_date", "visit_time",
        "visit_status", "visit_type", "is_client_billable",
    )


def _answers(responses: DataFrame) -> DataFrame:
    return responses.select(
        "answer_id", "visit_id", "question_id", F.col("question_type").alias("own_question_type"),
        "answer", "expected_answer", "fk_visit_id_valid", "fk_question_id_valid", "created_at",
        "updated_at_sys",
    )


def _asked(t: Tables, answers: DataFrame, responses: DataFrame) -> DataFrame:
    """Answers, of ``responses``, with the attributes of their question."""
    questions = _renamed(
        t["questions"], question_key="question_id", question_name="question_name",
        master_question_type="question_type", question_category="question_category",
        question_order="question_order", question_is_highlighted="question_is_highlighted",
        image_associated="image_associated",
    )
    return lookup(answers, questions, "question_id", "question_key", hot_from=responses, spread_by=["answer_id"])


def _as_mart(full: DataFrame) -> DataFrame:
    return full.withColumns(
        {
            "question_type": F.coalesce("own_question_type", "master_question_type"),
            "workers_assigned_count": F.coalesce("workers_assigned_count", F.lit(0)),
        }
    ).select(*described(VISIT_RESPONSES, RESPONSE_COMMENTS))


def visit_responses(t: Tables, details: DataFrame | None = None) -> DataFrame:
    """One row per answer with its visit, question, owner and primary worker. With ``details`` (written
    ``visit_details``) nothing but answers and questions is left to join."""
    visit_tables = ("visits", "campaigns", "projects", "clients", "route_employee", "workers")
    full = lookup(
        _asked(t, _answers(t["responses"]), t["responses"]), details or visit_details(t), "visit_id", "detail_visit_id",
        sized_by=None if details else [t[n] for n in visit_tables], hot_from=t["responses"], spread_by=["answer_id"],
    )
    return _as_mart(full)


def bucketed_visit_responses(t: Tables, visits: BucketedTable, responses: BucketedTable, details: BucketedTable) -> DataFrame:
    """The same mart from facts bucketed by visit, and the ``visit_details`` of the visits written in these buckets: answers
    meet them bucket by bucket, without a shuffle of either, and then their questions. Answers of hot visits, fewer visits
    than buckets, meet these visits by a broadcast; answers without a visit meet none. Where the questions are too many to
    broadcast, their lookup shuffles the answers once, and nothing else."""
    if (visits.key, responses.key) != ("visit_id", "visit_id") or visits.buckets != responses.buckets:
        raise ValueError("visits and responses must share the buckets of visit_id")
    if (details.key, details.buckets) != ("detail_visit_id", visits.buckets):
        raise ValueError("the details must share the buckets of their visits")
    on = F.col("visit_id") == F.col("detail_visit_id")
    even = _answers(responses.even).join(details.even.hint("merge"), on, "left")
    of_hot = details.even.join(F.broadcast(responses.hot_keys), on, "left_semi")
    hot = _answers(responses.hot).join(F.broadcast(of_hot), on, "left")
    return _as_mart(_asked(t, even, responses.even).unionByName(_asked(t, hot, responses.hot)))
