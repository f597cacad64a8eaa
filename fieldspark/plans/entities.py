"""What each staging table holds, declared as data.

An entity lists its output columns with the cleaning rule of each, the references it
checks, and the raw column that orders versions of one row. ``plans.staging`` turns an
entity into DataFrame steps; ``plans.quality`` derives its checks from it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldspark.functions import casts, dates, text
from fieldspark.operators.keys import NullPolicy


@dataclass(frozen=True)
class Settings:
    """Run settings: ``as_of`` fixes today; ``id_type`` widens ids beyond 2^31 rows."""

    as_of: dates.AsOf = None
    id_type: str = "int"
    strict_ids: bool = True


@dataclass(frozen=True)
class Cleaned:
    """An output column computed from one raw column. A bad value of a ``late`` number fails what reads
    the column; what reads others of the table, like its keys, goes on."""

    name: str
    rule: Callable[[Column, Settings], Column]
    raw: str | None = None
    late: bool = False

    def build(self, settings: Settings) -> Column:
        return self.rule(F.col(self.raw or self.name), settings).alias(self.name)


@dataclass(frozen=True)
class Reference:
    """A foreign key whose validity is flagged. ``required`` keys must not be null;
    ``check_severity`` is the severity of the relationship check."""

    fk: str
    parent: str
    flag: str
    null_fk: NullPolicy = "invalid"
    required: bool = True
    check_severity: str = "error"


@dataclass(frozen=True)
class Entity:
    name: str
    key: str
    version: str
    about: str
    cleaned: tuple[Cleaned, ...]
    output: tuple[str, ...]
    references: tuple[Reference, ...] = ()
    derived: Callable[[Settings], dict[str, Column]] = field(default=lambda settings: {})

    def comments(self) -> dict[str, str]:
        """Descriptions of the key, the references and their flags."""
        described = {self.key: f"Key. {self.about}"}
        for ref in self.references:
            optional = "" if ref.required else "; may be missing"
            described[ref.fk] = f"Reference to {ref.parent}{optional}."
            described[ref.flag] = f"Whether {ref.fk} occurs in {ref.parent}; missing counts as {ref.null_fk}."
        return described


def _plain(rule: Callable[[Column], Column]) -> Callable[..., Cleaned]:
    return lambda name, raw=None: Cleaned(name, lambda c, s: rule(c), raw)


def _id_rule(rule: Callable[..., Column], c: Column, s: Settings) -> Column:
    return rule(c, s.id_type, s.strict_ids)


def _ident(name: str) -> Cleaned:
    return Cleaned(name, partial(_id_rule, casts.ident))


def _optional_ident(name: str) -> Cleaned:
    return Cleaned(name, partial(_id_rule, casts.optional_ident))


def _number(name: str) -> Cleaned:
    return Cleaned(name, lambda c, s: casts.ident(c, "int", s.strict_ids))


def _late_number(name: str) -> Cleaned:
    """For tables that others refer to and that refer to none."""
    return Cleaned(name, lambda c, s: casts.ident(c, "int", s.strict_ids), late=True)


def _imputed(name: str, prefix: str, id_column: str) -> Cleaned:
    def rule(c: Column, s: Settings) -> Column:
        return text.imputed_code(c, prefix, casts.ident(F.col(id_column), s.id_type, s.strict_ids))

    return Cleaned(name, rule)


_label, _text, _code, _category = map(_plain, (text.label, text.text, text.code, text.category))
_date, _time = map(_plain, (dates.mixed_date, dates.time_of_day))
_bool, _real, _float0 = map(_plain, (casts.boolean, casts.real, casts.float_or_zero))


def _campaign_status(settings: Settings) -> dict[str, Column]:
    interval = F.col("campaign_start_date"), F.col("campaign_end_date")
    return {
        "campaign_status": dates.lifecycle_status(*interval, settings.as_of),
        "campaign_is_active_by_date": dates.active_on(*interval, settings.as_of),
    }


# Fixed values below: staged column names and their order, the prefixes of imputed codes
# and the reference flag names.
PROJECT_PREFIX, CAMPAIGN_PREFIX, ROUTE_PREFIX = "PRJ_UNK_", "CPG_UNK_", "RUT_UNK_"

CLIENTS = Entity(
    name="clients",
    key="client_id",
    version="updated_at_sys",
    about="Clients, one row per client; the code is recovered from their projects.",
    cleaned=(
        _ident("client_id"), _text("client_name"), _category("client_country", "country"),
        _text("client_sector", "sector"), _date("created_at"), _date("updated_at_sys"),
    ),
    output=(
        "client_id", "client_code", "client_name", "client_country", "client_sector",
        "is_client_billable", "is_active", "created_at", "updated_at_sys",
    ),
    derived=lambda settings: {"is_client_billable": F.lit(False), "is_active": F.lit(False)},
)

PROJECTS = Entity(
    name="projects",
    key="project_id",
    version="updated_at_sys",
    about="Projects of clients; missing codes are filled in visibly.",
    cleaned=(
        _ident("project_id"), _text("project_name"),
        _imputed("project_code", PROJECT_PREFIX, "project_id"),
        _ident("client_id"), _code("client_code"), _bool("project_exportable"),
        _date("created_at"), _date("updated_at_sys"),
    ),
    output=(
        "project_id", "project_name", "project_code", "client_id", "client_code",
        "project_exportable", "fk_client_id_valid", "created_at", "updated_at_sys",
    ),
    references=(Reference("client_id", "clients", "fk_client_id_valid"),),
)

CAMPAIGNS = Entity(
    name="campaigns",
    key="campaign_id",
    version="updated_at_sys",
    about="Campaigns with their dates and the status that follows from them.",
    cleaned=(
        _ident("campaign_id"), _imputed("campaign_code", CAMPAIGN_PREFIX, "campaign_id"),
        _label("campaign_name"), _ident("project_id"), _date("campaign_start_date"),
        _date("campaign_end_date"), _text("campaign_state"), _float0("visit_duration_minutes"),
        _code("client_code"), _imputed("project_code", PROJECT_PREFIX, "project_id"),
        _bool("is_active"), _date("created_at"), _date("updated_at_sys"),
    ),
    output=(
        "campaign_id", "campaign_code", "campaign_name", "project_id", "campaign_start_date",
        "campaign_end_date", "campaign_state", "campaign_status", "campaign_is_active_by_date",
        "visit_duration_minutes", "client_code", "project_code", "is_active", "created_at",
        "updated_at_sys",
    ),
    derived=_campaign_status,
)

QUESTIONS = Entity(
    name="questions",
    key="question_id",
    version="updated_at_sys",
    about="Form questions of campaigns.",
    cleaned=(
        _ident("question_id"), _ident("campaign_id"), _code("campaign_code"),
        _category("question_code"), _text("question_name"), _category("question_type"),
        _text("question_category"), _number("question_order"), _bool("question_is_highlighted"),
        _bool("image_associated"), _date("created_at"), _date("updated_at_sys"),
    ),
    output=(
        "question_id", "campaign_id", "campaign_code", "question_code", "question_name",
        "question_type", "question_category", "question_order", "question_is_highlighted",
        "image_associated", "fk_campaign_id_valid", "created_at", "updated_at_sys",
    ),
    references=(Reference("campaign_id", "campaigns", "fk_campaign_id_valid"),),
)

WORKERS = Entity(
    name="workers",
    key="employee_id",
    version="updated_at_sys",
    about="Field workers.",
    cleaned=(
        _ident("employee_id"), _text("employee_first_name"), _bool("employee_active_status"),
        _date("employee_hire_date"), _category("employee_address_province"),
        _category("employee_contract_type"), _late_number("company_id"), _date("created_at"),
        _date("updated_at_sys"),
    ),
    output=(
        "employee_id", "employee_first_name", "employee_active_status", "employee_hire_date",
        "employee_address_province", "employee_contract_type", "company_id", "created_at",
        "updated_at_sys",
    ),
)

POS = Entity(
    name="pos",
    key="intervention_point_id",
    version="updated_at",
    about="Points of sale with address and position.",
    cleaned=(
        _ident("intervention_point_id"), _code("intervention_point_code"),
        _label("intervention_point_name"), _text("intervention_point_address"),
        _category("intervention_point_province"), _text("intervention_point_locality"),
        _late_number("intervention_point_postal_code"), _real("intervention_point_latitude"),
        _real("intervention_point_longitude"), _bool("intervention_point_is_active"),
        _date("created_at"), _date("updated_at"),
    ),
    output=(
        "intervention_point_id", "intervention_point_code", "intervention_point_name",
        "intervention_point_address", "intervention_point_province", "intervention_point_locality",
        "intervention_point_postal_code", "intervention_point_latitude",
        "intervention_point_longitude", "intervention_point_is_active", "created_at", "updated_at",
    ),
)

ROUTES = Entity(
    name="routes",
    key="route_id",
    version="updated_at_sys",
    about="Routes of campaigns; missing codes are filled in visibly.",
    cleaned=(
        _ident("route_id"), _imputed("route_code", ROUTE_PREFIX, "route_id"), _text("route_name"),
        _ident("campaign_id"), _code("campaign_code"), _date("route_start_date"),
        _date("route_end_date"), _text("route_status"), _category("delegation_code"),
        _bool("recall_mail_sent"), _date("created_at"), _date("updated_at_sys"),
    ),
    output=(
        "route_id", "route_code", "route_name", "campaign_id", "campaign_code", "route_start_date",
        "route_end_date", "route_status", "delegation_code", "recall_mail_sent",
        "fk_campaign_id_valid", "created_at", "updated_at_sys",
    ),
    references=(Reference("campaign_id", "campaigns", "fk_campaign_id_valid"),),
)

ROUTE_EMPLOYEE = Entity(
    name="route_employee",
    key="route_employee_id",
    version="updated_at",
    about="Assignments of workers to routes; deleted ones are kept with their date.",
    cleaned=(
        _ident("route_employee_id"), _ident("route_id"), _ident("employee_id"),
        _bool("main_employee"), _real("ip_percentage"), _date("created_at"), _date("updated_at"),
        _date("deleted_at"),
    ),
    output=(
        "route_employee_id", "route_id", "employee_id", "main_employee", "ip_percentage",
        "fk_route_id_valid", "fk_employee_id_valid", "created_at", "updated_at", "deleted_at",
    ),
    references=(
        Reference("route_id", "routes", "fk_route_id_valid"),
        Reference("employee_id", "workers", "fk_employee_id_valid"),
    ),
)

VISITS = Entity(
    name="visits",
    key="visit_id",
    version="updated_at_sys",
    about="Visits to points of sale; a visit may have no route.",
    cleaned=(
        _ident("visit_id"), _ident("campaign_id"), _code("campaign_code"), _code("project_code"),
        _ident("intervention_point_id"), _code("intervention_point_code"),
        _optional_ident("route_id"), _category("route_code"), _date("visit_date"),
        _time("visit_time"), _category("visit_status"), _category("visit_type"),
        _bool("is_client_billable"), _date("created_at"), _date("updated_at_sys"),
    ),
    output=(
        "visit_id", "campaign_id", "campaign_code", "project_code", "intervention_point_id",
        "intervention_point_code", "route_id", "route_code", "visit_date", "visit_time",
        "visit_status", "visit_type", "is_client_billable", "fk_campaign_id_valid",
        "fk_intervention_point_id_valid", "fk_route_id_valid", "created_at", "updated_at_sys",
    ),
    references=(
        Reference("campaign_id", "campaigns", "fk_campaign_id_valid"),
        Reference("intervention_point_id", "pos", "fk_intervention_point_id_valid"),
        Reference(
            "route_id", "routes", "fk_route_id_valid",
            null_fk="valid", required=False, check_severity="warn",
        ),
    ),
)

RESPONSES = Entity(
    name="responses",
    key="answer_id",
    version="updated_at_sys",
    about="Answers given during visits; the answer text is only trimmed.",
    cleaned=(
        _ident("answer_id"), _ident("visit_id"), _optional_ident("question_id"),
        _code("campaign_code"), _code("intervention_point_code"), _category("question_type"),
        _text("answer"), _text("expected_answer"), _date("created_at"), _date("updated_at_sys"),
    ),
    output=(
        "answer_id", "visit_id", "question_id", "campaign_code", "intervention_point_code",
        "question_type", "answer", "expected_answer", "fk_visit_id_valid", "fk_question_id_valid",
        "created_at", "updated_at_sys",
    ),
    references=(
        Reference("visit_id", "visits", "fk_visit_id_valid"),
        Reference("question_id", "questions", "fk_question_id_valid", required=False),
    ),
)

# Parents come before the tables that refer to them.
ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in (
        CLIENTS, PROJECTS, CAMPAIGNS, QUESTIONS, WORKERS, POS, ROUTES, ROUTE_EMPLOYEE, VISITS, RESPONSES,
    )
}
