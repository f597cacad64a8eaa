"""Raw field-activity tables derived from the given star-schema tables.

Each raw table is one SELECT over a whole given table, in SQL that Spark and DuckDB share,
with the defects real raw files have: padded and mixed-case codes, blanks, two date
formats, unparseable values, repeated versions, missing and orphan references.

    client = nation key of customers     campaign = customer      route = customer x priority
    project = nation key x segment       question = part          assignment = lineitem
    point of sale = customer             worker = supplier        visit = order, answer = lineitem
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from fieldspark.sources.tables import balanced, set_for_wide_tables

GIVEN_TABLES = ("customer", "supplier", "part", "orders", "lineitem", "events")
ORPHAN = 1_000_000_000  # added to a key to make it point nowhere
#: Bytes of a file that make a task where a scan is redistributed: the cells of raw rows are more than ten times as many.
TASK_BYTES = 4 << 20


def _iso(date: str) -> str:
    return f"CAST({date} AS STRING)"


def _day_first(date: str) -> str:
    iso = _iso(date)
    return f"substring({iso}, 9, 2) || '/' || substring({iso}, 6, 2) || '/' || substring({iso}, 1, 4)"


def _mixed(date: str, day_first_when: str, junk_when: str = "false", slashes_when: str = "false") -> str:
    """A date as text: day-first, year-first with slashes or junk on some rows, ISO otherwise."""
    return (
        f"CASE WHEN {junk_when} THEN 'sin fecha' WHEN {day_first_when} THEN {_day_first(date)} "
        f"WHEN {slashes_when} THEN replace({_iso(date)}, '-', '/') ELSE {_iso(date)} END"
    )


def _days(start: str, number: str) -> str:
    return f"DATE '{start}' + CAST(floor({number}) AS INT)"


_PROJECT = (
    "(c_nationkey * 5 + CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 "
    "WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3 ELSE 4 END)"
)
_PRIORITY = "CAST(substring(o_orderpriority, 1, 1) AS INT)"
_ORDER_DAY = "CAST(o_orderdate AS DATE)"
_SHIP_DAY = "CAST(l_shipdate AS DATE)"
_C_UPDATED = _mixed(_days("2012-01-01", "abs(c_acctbal) / 10"), "c_acctbal < 0", "c_acctbal > 9900")
_C_CREATED = _mixed(_days("2010-01-01", "abs(c_acctbal) / 10"), "c_acctbal < 1000")

_CLIENTS = f"""
SELECT CAST(c_nationkey AS STRING) AS client_id,
       '  Cliente ' || CAST(c_nationkey AS STRING) || ' ' AS client_name,
       '1' AS company_id,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL WHEN c_mktsegment = 'BUILDING' THEN '  '
            WHEN c_acctbal < 2000 THEN ' spain' ELSE 'España' END AS country,
       CASE WHEN c_acctbal > 9000 THEN '   ' ELSE ' Farma ' || c_mktsegment END AS sector,
       {_C_CREATED} AS created_at,
       {_C_UPDATED} AS updated_at_sys
FROM {{customer}}
"""

_PROJECTS = f"""
SELECT ' ' || CAST({_PROJECT} AS STRING) || ' ' AS project_id,
       CASE WHEN c_acctbal < 0 THEN ' ' ELSE ' Proyecto ' || c_mktsegment END AS project_name,
       CASE WHEN c_mktsegment = 'BUILDING' THEN NULL
            ELSE ' prj' || CAST({_PROJECT} AS STRING) END AS project_code,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN CAST(c_nationkey + {ORPHAN} AS STRING)
            ELSE CAST(c_nationkey AS STRING) END AS client_id,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL
            WHEN c_mktsegment = 'MACHINERY' THEN '  '
            ELSE 'Cli' || CAST(c_nationkey AS STRING) || ' ' END AS client_code,
       {_C_CREATED} AS created_at,
       {_C_UPDATED} AS updated_at_sys,
       CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 5000 THEN 'False' ELSE 'True' END
           AS project_exportable
FROM {{customer}}
"""


def _campaigns(name: str, updated: str, where: str = "") -> str:
    start = _days("2018-01-01", "abs(c_acctbal) / 4")
    end = f"{start} + CASE WHEN c_acctbal < 0 THEN -5 ELSE 200 END"
    lost = "c_mktsegment = 'HOUSEHOLD' OR (c_mktsegment = 'AUTOMOBILE' AND c_acctbal < 3000)"
    return f"""
SELECT CAST(c_custkey AS STRING) AS campaign_id,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN ' '
            ELSE 'cam' || CAST(c_custkey AS STRING) END AS campaign_code,
       {name} AS campaign_name,
       CASE WHEN {lost} THEN CAST({_PROJECT} + {ORPHAN} AS STRING)
            ELSE CAST({_PROJECT} AS STRING) END AS project_id,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL
            WHEN c_mktsegment = 'AUTOMOBILE' THEN 'none'
            ELSE 'Prj' || CAST({_PROJECT} AS STRING) END AS project_code,
       ' cli' || CAST(c_nationkey AS STRING) AS client_code,
       {_mixed(start, "c_mktsegment = 'FURNITURE'", "c_acctbal > 9500")} AS campaign_start_date,
       {_mixed(end, "c_mktsegment = 'BUILDING'")} AS campaign_end_date,
       CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 5000 THEN 'False' ELSE 'True' END AS is_active,
       '1' AS campaign_state_id,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL WHEN c_mktsegment = 'BUILDING' THEN '  '
            WHEN c_acctbal > 9800 THEN 'Sin estado' WHEN c_acctbal < 4000 THEN ' Cerrada' ELSE 'Activa ' END
           AS campaign_state,
       '100' AS total_visits_planned,
       '50' AS total_pos_planned,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_acctbal AS STRING) END AS visit_duration_minutes,
       {_C_CREATED} AS created_at,
       {updated} AS updated_at_sys
FROM {{customer}}{where}"""


_OLD_CAMPAIGN = _iso("DATE '2011-06-01'")
_CAMPAIGNS = (
    _campaigns("' ' || c_name || ' '", _C_UPDATED)
    + "\nUNION ALL"
    + _campaigns("c_name || ' v0'", _OLD_CAMPAIGN, " WHERE c_mktsegment = 'MACHINERY'")
)


def _questions(name: str, updated: str, where: str = "") -> str:
    return f"""
SELECT CAST(p_partkey AS STRING) AS question_id,
       CAST(p_partkey AS STRING) AS campaign_id,
       'cam' || CAST(p_partkey AS STRING) || ' ' AS campaign_code,
       CASE WHEN p_type = 'PROMO' THEN '  ' ELSE ' q' || CAST(p_partkey AS STRING) END AS question_code,
       {name} AS question_name,
       CASE p_type WHEN 'ECONOMY' THEN 's ' WHEN 'SMALL' THEN ' M' WHEN 'STANDARD' THEN 'n'
            WHEN 'PROMO' THEN 't' WHEN 'LARGE' THEN ' ' ELSE 'x' END AS question_type,
       CASE WHEN p_size > 45 THEN NULL ELSE p_brand || ' ' END AS question_category,
       CAST(p_size AS STRING) AS question_order,
       CASE WHEN p_size > 25 THEN 'True' ELSE 'False' END AS question_is_highlighted,
       CASE WHEN p_size < 5 THEN NULL WHEN p_type = 'SMALL' THEN 'true' ELSE 'false' END AS image_associated,
       {_mixed(_days("2015-01-01", "p_retailprice"), "p_type = 'PROMO'")} AS created_at,
       {updated} AS updated_at_sys
FROM {{part}}{where}"""


_QUESTIONS = (
    _questions("' ' || p_name", _mixed(_days("2018-01-01", "p_retailprice"), "p_type = 'SMALL'"))
    + "\nUNION ALL"
    + _questions("p_name || ' old'", "'2016-01-01'", " WHERE p_type = 'SMALL'")
)


def _workers(ident: str, province: str, updated: str, where: str = "") -> str:
    return f"""
SELECT {ident} AS employee_id,
       CASE WHEN s_acctbal > 9500 THEN ' ' ELSE ' Nombre ' || CAST(s_nationkey AS STRING) END
           AS employee_first_name,
       CASE WHEN s_acctbal > 9000 THEN NULL WHEN s_acctbal < 2000 THEN 'False' ELSE 'True' END
           AS employee_active_status,
       {_mixed(_days("2014-01-01", "abs(s_acctbal) / 5"), "s_acctbal > 5000", "s_acctbal < 0")}
           AS employee_hire_date,
       {province} AS employee_address_province,
       CASE WHEN s_acctbal < 3000 THEN NULL WHEN s_acctbal < 6000 THEN ' part' ELSE 'Indef ' END
           AS employee_contract_type,
       '1' AS company_id,
       '2014-01-01' AS created_at,
       {updated} AS updated_at_sys
FROM {{supplier}}{where}"""


_WORKERS = (
    _workers("CAST(s_suppkey AS STRING)", "' León ' || CAST(s_nationkey AS STRING)", "'2024-05-01'")
    + "\nUNION ALL"
    + _workers(
        "' ' || CAST(s_suppkey AS STRING) || ' '", "'Soria'", "'01/05/2024 '", " WHERE s_acctbal > 4000"
    )
)


def _pos(name: str, updated: str, where: str = "") -> str:
    return f"""
SELECT CAST(c_custkey AS STRING) AS intervention_point_id,
       ' pdv' || CAST(c_custkey AS STRING) AS intervention_point_code,
       {name} AS intervention_point_name,
       CASE WHEN c_acctbal < 500 THEN ' ' ELSE 'Calle ' || CAST(c_nationkey AS STRING) || ', 1' END
           AS intervention_point_address,
       CASE WHEN c_acctbal > 9000 THEN NULL ELSE ' Palmas, ' || c_mktsegment END
           AS intervention_point_province,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE 'Localidad ' || CAST(c_nationkey AS STRING) END
           AS intervention_point_locality,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE '0' || CAST(8000 + c_nationkey AS STRING) END
           AS intervention_point_postal_code,
       CAST(c_acctbal AS STRING) AS intervention_point_latitude,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE '-' || CAST(c_acctbal AS STRING) END
           AS intervention_point_longitude,
       CASE WHEN c_acctbal < 1000 THEN NULL WHEN c_acctbal < 3000 THEN 'false' ELSE 'True' END
           AS intervention_point_is_active,
       {_C_CREATED} AS created_at,
       {updated} AS updated_at
FROM {{customer}}{where}"""


_POS = (
    _pos("' ' || c_name", _C_UPDATED)
    + "\nUNION ALL"
    + _pos("c_name || ' dup'", _C_UPDATED, " WHERE c_mktsegment = 'HOUSEHOLD'")
)

_ROUTE_ID = f"(o_custkey * 5 + {_PRIORITY})"
_ROUTES = f"""
SELECT CAST({_ROUTE_ID} AS STRING) AS route_id,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE ' rut' || CAST({_ROUTE_ID} AS STRING) END AS route_code,
       ' Ruta ' || o_orderpriority AS route_name,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN CAST(o_custkey + {ORPHAN} AS STRING)
            ELSE CAST(o_custkey AS STRING) END AS campaign_id,
       'cam' || CAST(o_custkey AS STRING) AS campaign_code,
       {_mixed(_ORDER_DAY, "o_orderstatus = 'O'")} AS route_start_date,
       {_mixed(f"{_ORDER_DAY} + 30", "o_orderstatus = 'F'", "o_totalprice > 450000")} AS route_end_date,
       CASE WHEN o_orderstatus = 'F' THEN ' ' WHEN o_orderstatus = 'O' THEN 'Alta' ELSE ' Baja' END
           AS route_status,
       CASE WHEN o_totalprice < 50000 THEN NULL ELSE ' dlg' || o_orderstatus END AS delegation_code,
       CASE WHEN o_totalprice < 30000 THEN NULL WHEN o_orderstatus = 'P' THEN 'True' ELSE 'False' END
           AS recall_mail_sent,
       {_iso(_ORDER_DAY)} AS created_at,
       {_mixed(_ORDER_DAY, "o_orderstatus = 'P'", "o_totalprice > 495000")} AS updated_at_sys
FROM {{orders}}
"""

_ROUTE_EMPLOYEE = f"""
SELECT CAST(l_orderkey * 10 + l_linenumber AS STRING) AS route_employee_id,
       CAST(l_partkey * 5 + l_linenumber AS STRING) AS route_id,
       CASE WHEN l_discount = 0.1 THEN CAST(l_suppkey + {ORPHAN} AS STRING)
            ELSE ' ' || CAST(l_suppkey AS STRING) END AS employee_id,
       CASE l_returnflag WHEN 'R' THEN 'True' WHEN 'A' THEN 'False' END AS main_employee,
       CASE WHEN l_quantity > 45 THEN NULL ELSE CAST(l_quantity AS STRING) END AS ip_percentage,
       {_iso(_SHIP_DAY)} AS created_at,
       {_mixed(_SHIP_DAY, "l_linestatus = 'F'")} AS updated_at,
       CASE WHEN l_tax = 0.08 THEN {_day_first(_SHIP_DAY)} END AS deleted_at
FROM {{lineitem}}
"""


def _visits(status: str, updated: str, where: str = "") -> str:
    iso = _iso(_ORDER_DAY)
    clock = f"substring({iso}, 9, 2) || ':' || substring({iso}, 6, 2) || ':' || substring({iso}, 9, 2)"
    return f"""
SELECT CAST(o_orderkey AS STRING) AS visit_id,
       CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P'
            THEN CAST(o_custkey + {ORPHAN} AS STRING) ELSE CAST(o_custkey AS STRING) END AS campaign_id,
       ' cam' || CAST(o_custkey AS STRING) AS campaign_code,
       'prj' || CAST(CAST(floor(o_totalprice / 10000) AS BIGINT) AS STRING) || ' ' AS project_code,
       CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O'
            THEN CAST(o_custkey + {ORPHAN} AS STRING) ELSE CAST(o_custkey AS STRING) END
           AS intervention_point_id,
       ' pdv' || CAST(o_custkey AS STRING) AS intervention_point_code,
       CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN '  '
            WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' THEN NULL
            WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'
            THEN CAST({_ROUTE_ID} + {ORPHAN} AS STRING)
            ELSE ' ' || CAST({_ROUTE_ID} AS STRING) END AS route_id,
       CASE WHEN o_totalprice < 50000 THEN ' ' ELSE ' rut' || CAST({_ROUTE_ID} AS STRING) END AS route_code,
       {_mixed(_ORDER_DAY, "o_orderstatus = 'O'", "o_totalprice > 480000", "o_totalprice < 40000")} AS visit_date,
       CASE WHEN o_totalprice > 450000 THEN 'mediodia' ELSE {clock} END AS visit_time,
       {status} AS visit_status,
       CASE WHEN o_totalprice < 60000 THEN NULL ELSE ' Tipo ' || o_orderpriority END AS visit_type,
       CASE WHEN o_totalprice < 90000 THEN NULL WHEN o_totalprice < 250000 THEN 'False' ELSE 'True' END
           AS is_client_billable,
       {_iso(_ORDER_DAY)} AS created_at,
       {updated} AS updated_at_sys
FROM {{orders}}{where}"""


_STATUS = (
    "CASE WHEN o_totalprice > 400000 THEN 'info' WHEN o_totalprice < 15000 THEN '  ' "
    "WHEN o_totalprice < 25000 THEN 'otro' WHEN o_orderstatus = 'F' THEN ' ok' "
    "WHEN o_orderstatus = 'O' THEN 'Incid ' ELSE 'NOVIS' END"
)
_VISITS = (
    _visits(_STATUS, _mixed(f"{_ORDER_DAY} + 10", "o_orderstatus = 'F'", slashes_when="o_orderpriority = '1-URGENT'"))
    + "\nUNION ALL"
    + _visits("'NOVIS'", _iso(_ORDER_DAY), " WHERE o_orderstatus = 'P'")
)

_RESPONSES = f"""
SELECT CAST(l_orderkey * 10 + l_linenumber AS STRING) AS answer_id,
       CASE WHEN l_tax = 0.08 THEN CAST(l_orderkey + {ORPHAN} AS STRING)
            ELSE CAST(l_orderkey AS STRING) END AS visit_id,
       CASE WHEN l_discount = 0.0 THEN NULL WHEN l_discount = 0.1 THEN '  '
            WHEN l_discount = 0.05 THEN CAST(l_partkey + {ORPHAN} AS STRING)
            ELSE CAST(l_partkey AS STRING) || ' ' END AS question_id,
       ' cam' || CAST(l_partkey AS STRING) AS campaign_code,
       'pdv' || CAST(l_suppkey AS STRING) AS intervention_point_code,
       CASE l_returnflag WHEN 'R' THEN ' n' WHEN 'A' THEN '  ' ELSE NULL END AS question_type,
       CASE WHEN l_quantity > 40 THEN '  ' ELSE ' ' || CAST(l_extendedprice AS STRING) || ' ' END AS answer,
       CASE WHEN l_linestatus = 'F' THEN NULL ELSE CAST(l_quantity AS STRING) END AS expected_answer,
       {_iso(_SHIP_DAY)} AS created_at,
       {_mixed(_SHIP_DAY, "l_linestatus = 'O'", "l_quantity = 50", "l_quantity < 10")} AS updated_at_sys
FROM {{lineitem}}
"""

RAW_SQL: dict[str, str] = {
    "clients": _CLIENTS,
    "projects": _PROJECTS,
    "campaigns": _CAMPAIGNS,
    "questions": _QUESTIONS,
    "workers": _WORKERS,
    "pos": _POS,
    "routes": _ROUTES,
    "route_employee": _ROUTE_EMPLOYEE,
    "visits": _VISITS,
    "responses": _RESPONSES,
}


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    tasks = spark.sparkContext.defaultParallelism
    return balanced(spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet"), min_tasks=tasks, task_bytes=TASK_BYTES)


class RawTables(Mapping[str, DataFrame]):
    """The raw tables of a data folder as lazy Spark plans, made when first used."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        set_for_wide_tables(spark)
        self._spark, self._sf_dir = spark, sf_dir
        self._given: dict[str, DataFrame] = {}
        self._made: dict[str, DataFrame] = {}

    def _source(self, table: str) -> DataFrame:
        if table not in self._given:
            self._given[table] = given(self._spark, self._sf_dir, table)
        return self._given[table]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            sql = RAW_SQL[name]
            sources = {t: self._source(t) for t in GIVEN_TABLES if "{" + t + "}" in sql}
            self._made[name] = self._spark.sql(sql, **sources)
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(RAW_SQL)

    def __len__(self) -> int:
        return len(RAW_SQL)


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return RawTables(spark, sf_dir)[name]


def raw_select(name: str) -> str:
    """The same raw table as SQL over views named like the given tables."""
    return RAW_SQL[name].format(**{t: t for t in GIVEN_TABLES}).strip()
