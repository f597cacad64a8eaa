"""The campaign mart against a published export, where its raw files are at hand.

Set GOLDEN_RAW_DIR to the folder of raw files, GOLDEN_EXPORT to the exported CSV and
GOLDEN_AS_OF to a day consistent with the exported statuses.
"""

import csv
import os

import pytest
from pyspark.sql import types as T

from fieldspark.plans import marts
from fieldspark.plans.entities import Settings
from fieldspark.plans.staging import StagedTables
from fieldspark.sources.raw_csv import read_raw
from fieldspark.sources.schemas import RAW_COLUMNS

RAW, EXPORT = os.environ.get("GOLDEN_RAW_DIR"), os.environ.get("GOLDEN_EXPORT")
pytestmark = pytest.mark.skipif(not (RAW and EXPORT), reason="needs a published export")

FROM_VISITS = {
    "total_visits", "completed_visits", "not_visited_visits", "incid_visits", "routes_with_visits",
    "completion_rate", "route_execution_rate", "incidence_rate",
}


def test_export_columns_that_need_no_visits(spark):
    def raw(name):
        if os.path.exists(f"{RAW}/raw_{name}.csv"):
            return read_raw(spark, RAW, name)
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[name]]))

    tables = StagedTables({n: raw(n) for n in RAW_COLUMNS}, Settings(as_of=os.environ["GOLDEN_AS_OF"]))
    with open(EXPORT, encoding="utf-8") as f:
        want = {r["campaign_id"]: r for r in csv.DictReader(f)}
    mart = marts.campaign_performance(tables)
    got = {str(r.campaign_id): r.asDict() for r in mart.collect()}
    assert got.keys() == want.keys() and list(mart.columns) == list(next(iter(want.values())))

    def text(v):
        return "" if v is None else str(v).lower() if isinstance(v, bool) else str(v)

    for key, row in want.items():
        for column in row.keys() - FROM_VISITS:
            assert text(got[key][column]) == row[column], (key, column)
