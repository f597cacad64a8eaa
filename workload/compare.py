"""Compare registered queries with their SQL, run by DuckDB on the same files.

    python -m workload.compare SF_DIR [query ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from workload.oracle import ORACLE_SQL
from workload.queries import REGISTRY

_KINDS = {
    "TINYINT": "int", "INTEGER": "int", "BIGINT": "bigint", "HUGEINT": "hugeint", "FLOAT": "float",
    "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (1, f"{v:.9g}")
    return (1, str(v))


def _canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a DataFrame and a statement: columns, types, rows."""
    cursor = con.execute(sql)
    expected_types = {d[0]: _KINDS.get(str(d[1]), str(d[1])) for d in cursor.description}
    expected = cursor.fetchall()
    actual_types = dict(df.dtypes)
    if set(actual_types) != set(expected_types):
        return [f"columns {sorted(actual_types)} != {sorted(expected_types)}"]
    found = [
        f"type of {c}: {actual_types[c]} != {expected_types[c]}"
        for c in actual_types
        if actual_types[c] != expected_types[c]
    ]
    rows = _canonical(df.columns, [tuple(r) for r in df.collect()])
    wanted = _canonical(list(expected_types), expected)
    if rows != wanted:
        missing, extra = set(wanted) - set(rows), set(rows) - set(wanted)
        found.append(f"rows {len(rows)} != {len(wanted)}; missing {list(missing)[:2]}; extra {list(extra)[:2]}")
    return found


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(REGISTRY)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            found = differences(REGISTRY[name](spark, sf_dir), con, ORACLE_SQL[name])
        except Exception as e:  # report and go on with the next query
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok':5}{name:32}{time.time() - start:6.1f}s", *found, sep="  ", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
    sys.exit(bad > 0)


if __name__ == "__main__":
    main()
