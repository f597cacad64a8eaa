import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fieldspark.functions import casts, dates, metrics, text


def apply(spark, values, rule, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", rule(F.col("v")).alias("out")).orderBy("i").collect()]


def test_text_rules_differ_in_case_and_blanks(spark):
    raw = ["  a b ", "   ", None, "\ta", "straße"]
    assert apply(spark, raw, text.label) == ["a b", "", None, "\ta", "straße"]
    assert apply(spark, raw, text.text) == ["a b", None, None, "\ta", "straße"]
    assert apply(spark, raw, text.code) == ["A B", "", None, "\tA", "STRASSE"]
    assert apply(spark, raw, text.category) == ["A B", None, None, "\tA", "STRASSE"]


def test_imputed_code_keeps_the_id_visible(spark):
    df = spark.createDataFrame([(1, " a1 "), (2, "  "), (3, None), (None, None)], "id int, code string")
    out = df.select(text.imputed_code(F.col("code"), "X_", F.col("id")).alias("c")).collect()
    assert [r.c for r in out] == ["A1", "X_2", "X_3", None]


def test_ids(spark):
    assert apply(spark, [" 11 ", "7", None], casts.ident) == [11, 7, None]
    assert apply(spark, [" 11 ", "  ", None], casts.optional_ident) == [11, None, None]
    big = apply(spark, ["3000000000"], lambda c: casts.ident(c, "bigint"))
    assert big == [3000000000]
    assert apply(spark, ["12.0", " 6.5 ", "2.4", "-2.5"], casts.ident) == [12, 6, 2, -2]
    lenient = apply(spark, ["x1", "5", "x.1", "7.0"], lambda c: casts.ident(c, strict=False))
    assert lenient == [None, 5, None, 7]
    for bad in ("x1", "3000000000", "1.2.3"):
        with pytest.raises(PySparkException):
            apply(spark, [bad], casts.ident)


def test_numbers_and_booleans(spark):
    assert apply(spark, ["1.5", None], casts.real) == [1.5, None]
    assert apply(spark, ["45", None], casts.float_or_zero) == [45.0, 0.0]
    assert apply(spark, ["True", "false", "1", None], casts.boolean) == [True, False, True, None]


D = dt.date
DATES = {
    "2025-10-20": D(2025, 10, 20),
    "2025-1-5": D(2025, 1, 5),
    " 2025-10-20 ": D(2025, 10, 20),
    "2025-10-20 12:30": D(2025, 10, 20),
    "2025-10-20 12:30:15.5": D(2025, 10, 20),
    "2025-10-20T12:30:15": D(2025, 10, 20),
    "2025-10-20 25:00:00": None,
    "2025-10-20 x": None,
    "2025-10-20x": None,
    "2025-13-01": None,
    "2025-02-30": None,
    "2025": None,
    "2025-10": None,
    "20/10/2025": D(2025, 10, 20),
    "5/1/2025": D(2025, 1, 5),
    " 05/01/2025 ": D(2025, 1, 5),
    "31/02/2025": None,
    "05/01/25": None,
    "20/10/2025 x": None,
    "10-20-2025": None,
    "sin fecha": None,
    "": None,
    None: None,
}


def test_mixed_dates(spark):
    assert dict(zip(DATES, apply(spark, list(DATES), dates.mixed_date))) == DATES


def test_mixed_timestamps_keep_the_clock_and_agree_with_dates(spark):
    out = dict(zip(DATES, apply(spark, list(DATES), dates.mixed_timestamp)))
    assert out["2025-10-20 12:30"] == dt.datetime(2025, 10, 20, 12, 30)
    assert out["20/10/2025"] == dt.datetime(2025, 10, 20)
    assert {k: v and v.date() for k, v in out.items()} == DATES


def test_date_shapes(spark):
    raw = ["2025-10-20", "5/1/2025", " ", None, "31/02/2025", "2025"]
    assert apply(spark, raw, dates.date_shape) == ["iso", "day_first", "blank", "blank", "other", "other"]


def test_time_of_day(spark):
    raw = ["9:05:00", "23:59:59", "10:30", "24:00:00", "10:61:00", "mediodia", "10:00:00 x", None]
    want = ["09:05:00", "23:59:59", "10:30:00", None, None, None, None, None]
    assert apply(spark, raw, dates.time_of_day) == want


def test_lifecycle_includes_both_ends(spark):
    day = "2026-06-05"
    rows = [
        ("2026-06-05", "2026-06-05", "ACTIVA", True),
        ("2026-06-06", "2026-07-01", "PROGRAMADA", False),
        ("2026-01-01", "2026-06-04", "CERRADA", False),
        ("2026-07-01", "2026-01-01", "PROGRAMADA", False),
        (None, "2026-01-01", None, False),
        (None, "2026-07-01", None, None),
        ("2026-07-01", None, None, False),
        ("2026-01-01", None, None, None),
    ]
    df = spark.createDataFrame(rows, "a string, b string, status string, active boolean")
    start, end = F.col("a").cast("date"), F.col("b").cast("date")
    out = df.select(
        "status", "active",
        dates.lifecycle_status(start, end, day).alias("s"), dates.active_on(start, end, day).alias("x"),
    ).collect()
    for r in out:
        assert (r.s, r.x) == (r.status, r.active)


def test_today_defaults_to_the_current_date(spark):
    row = spark.range(1).select(
        dates.lifecycle_status(F.current_date(), F.current_date()).alias("s")
    ).first()
    assert row.s == "ACTIVA"


def test_effective_state(spark):
    rows = [("En preparación", "2026-01-01"), (None, "2026-06-04"), (None, "2026-06-05"), (None, None)]
    df = spark.createDataFrame(rows, "s string, e string")
    out = df.select(dates.effective_state(F.col("s"), F.col("e").cast("date"), "2026-06-05").alias("x"))
    assert [r.x for r in out.collect()] == ["En preparación", "Cerrada", "Activa", None]


def test_rate(spark):
    df = spark.createDataFrame([(41, 45), (0, 5), (3, 0), (None, 4), (1, None), (2, 3)], "n int, d int")
    out = [r.x for r in df.select(metrics.rate(F.col("n"), F.col("d")).alias("x")).collect()]
    assert out == [0.9111, 0.0, 0.0, 0.0, 0.0, 0.6667]


def test_sorted_text_is_in_string_order_and_null_when_empty(spark):
    df = spark.createDataFrame([(["3", "11", "2"],), ([],), (["Éva", "Ana", "Zoe"],)], "a array<string>")
    out = [r.x for r in df.select(metrics.sorted_text(F.col("a")).alias("x")).collect()]
    assert out == ["11, 2, 3", None, "Ana, Zoe, Éva"]


def test_year_first_slashes_are_dates(spark):
    df = spark.createDataFrame([("2025/1/5",), ("2025/01/05 10:30:00",), ("5/1/2025",), ("2025/13/01",)], "d string")
    got = [r.t for r in df.select(dates.mixed_timestamp(F.col("d")).alias("t")).collect()]
    assert [str(t) if t else None for t in got] == ["2025-01-05 00:00:00", "2025-01-05 10:30:00", "2025-01-05 00:00:00", None]


def test_strict_ids_fail_in_every_session_mode(spark):
    df = spark.createDataFrame([("x1",)], "v string")
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for mode in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", mode)
            with pytest.raises(Exception, match="not a whole number: x1"):
                df.select(casts.ident(F.col("v"))).collect()
            assert df.select(casts.ident(F.col("v"), strict=False).alias("v")).first().v is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_half_ids_go_to_the_even_neighbour(spark):
    df = spark.createDataFrame([("2.5",), ("3.5",), ("12.0",), (" 7 ",), (None,)], "v string")
    assert [r.v for r in df.select(casts.ident(F.col("v")).alias("v")).collect()] == [2, 4, 12, 7, None]
