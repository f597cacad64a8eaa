import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fieldspark.operators import checks as ck
from fieldspark.operators import profile
from fieldspark.operators.assignment import primary_assignment
from fieldspark.operators.dedup import keep_latest
from fieldspark.operators.keys import highest_per_key, key_set, with_fk_flag
from fieldspark.operators import lookup as lookups
from fieldspark.operators.lookup import fits_broadcast, hot_keys, lookup


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- deduplication ----------------------------------------------------------------------


def test_keep_latest_takes_the_newest_and_puts_missing_versions_last(spark):
    df = spark.createDataFrame(
        [(1, 5, "old"), (1, 9, "new"), (2, None, "none"), (2, 1, "some"), (None, 3, "a"), (None, 4, "b")],
        "id int, v int, t string",
    )
    assert rows(keep_latest(df, "id", "v")) == [(1, 9, "new"), (2, 1, "some"), (None, 4, "b")]


def test_keep_latest_breaks_ties_by_the_other_columns(spark):
    data = [(1, 5, "b", 1), (1, 5, "a", 2), (1, 5, None, 0), (1, 5, "a", None)]
    for _ in range(5):
        random.shuffle(data)
        df = spark.createDataFrame(data, "id int, v int, t string, n int").repartition(4)
        assert rows(keep_latest(df, "id", "v")) == [(1, 5, "a", 2)]


def test_keep_latest_limits_copies_before_the_shuffle(spark):
    third = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    df = spark.range(100_000).select(third.alias("id"), F.col("id").alias("v"))
    plan = keep_latest(df, "id", "v")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


# --- lookups ----------------------------------------------------------------------------


def skewed(spark, n=6000, seed=1):
    """A third of the rows on one key, a third without a key, the rest spread and partly orphan."""
    rnd = random.Random(seed)
    def key(i):
        return 7 if i % 3 == 0 else None if i % 3 == 1 else rnd.randrange(2000)
    return spark.createDataFrame([(i, key(i)) for i in range(n)], "rid int, fk int").repartition(8)


def parents(spark):
    data = [(k, f"p{k}") for k in range(0, 1500)] + [(7, "second"), (None, "nokey")]
    return spark.createDataFrame(data, "key int, name string")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("path", ["broadcast", "shuffle", "spread"])
def test_lookup_paths_agree(spark, request, monkeypatch, how, path):
    monkeypatch.setattr(lookups, "HOT_ROWS", 100)
    left, right = skewed(spark), parents(spark)
    want = rows(left.join(right, F.col("fk") == F.col("key"), how).drop("key"))
    if path == "broadcast":
        small = [spark.range(10)]
        assert fits_broadcast(small) and not fits_broadcast([right])
        left_to_spark = lookup(left, right, "fk", "key", how=how, sized_by=small)
        assert "ResolvedHint" not in left_to_spark._jdf.queryExecution().analyzed().toString()
        assert rows(left_to_spark) == want
    else:
        request.getfixturevalue("no_broadcast")
        hot = left if path == "spread" else None
        assert rows(lookup(left, right, "fk", "key", how=how, hot_from=hot, spread_by=["rid"])) == want


def test_hot_keys_are_those_over_the_limit(spark, monkeypatch):
    monkeypatch.setattr(lookups, "HOT_ROWS", 300)
    assert rows(hot_keys(skewed(spark), "fk")) == [(7, 7)]  # 2000 rows and a few random ones


def test_hot_keys_have_more_than_an_even_share(spark):
    df = spark.createDataFrame([(i % 50,) for i in range(500)] + [(7,)] * 300, "fk int")
    assert rows(hot_keys(df, "fk")) == [(7, 4)]  # 310 of 800 rows; a share is 100


def test_a_third_of_the_rows_on_one_key_and_a_code_of_many_projects(spark, no_broadcast):
    left = spark.createDataFrame([(i, 1 if i % 3 == 0 else i) for i in range(3000)], "rid int, fk int")
    right = spark.createDataFrame([(1, f"p{i}") for i in range(1000)] + [(i, "x") for i in range(2, 500)], "key int, name string")
    plain = left.join(right, F.col("fk") == F.col("key"), "left").drop("key")
    got = lookup(left, right, "fk", "key", hot_from=left, spread_by=["rid"])
    summed = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("rid", "fk", "name").cast("decimal(38,0)"))).first()
    assert summed(got) == summed(plain)


def test_hot_and_missing_keys_are_spread_over_tasks(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(lookups, "HOT_ROWS", 100)
    left = skewed(spark, 9000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def largest_task(df):
            return max(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())

        plain = largest_task(left.join(parents(spark).where("name != 'second'"), F.col("fk") == F.col("key"), "left"))
        spread = largest_task(
            lookup(left, parents(spark).where("name != 'second'"), "fk", "key", hot_from=left, spread_by=["rid"])
        )
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plain >= 3000  # one task holds at least the hot key
    assert spread < 2000  # 9000 rows over 8 tasks


@pytest.mark.parametrize("shuffled", [False, True])
def test_fk_flags_follow_the_null_policy(spark, request, shuffled):
    if shuffled:
        request.getfixturevalue("no_broadcast")
    df = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, fk int")
    keys = key_set(spark.createDataFrame([(10,), (10,), (None,)], "k int"), F.col("k"), "k")
    def flags(policy):
        out = with_fk_flag(df, "fk", keys, "k", "ok", null_fk=policy, hot_from=df, spread_by=["id"])
        return {r.id: r.ok for r in out.collect()}
    assert flags("valid") == {1: True, 2: False, 3: True}
    assert flags("invalid") == {1: True, 2: False, 3: False}


def test_highest_per_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, None), (2, None)], "k int, v string")
    assert rows(highest_per_key(df, F.col("k"), F.col("v"), "k", "top")) == [(1, "b"), (2, None)]


# --- assignments ------------------------------------------------------------------------


def test_primary_assignment_matches_a_ranking(spark):
    rnd = random.Random(3)
    data = [
        (rnd.choice([1, 2, 3, 4, None]), rnd.choice([5, 6, 7, None]), rnd.choice([True, False, None]))
        for _ in range(60)
    ] + [(9, 4, None), (9, 4, False), (8, None, True), (8, 2, False)]
    per_route = defaultdict(list)
    for route, employee, main in data:
        per_route[route].append((employee, main))
    def rank(a):
        employee, main = a
        return (0 if main else 1, employee is None, employee or 0, main is None)
    want = [
        (route, *min(group, key=rank), len(group)) for route, group in per_route.items()
    ]
    df = spark.createDataFrame(data, "route_id int, employee_id int, main_employee boolean")
    assert rows(primary_assignment(df)) == sorted(want, key=str)


# --- checks -----------------------------------------------------------------------------


@pytest.fixture
def tables(spark):
    child = spark.createDataFrame(
        [(1, 10, "a", True, "2025-01-01", "2025-02-01"), (1, 99, "z", False, "2025-03-01", "2025-02-01"),
         (2, 99, "z", True, None, "2025-02-01"), (None, None, None, None, "2025-01-01", None),
         (None, 10, "a", True, "2025-01-01", "2025-01-01")],
        "id int, fk int, kind string, ok boolean, a string, b string",
    )
    return {"child": child, "parent": spark.createDataFrame([(10,), (11,)], "id int")}


def test_checks_count_failures(tables):
    declared = [
        ck.NotNull(model="child", column="id"),
        ck.NotNull(model="parent", column="id"),
        ck.Unique(model="child", column="id"),
        ck.Relationships(model="child", column="fk", parent="parent", parent_column="id", severity="warn"),
        ck.AcceptedValues(model="child", column="kind", values=["a", "b"]),
        ck.MaxInvalidShare(model="child", column="ok", max_share=0.1),
        ck.MaxInvalidShare(model="child", column="ok", max_share=0.5, severity="warn"),
        ck.OrderedDates(model="child", column="a", end_column="b"),
    ]
    found = {
        (r.check_name, r.model, r.severity): (r.failures, r.outcome)
        for r in ck.run_checks(tables, declared).collect()
    }
    assert found == {
        ("not_null", "child", "error"): (2, "error"),
        ("not_null", "parent", "error"): (0, "pass"),
        ("unique", "child", "error"): (1, "error"),
        ("relationships", "child", "warn"): (2, "warn"),
        ("accepted_values", "child", "error"): (1, "error"),
        ("max_invalid_share", "child", "error"): (1, "error"),
        ("max_invalid_share", "child", "warn"): (0, "pass"),
        ("ordered_dates", "child", "error"): (1, "error"),
    }


def test_only_errors_stop_a_run(tables):
    orphan = dict(model="child", column="fk", parent="parent", parent_column="id")
    ck.enforce(ck.run_checks(tables, [ck.Relationships(**orphan, severity="warn")]))
    with pytest.raises(ck.ChecksFailed, match="relationships child.fk: 2"):
        ck.enforce(ck.run_checks(tables, [ck.Relationships(**orphan)]))


def test_row_checks_of_a_model_share_one_scan(spark, tmp_path):
    spark.range(10).selectExpr("id", "id * 2 AS other", "id * 3 AS third").write.parquet(str(tmp_path / "t"))
    table = {"t": spark.read.parquet(str(tmp_path / "t"))}
    declared = [ck.NotNull(model="t", column=c) for c in ("id", "other", "third")]
    plan = ck.run_checks(table, declared)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


# --- profiles ---------------------------------------------------------------------------


def test_profiles(spark):
    data = [(1, "a"), (2, "a"), (None, "b"), (3, None)]
    df = spark.createDataFrame(data, "n int, s string")
    assert rows(profile.null_counts(df)) == [("n", 4, 1), ("s", 4, 1)]
    assert rows(profile.cardinalities(df, ["n", "s"])) == [("n", 3), ("s", 2)]
    assert rows(profile.cardinalities(df, ["n", "s"], exact=False)) == [("n", 3), ("s", 2)]
    assert rows(profile.top_values(df, ["s"])) == [("s", "a", 2, 1), ("s", "b", 1, 2), ("s", None, 1, 3)]


@pytest.mark.parametrize("shape", ["normal", "heavy_tail", "one_value", "few_values", "huge_range"])
def test_quantiles_and_outliers_are_exact(spark, shape):
    rnd = random.Random(5)
    make = {
        "normal": lambda: round(rnd.gauss(0, 10), 3),
        "heavy_tail": lambda: rnd.paretovariate(0.3),
        "one_value": lambda: 4.0,
        "few_values": lambda: float(rnd.choice([1, 1, 1, 2, 90])),
        "huge_range": lambda: rnd.choice([-1, 1]) * 10.0 ** rnd.randrange(-200, 200),
    }[shape]
    values = [make() for _ in range(1003)]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double").repartition(8)
    ordered = sorted(values)
    def at(p):
        return ordered[math.ceil(p * len(values)) - 1]
    got = profile.quantiles(df, "v").first()
    assert (got.minimum, got.q1, got.median, got.q3, got.maximum) == (
        ordered[0], at(0.25), at(0.5), at(0.75), ordered[-1])
    assert profile.quantile_values(df, "v", [0, 0.013, 1]) == [ordered[0], at(0.013), ordered[-1]]
    spread = 1.5 * (got.q3 - got.q1)
    want = Counter(v for v in values if v < got.q1 - spread or v > got.q3 + spread)
    found = profile.outliers(df.where("NOT isnan(v)"), "v")
    assert Counter(r.v for r in found.collect()) == want


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert profile.quantiles(df, "v").first().q1 is None
    assert profile.outliers(df, "v").count() == 0


@pytest.mark.parametrize("shape", ["inf", "-inf", "all_infinite", "far_apart", "huge_range"])
def test_quantiles_take_few_jobs_whatever_the_values(spark, shape):
    rnd = random.Random(3)
    values = {
        "inf": [1.0, 2.0, 3.0, math.inf], "-inf": [-math.inf, 0.0, 5.0], "all_infinite": [math.inf] * 3 + [-math.inf] * 2,
        "far_apart": [1e300, -1e300, 1e-300, 0.0], "huge_range": [rnd.choice([-1, 1]) * 10.0 ** rnd.randrange(-200, 200) for _ in range(1003)],
    }[shape]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    spark.sparkContext.setJobGroup(shape, shape)
    got = profile.quantile_values(df, "v")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(shape)
    spark.sparkContext.setJobGroup("", "")
    ordered = sorted(values)
    assert got == [ordered[math.ceil(p * len(values)) - 1] for p in (0.25, 0.5, 0.75)]
    assert 0 < len(jobs) <= 8
    assert profile.outliers(df, "v").count() >= 0


def test_quantiles_narrow_down_large_columns(spark):
    df = spark.range(0, 60_000).select((F.col("id") * 7919 % 60_000).cast("double").alias("a"), (F.col("id") % 3).alias("b"))
    got = profile.exact_quantiles(df, ["a", "b"], (0.001, 0.5, 1.0))
    assert got == {"a": [59.0, 29_999.0, 59_999.0], "b": [0.0, 1.0, 2.0]}


def test_date_profile_and_inverted_intervals(spark):
    df = spark.createDataFrame([("2025-01-02",), ("3/1/2025",), (None,), ("x",), (" ",)], "d string")
    got = profile.date_profile(df, ["d"]).first()
    assert (str(got.first_date), str(got.last_date)) == ("2025-01-02", "2025-01-03")
    assert (got.iso_rows, got.day_first_rows, got.blank_rows, got.other_rows) == (1, 1, 2, 1)
    spans = spark.createDataFrame([(1, 2), (3, 2), (None, 1)], "a int, b int")
    assert rows(profile.inverted_intervals(spans, F.col("a"), F.col("b"))) == [(3, 2)]
