"""Global ranks and frequent values against plain counting."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldspark.operators import profile
from fieldspark.operators.frequent import frequent_values
from fieldspark.operators.ranks import global_rank


def test_ranks_go_on_over_ranges(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "a", "a", "a", "b", None]), rng.randrange(50), i) for i in range(2_000)] + [("z", 1, -1)]
    df = spark.createDataFrame(rows, "g string, v int, id int").repartition(5)
    want = {}
    for g in {r[0] for r in rows}:
        ordered = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        want |= {r[2]: i for i, r in enumerate(ordered, 1)}
    ranked = global_rank(df, ["g"], [F.desc("v"), F.asc("id")], "place")
    assert ranked.columns == ["g", "v", "id", "place"]
    assert {r.id: r.place for r in ranked.collect()} == want
    assert global_rank(df.limit(0), ["g"], [F.desc("v")]).collect() == []


def test_no_column_is_ranked_in_one_task(spark):
    df = spark.range(3_000).select((F.col("id") % 700).alias("many"), F.lit("x").alias("one"))
    ranked = profile.top_values(df, ["many", "one"])
    assert "Window" not in ranked._jdf.queryExecution().executedPlan().toString()
    assert ranked.where("column_name = 'many'").agg(F.max("value_rank")).first()[0] == 700


def values(n, flat):
    rng = random.Random(n)
    heavy = [f"h{i}" for i in range(15) for _ in range(400 - 20 * i)]
    rare = [f"r{rng.randrange(n)}" for _ in range(n)]
    rows = [(None if rng.random() < 0.1 else v, f"{i}" if flat else "x", rng.choice([None, "p", "q"]), None) for i, v in enumerate(heavy + rare)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("tracked", [(64, 512), (16,), ()])
def test_frequent_values_are_exact(spark, tracked):
    rows = values(6_000, flat=True)
    names = ["skewed", "flat", "few", "none"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names)).repartition(4)
    want = []
    for i, c in enumerate(names):
        counts = Counter(r[i] for r in rows if r[i] is not None)
        best = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:10]
        want += [(c, v, n, place) for place, (v, n) in enumerate(best, 1)]
    assert sorted(map(tuple, frequent_values(df, names, 10, tracked).collect())) == sorted(want)


def test_heavy_values_need_no_shuffle_of_all_cells(spark, monkeypatch):
    """Two passes settle a skewed column: the values of the rare rows are never grouped."""
    grouped = []
    real = type(spark.range(1)).groupBy
    monkeypatch.setattr(type(spark.range(1)), "groupBy", lambda self, *c: grouped.append(self) or real(self, *c))
    df = spark.createDataFrame(values(6_000, flat=False), "skewed string, flat string, few string, none string")
    assert frequent_values(df, ["skewed", "few"], 10, (512,)).count() == 12
    plan = [g._jdf.queryExecution().optimizedPlan().toString() for g in grouped if "cell" in str(g.columns) or "column_name" in g.columns]
    assert len(plan) == 1 and "LeftSemi" in plan[0]
