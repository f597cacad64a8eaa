"""Quantiles within groups against sorting each group."""

import math
import random

import pytest

from fieldspark.operators import group_quantiles as gq
from fieldspark.operators.profile import fences


def quantile(numbers, p):
    ordered = sorted(numbers)
    return ordered[max(1, math.ceil(p * len(ordered))) - 1] if ordered else None


def rows():
    rng = random.Random(8)
    found = [("hot", rng.gauss(0, 10)) for _ in range(6_000)] + [(None, float(rng.randrange(5))) for _ in range(500)]
    found += [(f"g{rng.randrange(40)}", rng.choice([1.0, 2.0, rng.random()])) for _ in range(2_000)]
    found += [("one", 3.5), ("none", None), ("nan", float("nan")), ("nan", 7.0), ("inf", float("inf")), ("inf", float("-inf")), ("inf", 1.0)]
    found += [("same", 2.0)] * 300
    rng.shuffle(found)
    return found


def by_group(some):
    groups = {}
    for g, v in some:
        groups.setdefault(g, []).extend([] if v is None or math.isnan(v) else [v])
    return groups


@pytest.mark.parametrize("ranked, accuracy", [(gq.RANKED_VALUES, gq.SKETCH_ACCURACY), (10, 100)])
def test_quantiles_of_all_groups(spark, monkeypatch, ranked, accuracy):
    monkeypatch.setattr(gq, "RANKED_VALUES", ranked)
    monkeypatch.setattr(gq, "SKETCH_ACCURACY", accuracy)
    some = rows()
    df = spark.createDataFrame(some, "g string, v double").repartition(4)
    found = {r.g: tuple(r)[1:] for r in gq.group_quantiles(df, "g", "v", ("a", "b"), (0.1, 0.75)).collect()}
    assert found == {g: (len(v), quantile(v, 0.1), quantile(v, 0.75)) for g, v in by_group(some).items()}


def test_outliers_of_their_group(spark):
    some = [r for r in rows() if r[0] != "inf"] + [("hot", 1e6), ("g1", -50.0)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(some)], "g string, v double, id int")
    want = set()
    limits = {g: fences(quantile(v, 0.25), quantile(v, 0.75)) for g, v in by_group(some).items()}
    for i, (g, v) in enumerate(some):
        low, high = limits[g]
        if v is not None and low is not None and (v < low or v > high):
            want.add(i)
    found = gq.group_outliers(df, "g", "v")
    assert found.columns == ["g", "v", "id"]
    assert {r.id for r in found.collect()} == want


def test_no_rows(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert gq.group_quantiles(df, "g", "v").collect() == []
    assert gq.group_outliers(df, "g", "v").collect() == []
