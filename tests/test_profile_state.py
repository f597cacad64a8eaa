"""Merged profile states against exact counts."""

import bisect
import random

from fieldspark.operators.profile_state import DISTINCT_ERROR, RANK_ERROR, ProfileState
from fieldspark.sources.tables import Warehouse

COLUMNS = ["v", "s", "none"]


def rows(months, n, seed=3):
    rng = random.Random(seed)
    return [(m, None if rng.random() < 0.1 else rng.gauss(m, 5), f"s{rng.randrange(4_000)}", None) for m in months for _ in range(n)]


def frame(spark, some):
    return spark.createDataFrame(some, "month int, v double, s string, none string").repartition(4)


def check(state, some):
    found = {r.column_name: r for r in state.report().collect()}
    for i, c in enumerate(COLUMNS, 1):
        values = [r[i] for r in some if r[i] is not None]
        got, exact = found[c], len(set(values))
        assert (got.parts, got.row_count, got.null_count) == (len({r[0] for r in some}), len(some), len(some) - len(values))
        assert abs(got.distinct_values - exact) <= DISTINCT_ERROR * exact
    numbers, got = sorted(r[1] for r in some if r[1] is not None), found["v"]
    assert (got.least, got.most) == (numbers[0], numbers[-1])
    for p, value in ((0.25, got.q1), (0.5, got.median), (0.75, got.q3)):
        assert abs(bisect.bisect_right(numbers, value) / len(numbers) - p) <= RANK_ERROR
    assert found["s"].least is None and found["s"].median is None


def test_a_grown_table_reads_its_new_parts_only(spark, tmp_path):
    state = ProfileState(Warehouse(spark, str(tmp_path)), "t")
    first, more = rows([1, 2, 3], 3_000), rows([4, 5], 2_000, 4)
    assert state.add(frame(spark, first), "month", COLUMNS) == 3
    check(state, first)
    # rows of known parts are changed on the way in: they must not be looked at
    spoilt = [(m, 1e9, "spoilt", "x") for m, *_ in first]
    assert state.add(frame(spark, spoilt + more), "month", COLUMNS) == 2
    check(state, first + more)
    assert state.add(frame(spark, spoilt + more), "month", COLUMNS) == 0
    check(state, first + more)


def test_changed_parts_are_read_again(spark, tmp_path):
    state = ProfileState(Warehouse(spark, str(tmp_path)), "t")
    first, late = rows([1, 2], 1_500), rows([2], 500, 9)
    state.add(frame(spark, first), "month", COLUMNS)
    assert state.add(frame(spark, first + late), "month", COLUMNS, changed=["2"]) == 1
    check(state, first + late)
    assert state.parts() == {"1", "2"}


def test_rows_without_a_part_are_one(spark, tmp_path):
    state = ProfileState(Warehouse(spark, str(tmp_path)), "t")
    df = spark.createDataFrame([(None, 1.0, "a", None), (1, 2.0, "b", None)], "month int, v double, s string, none string")
    assert state.add(df, "month", COLUMNS) == 2
    assert state.add(df, "month", COLUMNS) == 0
    assert state.parts() == {None, "1"}
    assert {r.parts for r in state.report().collect()} == {2}
