import random

import pytest
from pyspark.sql import functions as F

from touchline.operators import ranked, runs


def _frames(seed, gaps=True):
    rng = random.Random(seed)
    rows, number = [], 10
    for _ in range(120):
        number += rng.choice([1, 1, 1, 2, 9]) if gaps else 1
        rows.append((rng.choice(["a", "b", None]), number, rng.randint(1, 9)))
    return rows


def _frame(spark, rows):
    return spark.createDataFrame([("k", *r) for r in rows], "key string, team string, at bigint, v bigint")


def _aggregates():
    return {"n": F.count(F.lit(1)), "total": F.sum("v")}, {"n": F.sum("n"), "total": F.sum("total")}


def _plain_runs(rows, follows):
    found = []
    for row in rows:
        if found and follows(found[-1][-1], row):
            found[-1].append(row)
        else:
            found.append([row])
    return sorted(
        [(r[0][0] or "", r[0][1], r[-1][1], len(r), sum(x[2] for x in r)) for r in found]
    )


def _collected(df):
    return sorted((r.team or "", r.run_start, r.run_end, r.n, r.total) for r in df.collect())


@pytest.mark.parametrize("width", [3, 7, 8192])
def test_consecutive_runs_match_a_plain_scan(spark, width):
    rows = _frames(1)
    partials, merges = _aggregates()
    got = runs.consecutive_runs(_frame(spark, rows), ["key", "team"], "at", partials, merges, width)
    want = []
    for team in ("a", "b", None):
        own = [r for r in rows if r[0] == team]
        want += _plain_runs(own, lambda p, q: q[1] == p[1] + 1)
    assert _collected(got) == sorted(want)


@pytest.mark.parametrize("width", [3, 7, 8192])
def test_value_runs_ignore_gaps(spark, width):
    rows = _frames(2)
    partials, merges = _aggregates()
    got = runs.value_runs(_frame(spark, rows), ["key"], "at", "team", partials, merges, width)
    assert _collected(got) == _plain_runs(rows, lambda p, q: p[0] == q[0])


@pytest.mark.parametrize("width", [4, 8192])
def test_one_long_run_over_many_blocks(spark, width):
    rows = [("a", n, 1) for n in range(5, 105)]
    partials, merges = _aggregates()
    for op in (
        runs.consecutive_runs(_frame(spark, rows), ["key", "team"], "at", partials, merges, width),
        runs.value_runs(_frame(spark, rows), ["key"], "at", "team", partials, merges, width),
    ):
        assert _collected(op) == [("a", 5, 104, 100, 100)]


@pytest.mark.parametrize("width", [3, 8192])
def test_running_totals(spark, width):
    rows = _frames(3)
    got = runs.running_totals(
        _frame(spark, rows), ["key"], "at", {"so_far": F.col("v"), "place": F.lit(1)}, width
    )
    total, want = 0, []
    for place, row in enumerate(rows, 1):
        total += row[2]
        want.append((row[1], total, place))
    assert sorted((r["at"], r.so_far, r.place) for r in got.collect()) == want


@pytest.mark.parametrize("width", [3, 8192])
def test_previous_values_with_gap_reset(spark, width):
    rows = _frames(4)
    got = runs.previous_values(_frame(spark, rows), ["key"], "at", {"before": "v"}, max_gap=2, width=width)
    want = [(rows[0][1], None)]
    for p, q in zip(rows, rows[1:]):
        want.append((q[1], p[2] if q[1] - p[1] <= 2 else None))
    assert sorted((r["at"], r.before) for r in got.collect()) == want


def test_kth_row_limits_before_the_shuffle(spark):
    rows = _frame(spark, _frames(5))
    second = ranked.kth_row(rows, ["key", "team"], [F.col("v"), F.col("at")], 1)
    plan = second._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    want = {}
    for team, at, v in _frames(5):
        want.setdefault(team, []).append((v, at))
    assert {r.team: (r.v, r["at"]) for r in second.collect()} == {t: sorted(x)[1] for t, x in want.items()}
