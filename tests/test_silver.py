import math
import random

import pytest
from football import BRONZE_SCHEMA, degenerate, enrich, frame
from pyspark.sql import functions as F

from touchline import schemas
from touchline.operators import frames, shape
from touchline.plans import gold, grouped, silver


def _cases():
    seven = [r for n in range(7) for r in frame(100 + n, number=10000 + n)]
    return {
        "single": frame(1),
        "three": [r for n in range(3) for r in frame(n, number=10000 + n)],
        "halves": [
            r for m in ("A", "B") for s, n in (("firstHalf", 10000), ("secondHalf", 100000))
            for r in frame(hash((m, s)) % 1000, match=m, section=s, number=n)
        ],
        "degenerate": degenerate(),
        "chunks": seven,
    }


def _ours(df):
    return {
        (r.match_id, r.frame_id, r.team_id, r.person_id): (
            r.ball_distance, r.has_possession, r.pair_player_id, r.pair_player_distance,
            r.closest_opponent_distance, r.target_distance, r.ball_possession, r.ball_status,
        )
        for r in df.collect()
    }


def _close(a, b):
    if a is None or b is None or not isinstance(a, float):
        return a == b
    return math.isclose(a, b, abs_tol=5.1e-4)


def _check(rows, got, keep, **options):
    by_frame = {}
    for r in rows:
        if keep(r):
            by_frame.setdefault((r[0], r[2]), []).append(r)
    want = {}
    for key, members in by_frame.items():
        for (team, person), o in enrich(members, **options).items():
            want[(*key, team, person)] = (
                o["ball_distance"], o["has_possession"], o["pair"], o["pair_distance"], o["closest"], o["target"],
                o["possession"], o["status"],
            )
    assert set(got) == set(want)
    for key, values in want.items():
        assert all(_close(g, w) for g, w in zip(got[key], values)), (key, got[key], values)


def _batch_row(r):
    return r[3] != "referee" and (r[4] is not None or r[3] == "BALL")


def _stream_row(r):
    return r[4] is not None or r[3] in ("BALL", "referee")


@pytest.mark.parametrize("name", list(_cases()))
def test_batch_enrichment_equals_a_greedy_scan(spark, name):
    rows = _cases()[name]
    df = spark.createDataFrame(rows, BRONZE_SCHEMA)
    if name == "chunks":
        df = df.repartition(5)
    result = silver.silver_positions(df)
    assert result.columns == schemas.SILVER_COLUMNS
    _check(rows, _ours(result), _batch_row)


def test_stream_enrichment_equals_a_greedy_scan(spark):
    rows = _cases()["halves"] + degenerate()
    df = spark.createDataFrame(rows, BRONZE_SCHEMA)
    result = silver.silver_positions(df, silver.STREAM, batch_id=3)
    assert result.columns == [*schemas.SILVER_STREAM_COLUMNS, "stream_batch_id"]
    _check(rows, _ours(result), _stream_row, target=(52.5, 34.0), x=7, y=8, fill=False)


def test_crowded_frames_have_the_same_result(spark):
    rows = _cases()["three"] + [[*r[:2], 10900, *r[3:]] for r in degenerate()]
    rows += [list(r) for r in rows if r[4] == "H03"]
    # A far larger frame, with equal positions and two far clusters.
    rng = random.Random(5)
    for slot in range(60):
        team = rng.choice(["H", "G"])
        x, y = (rng.choice([-50.0, 50.0, 0.0]) + rng.randint(0, 3) / 100, rng.randint(-3, 3) / 10)
        rows.append(["M", "firstHalf", 20000, team, f"P{slot:03d}", x, y, x + 52.5, 34 - y, 1.0, 1.0, 0.0, "H", 1])
    df = spark.createDataFrame(rows, BRONZE_SCHEMA)
    ordinary = _ours(silver.silver_positions(df, max_frame_rows=1000))
    large = silver.silver_positions(df, max_frame_rows=25)
    assert _ours(large) == ordinary and large.count() == len([r for r in rows if _batch_row(r)])
    assert sum(1 for v in ordinary.values() if v[2] is not None) > 20


def test_cell_search_equals_brute_force(spark):
    from touchline.operators.nearest import nearest_by_cells

    rng = random.Random(11)
    people = [
        ("g", rng.choice("AB"), f"p{i:04d}", rng.gauss(0, 300), rng.choice([rng.gauss(0, 1), rng.uniform(-80, 80)]))
        for i in range(300)
    ]
    df = spark.createDataFrame(people, "grp string, team string, who string, x double, y double")
    got = {
        r.who: (r.opponent, r.distance)
        for r in nearest_by_cells(df, ["grp"], "team", "who", "x", "y").collect()
    }
    for _, team, who, x, y in people:
        gap, other = min(
            (math.sqrt((x - q[3]) * (x - q[3]) + (y - q[4]) * (y - q[4])), q[2]) for q in people if q[1] != team
        )
        assert got[who] == (other, gap)


def test_tiles_decide_nearly_all_of_a_crowded_frame(spark):
    from touchline.operators.nearest import _in_tiles, nearest_by_cells

    rng = random.Random(12)
    # Evenly spread on a pitch, on a grid of centimetres with ties, all at one point, and in two far clusters.
    spread = {
        "even": [(rng.uniform(0, 105), rng.uniform(0, 68)) for _ in range(1200)],
        "grid": [(rng.randrange(30) / 100, rng.randrange(30) / 100) for _ in range(600)],
        "point": [(3.0, 4.0)] * 4,
        "far": [(rng.gauss(n % 2 * 1e6, 1e-3), 0.0) for n in range(200)],
    }
    people = [(g, "AB"[i // 2 % 2], f"p{i:04d}", x, y) for g, places in spread.items() for i, (x, y) in enumerate(places)]
    df = spark.createDataFrame(people, "grp string, team string, who string, x double, y double")
    got = {(r.grp, r.who): (r.opponent, r.distance) for r in nearest_by_cells(df, ["grp"], "team", "who", "x", "y").collect()}
    assert len(got) == len(people)
    for group in spread:
        members = [p for p in people if p[0] == group]
        for _, team, who, x, y in members:
            gap, other = min((math.sqrt((x - q[3]) * (x - q[3]) + (y - q[4]) * (y - q[4])), q[2]) for q in members if q[1] != team)
            assert got[group, who] == (other, gap)
    sites = df.filter("grp = 'even'").selectExpr("grp", "cast(team = 'B' as int) AS side", "x", "y", "who AS person")
    assert _in_tiles(sites, ["grp"]).count() > 0.95 * 1200


def test_no_ball_no_distance_but_pairs(spark):
    rows = [r for r in frame(3) if r[3] != "BALL"]
    for r in rows:
        r[12], r[13] = None, 0
    got = silver.silver_positions(spark.createDataFrame(rows, BRONZE_SCHEMA)).collect()
    assert all(r.ball_distance is None and not r.has_possession for r in got)
    assert any(r.pair_player_id for r in got) and all(r.closest_opponent_distance for r in got)


def test_ball_without_position_and_fill_down(spark):
    rows = frame(4, status=2, holder="G")
    for r in rows:
        if r[3] == "BALL":
            r[5] = r[6] = r[7] = r[8] = float("nan")
        else:
            r[12], r[13] = None, None
    got = silver.silver_positions(spark.createDataFrame(rows, BRONZE_SCHEMA)).collect()
    assert all(r.ball_distance is None and not r.has_possession for r in got)
    assert {(r.ball_possession, r.ball_status) for r in got} == {("G", 2)}


def test_ties_go_to_the_smaller_id_on_both_sides(spark):
    rows = [r for r in frame(8) if r[3] in ("BALL", "referee")]
    for team, person, x, y in (("H", "h1", 0, 0), ("H", "h2", 0, 2), ("G", "g1", 0, 1), ("G", "g2", 0, -1)):
        rows.append(["M", "firstHalf", 10000, team, person, float(x), float(y), x + 52.5, 34.0 - y, 1.0, 1.0, 0.0, "H", 1])
    got = silver.silver_positions(spark.createDataFrame(rows, BRONZE_SCHEMA))
    assert {r.person_id: r.pair_player_id for r in got.filter("team_id in ('H','G')").collect()} == {
        "h1": "g1", "g1": "h1", "h2": None, "g2": None,
    }


def test_strict_ids_drop_a_ball_without_one(spark):
    df = spark.createDataFrame(frame(2), BRONZE_SCHEMA)
    assert silver.identified(df).filter("team_id = 'BALL'").count() == 1
    assert silver.identified(df, strict=True).count() == 22


def test_translating_frames_changes_nothing(spark):
    df = spark.createDataFrame(_cases()["three"], BRONZE_SCHEMA)
    moved = df.withColumn("frame_id", F.col("frame_id") + 5000).orderBy(F.rand(3))
    plain, other = _ours(silver.silver_positions(df)), _ours(silver.silver_positions(moved))
    assert {(m, f + 5000, t, p): v for (m, f, t, p), v in plain.items()} == other


def test_rows_are_shuffled_once(spark, folder):
    spark.createDataFrame(_cases()["three"], BRONZE_SCHEMA).write.parquet(folder + "/b")
    result = silver.silver_positions(spark.read.parquet(folder + "/b"))
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "CartesianProduct" not in plan


@pytest.mark.parametrize("limit", [512, 3])
def test_halves_that_share_frame_numbers_are_enriched_apart(spark, limit):
    halves = [[r for n in range(3) for r in frame(seed + n, section=section, number=100000 + n)] for seed, section in ((1, "firstHalf"), (11, "secondHalf"), (21, None))]

    def enriched(rows, flavour):
        found = silver.silver_positions(spark.createDataFrame(rows, BRONZE_SCHEMA), flavour, max_frame_rows=limit)
        return sorted(map(str, found.collect()))

    for flavour in (silver.BATCH, silver.STREAM):
        assert enriched([r for half in halves for r in half], flavour) == sorted(line for half in halves for line in enriched(half, flavour))


def test_frame_operators_keep_halves_apart(spark):
    halves = [
        [r for n in range(3) for r in frame(seed + n, section=section, number=100000 + n, holder=holder)]
        for seed, section, holder in ((1, "firstHalf", "H"), (11, "secondHalf", "G"), (21, None, "H"))
    ]

    def lagged(rows):
        return shape.with_lags(frames.ball_distance(rows))

    def held(rows):
        return grouped.possession_frames(grouped.grouped_positions(silver.silver_positions(rows, silver.STREAM)))

    for step in (frames.fill_down, frames.ball_carriers, lagged, gold.frame_summary, held):
        whole, *parts = (
            sorted(map(str, step(spark.createDataFrame(rows, BRONZE_SCHEMA)).collect())) for rows in ([r for half in halves for r in half], *halves)
        )
        assert whole == sorted(line for part in parts for line in part), step
