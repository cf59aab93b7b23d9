"""Seeded frames and a plain-Python enrichment of one frame, to compare with."""

import math
import random

BRONZE_SCHEMA = (
    "match_id string, game_section string, frame_id bigint, team_id string, person_id string, x double, y double, "
    "x_norm double, y_norm double, distance double, speed double, acceleration double, ball_possession string, "
    "ball_status int"
)


def frame(seed, match="M", section="firstHalf", number=10000, status=1, holder="H"):
    """22 players, the ball and a referee."""
    rng = random.Random(seed)
    rows = []

    def row(team, person):
        x, y = round(rng.uniform(-52.5, 52.5), 2), round(rng.uniform(-34, 34), 2)
        rows.append([
            match, section, number, team, person, x, y, round(x + 52.5, 2), round(34 - y, 2),
            round(rng.uniform(0, 9000), 3), round(rng.uniform(0, 9), 3), round(rng.uniform(-9, 9), 3), holder, status,
        ])

    for team in ("H", "G"):
        for slot in range(11):
            row(team, f"{team}{slot:02d}")
    row("BALL", None)
    row("referee", None)
    return rows


def degenerate():
    """One team only, without one id and one coordinate."""
    rows = [r for r in frame(7) if r[3] != "G"]
    rows[0][4] = None
    rows[1][5] = rows[1][7] = float("nan")
    return rows


def finite(value):
    return value is not None and math.isfinite(value)


def enrich(rows, target=(105.0, 34.0), x=5, y=6, fill=True):
    """Greedy one-to-one pairing in the order of distance, kept where both are each other's nearest."""
    rows = [list(r) for r in rows]
    balls = [r for r in rows if r[3] == "BALL"]
    ball = balls[0] if balls else None
    holder = ball[12] if ball else None
    place = {id(r): finite(r[7]) and finite(r[8]) for r in rows}
    results = {}
    for r in rows:
        if fill and ball:
            r[12] = r[12] if ball[12] is None else ball[12]
            r[13] = r[13] if ball[13] is None else ball[13]
        out = dict(ball_distance=None, has_possession=False, pair=None, pair_distance=None, closest=None, target=None)
        if place[id(r)]:
            out["target"] = math.sqrt((r[7] - target[0]) ** 2 + (r[8] - target[1]) ** 2)
            if ball and finite(ball[x]) and finite(ball[y]):
                out["ball_distance"] = math.sqrt((r[x] - ball[x]) ** 2 + (r[y] - ball[y]) ** 2)
        out["possession"], out["status"] = r[12], r[13]
        results[(r[3], r[4])] = out
    near = [
        (results[(r[3], r[4])]["ball_distance"], r[4], r[3]) for r in rows
        if holder and r[3] == holder and r[4] and results[(r[3], r[4])]["ball_distance"] is not None
    ]
    if near:
        _, person, team = min(near)
        results[(team, person)]["has_possession"] = True
    players = [r for r in rows if r[3] not in ("BALL", "referee") and r[4] and place[id(r)]]
    teams = sorted({r[3] for r in players})[:2]
    if len(teams) == 2:
        a, b = ([r for r in players if r[3] == t] for t in teams)
        d = {(p[4], q[4]): math.sqrt((p[x] - q[x]) ** 2 + (p[y] - q[y]) ** 2) for p in a for q in b}
        for p in a:
            results[(p[3], p[4])]["closest"] = min(d[p[4], q[4]] for q in b)
        for q in b:
            results[(q[3], q[4])]["closest"] = min(d[p[4], q[4]] for p in a)
        used = set()
        for (p, q), gap in sorted(d.items(), key=lambda item: (item[1], item[0])):
            if p in used or q in used:
                continue
            used |= {p, q}
            left, right = results[(teams[0], p)], results[(teams[1], q)]
            if gap == left["closest"] == right["closest"]:
                left["pair"], left["pair_distance"] = q, gap
                right["pair"], right["pair_distance"] = p, gap
    return results
