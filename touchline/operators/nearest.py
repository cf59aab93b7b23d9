"""Nearest opponents and mutual nearest pairs within a group.

Two exact ways with the same result. An ordinary group (a frame has some two dozen rows) is
gathered into one row and searched with array functions, without a row per pair. A group
above a row limit is never gathered. Its rows meet the opponents of their tile and of a margin
around it, which decides all that have one within the margin. The rest is searched through nested
grid cells, where a pair of cells that cannot hold a nearest pair is dropped before its contents
are looked at.

Ties for the nearest opponent go to the smaller person id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.geometry import distance
from touchline.operators.lineage import checkpointed, stored

# Edge lengths of the grid cells in metres, coarse to fine; each divides the one before.
CELL_SIZES = (64.0, 8.0, 1.0, 0.125, 0.015625)
# Opponents up to which all rows of a tile are compared with all of them; evenly spread ones are some 70.
TILE_OPPONENTS = 512


def crowded_groups(rows: DataFrame, keys: list[str], max_rows: int) -> DataFrame:
    """Keys of the groups above the limit; the counts are combined before the shuffle."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_rows).select(*keys)


# --- ordinary groups: arrays ---------------------------------------------------
def gather(rows: DataFrame, keys: list[str], who: str, team: str = "team_id", **also: Column) -> DataFrame:
    """One row per group: its rows as ``_rows``, the teams of those flagged by ``who``, and ``also``."""
    others = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(
        F.collect_list(F.struct(*others)).alias("_rows"),
        F.array_sort(F.collect_set(F.when(F.col(who), F.col(team)))).alias("_teams"),
        *[column.alias(name) for name, column in also.items()],
    )


def _nearest_of(side: Column, others: Column, x: str, y: str, person: str) -> Column:
    """For each row of a side the smallest (distance, person) among the others, with its place there."""

    def nearest(row: Column) -> Column:
        return F.array_min(
            F.transform(
                others,
                lambda other, place: F.struct(
                    distance(row[x], row[y], other[x], other[y]).alias("d"),
                    other[person].alias("person"),
                    place.alias("place"),
                ),
            )
        )

    return F.transform(side, nearest)


def pair_gathered(
    groups: DataFrame, who: str, x: str, y: str, team: str = "team_id", person: str = "person_id"
) -> DataFrame:
    """Gathered groups back as rows, with the pair columns and the nearest opponent's id.

    Only the two smallest team ids of a group oppose each other. Each distance is computed once
    per direction and group. The generator at the end keeps later filters above the search:
    through projections they would be pushed down with copies of it.
    """
    carried = [c for c in groups.columns if c not in ("_rows", "_teams")]
    first, second = F.get("_teams", F.lit(0)), F.get("_teams", F.lit(1))

    def members(of: Column) -> Column:
        return F.filter("_rows", lambda row: row[who] & F.coalesce(row[team] == of, F.lit(False)))

    def is_rest(row: Column) -> Column:
        plays = (row[team] == first) | (row[team] == second)
        return ~(row[who] & F.coalesce(plays, F.lit(False)))

    sides = groups.select(
        *carried, members(first).alias("_a"), members(second).alias("_b"), F.filter("_rows", is_rest).alias("_rest")
    )
    found = sides.withColumns(
        {
            "_near_a": _nearest_of(F.col("_a"), F.col("_b"), x, y, person),
            "_near_b": _nearest_of(F.col("_b"), F.col("_a"), x, y, person),
        }
    )

    def entries(side: str, near: str, opposite: str) -> Column:
        def entry(row: Column, place: Column) -> Column:
            own = F.get(near, place)
            back = F.get(opposite, own["place"])["person"]
            return F.struct(
                row.alias("_row"), own["d"].alias("_d"), own["person"].alias("_person"),
                (back == row[person]).alias("_mutual"),
            )

        return F.transform(side, entry)

    def alone(row: Column) -> Column:
        nothing = F.lit(None)
        return F.struct(
            row.alias("_row"), nothing.cast("double").alias("_d"), nothing.cast("string").alias("_person"),
            nothing.cast("boolean").alias("_mutual"),
        )

    everyone = F.concat(
        entries("_a", "_near_a", "_near_b"), entries("_b", "_near_b", "_near_a"), F.transform("_rest", alone)
    )
    return found.select(*carried, F.inline(everyone)).select(
        *carried,
        "_row.*",
        F.when(F.col("_mutual"), F.col("_person")).alias("pair_player_id"),
        F.when(F.col("_mutual"), F.col("_d")).alias("pair_player_distance"),
        F.col("_d").alias("closest_opponent_distance"), F.col("_person").alias("closest_opponent_id"),
    )


# --- crowded groups: nested cells -----------------------------------------------
def _cell(level: int, prefix: str) -> list[Column]:
    size = F.lit(CELL_SIZES[level])
    return [
        F.floor(F.col("x") / size).alias(f"{prefix}cx{level}"),
        F.floor(F.col("y") / size).alias(f"{prefix}cy{level}"),
    ]


def _cell_names(level: int, prefix: str) -> list[str]:
    return [f"{prefix}cx{level}", f"{prefix}cy{level}"]


def _cells(sites: DataFrame, keys: list[str], level: int, prefix: str) -> DataFrame:
    """Occupied cells of a level, with the box around their sites and the cell above."""
    above = _cell(level - 1, prefix) if level else []
    up = _cell_names(level - 1, prefix) if level else []
    return (
        sites.select(*keys, F.col("side").alias(f"{prefix}side"), *above, *_cell(level, prefix), "x", "y")
        .groupBy(*keys, f"{prefix}side", *up, *_cell_names(level, prefix))
        .agg(
            F.min("x").alias(f"{prefix}x0"), F.max("x").alias(f"{prefix}x1"),
            F.min("y").alias(f"{prefix}y0"), F.max("y").alias(f"{prefix}y1"),
        )
    )


def _within_reach(pairs: DataFrame, keys: list[str], level: int) -> DataFrame:
    """Drops opposing cells that are farther than the nearest one can be at most."""

    def gap(axis: str) -> Column:
        return F.greatest(
            F.lit(0.0),
            F.col(f"o{axis}0") - F.col(f"p{axis}1"),
            F.col(f"p{axis}0") - F.col(f"o{axis}1"),
        )

    def span(axis: str) -> Column:
        return F.greatest(F.col(f"o{axis}1") - F.col(f"p{axis}0"), F.col(f"p{axis}1") - F.col(f"o{axis}0"))

    def length(dx: Column, dy: Column) -> Column:
        return F.sqrt(dx * dx + dy * dy)

    measured = pairs.withColumns(
        {"_low": length(gap("x"), gap("y")), "_high": length(span("x"), span("y"))}
    )
    own_cell = [*keys, "pside", *_cell_names(level, "p")]
    reach = measured.groupBy(*own_cell).agg(F.min("_high").alias("_reach"))
    # Room for the last bit of rounding in the two roots.
    near = F.col("_low") <= F.col("_reach") * F.lit(1 + 1e-9)
    return measured.join(reach, own_cell).filter(near).select(*own_cell, *_cell_names(level, "o"))


def _in_tiles(sites: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, side, x, y, _nearest`` of the sites with an opponent nearer than the margin of their tile.

    The margin is a power of two, so wide that some six opponents lie within it where the group's sites are spread evenly; a tile is four
    margins long. A site beyond a margin is not nearer than it, so what is found below it is the nearest. Only sites are dealt, each opponent
    to the one to four tiles it is in reach of; pairs are compared where they meet and leave as one row for each site.
    """
    box = sites.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), (F.max("x") - F.min("x")).alias("_w"), (F.max("y") - F.min("y")).alias("_h")
    )
    length = F.greatest("_w", "_h")
    area = F.when(F.least("_w", "_h") > 0, F.col("_w") * F.col("_h")).when(length > 0, length * length).otherwise(1.0)
    margin = F.pow(F.lit(2.0), F.round(F.log2(F.sqrt(area * 4 / F.col("_n")))))
    placed = sites.join(box.select(*keys, margin.alias("_m")), keys)
    tile = [*keys, "side", "_tx", "_ty"]

    def at(value: Column) -> Column:
        return F.floor(value / (F.col("_m") * 4))

    def reached(axis: str) -> Column:
        return F.explode(F.array_distinct(F.array(at(F.col(axis) - F.col("_m")), at(F.col(axis) + F.col("_m")))))

    own = placed.select(*keys, "side", at(F.col("x")).alias("_tx"), at(F.col("y")).alias("_ty"), "x", "y", "_m")
    across = placed.withColumn("_tx", reached("x"))
    others = across.withColumn("_ty", reached("y")).select(
        *keys, (1 - F.col("side")).alias("side"), "_tx", "_ty", F.col("x").alias("ox"), F.col("y").alias("oy"), "person"
    )
    few = others.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*tile))).filter(F.col("_n") <= TILE_OPPONENTS)
    gap = distance(F.col("x"), F.col("y"), F.col("ox"), F.col("oy"))
    met = own.join(few, tile).select(*keys, "side", "x", "y", "_m", F.struct(gap.alias("d"), "person", "ox", "oy").alias("_pair"))
    near = met.filter(F.col("_pair.d") < F.col("_m"))
    return near.groupBy(*keys, "side", "x", "y").agg(F.min("_pair").alias("_nearest"))


def nearest_by_cells(players: DataFrame, keys: list[str], team: str, person: str, x: str, y: str) -> DataFrame:
    """Nearest opponent of each player: ``keys, team, person, x, y, opponent, ..., distance``.

    ``players`` holds located players only. Equal positions of a team are looked up once, and
    repeats of a player at one position give one row.
    """
    rivals = (
        players.groupBy(*keys, team).agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(*keys).agg(F.slice(F.array_sort(F.collect_set(team)), 1, 2).alias("_rivals"))
    )
    side = F.array_position("_rivals", F.col(team)).cast("int") - 1
    sided = (
        players.join(rivals, keys)
        .select(*keys, F.col(team), F.col(person), F.col(x).alias("x"), F.col(y).alias("y"), side.alias("side"))
        .filter(F.col("side") >= 0)
        .distinct()
    )
    sided = stored(sided)
    sites = sided.groupBy(*keys, "side", "x", "y").agg(F.min(person).alias("person"))

    close = stored(_in_tiles(sites, keys))
    rest = checkpointed(sites.join(close.select(*keys, "side", "x", "y"), [*keys, "side", "x", "y"], "left_anti"))

    opposite = F.col("oside") == 1 - F.col("pside")
    pairs = _cells(rest, keys, 0, "p").join(_cells(sites, keys, 0, "o"), keys).filter(opposite)
    pairs = _within_reach(pairs, keys, 0)
    for level in range(1, len(CELL_SIZES)):
        own, other = _cells(rest, keys, level, "p"), _cells(sites, keys, level, "o")
        pairs = (
            pairs.join(own, [*keys, "pside", *_cell_names(level - 1, "p")])
            .join(other, [*keys, *_cell_names(level - 1, "o")])
            .filter(opposite)
        )
        pairs = checkpointed(_within_reach(pairs, keys, level))

    last = len(CELL_SIZES) - 1

    def leaves(of: DataFrame, prefix: str) -> DataFrame:
        return of.select(
            *keys, F.col("side").alias(f"{prefix}side"), *_cell(last, prefix),
            F.col("x").alias(f"{prefix}x"), F.col("y").alias(f"{prefix}y"), F.col("person").alias(f"{prefix}person"),
        )

    gap = distance(F.col("px"), F.col("py"), F.col("ox"), F.col("oy"))
    found = (
        pairs.join(leaves(rest, "p"), [*keys, "pside", *_cell_names(last, "p")])
        .join(leaves(sites, "o"), [*keys, *_cell_names(last, "o")])
        .filter(opposite)
        .groupBy(*keys, F.col("pside").alias("side"), F.col("px").alias("x"), F.col("py").alias("y"))
        .agg(F.min(F.struct(gap.alias("d"), F.col("operson").alias("person"), "ox", "oy")).alias("_nearest"))
    )
    return stored(
        sided.join(close.unionByName(found), [*keys, "side", "x", "y"]).select(
            *keys, team, person, "side", "x", "y",
            F.col("_nearest.person").alias("opponent"),
            F.col("_nearest.ox").alias("opponent_x"),
            F.col("_nearest.oy").alias("opponent_y"),
            F.col("_nearest.d").alias("distance"),
        )
    )


def pair_by_cells(
    rows: DataFrame, keys: list[str], who: Column, x: str, y: str, team: str = "team_id", person: str = "person_id"
) -> DataFrame:
    """Adds the pair columns and the nearest opponent's id by the cell search; for groups of any size."""
    players = rows.filter(who).select(*keys, team, person, x, y)
    nearest = nearest_by_cells(players, keys, team, person, x, y)
    at = [*keys, "side", "opponent", "opponent_x", "opponent_y"]
    back = nearest.select(
        *keys,
        (1 - F.col("side")).alias("side"),
        F.col(person).alias("opponent"),
        F.col("x").alias("opponent_x"),
        F.col("y").alias("opponent_y"),
        F.col("opponent").alias("_back"),
    )
    paired = nearest.join(back, at, "left")
    mutual = F.col("_back") == F.col(person)
    result = paired.select(
        *keys, team, person, F.col("x").alias(x), F.col("y").alias(y),
        F.when(mutual, F.col("opponent")).alias("pair_player_id"),
        F.when(mutual, F.col("distance")).alias("pair_player_distance"),
        F.col("distance").alias("closest_opponent_distance"), F.col("opponent").alias("closest_opponent_id"),
    )
    # Rows without a place find no partner: their coordinates are NULL or no numbers.
    placed = rows.withColumn("_placed", who)
    joined = placed.alias("l").join(
        result.withColumn("_placed", F.lit(True)).alias("r"), [*keys, team, person, x, y, "_placed"], "left"
    )
    return joined.select(
        *rows.columns, "pair_player_id", "pair_player_distance", "closest_opponent_distance", "closest_opponent_id"
    )
