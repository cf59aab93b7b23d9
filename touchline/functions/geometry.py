"""Coordinate expressions; all of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(value: Column) -> Column:
    """True for a present, ordinary number; never NULL."""
    return F.coalesce((F.abs(value) < F.lit(float("inf"))) & ~F.isnan(value), F.lit(False))


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    dx, dy = ax - bx, ay - by
    return F.sqrt(dx * dx + dy * dy)


def distance_to_point(x: Column, y: Column, point: tuple[float, float]) -> Column:
    """Distance to a fixed point, NULL unless both coordinates are finite."""
    px, py = F.lit(float(point[0])), F.lit(float(point[1]))
    return F.when(is_finite(x) & is_finite(y), distance(x, y, px, py))


def normalise_x(x: Column, direction: Column, pitch_x: Column) -> Column:
    """Pitch coordinate with the own goal at 0; an unknown direction counts as -1."""
    from_left = x + pitch_x / F.lit(2.0)
    return F.round(F.when(direction == 1, from_left).otherwise(pitch_x - from_left), 2)


def normalise_y(y: Column, direction: Column, pitch_y: Column) -> Column:
    from_top = -y + pitch_y / F.lit(2.0)
    return F.round(F.when(direction == 1, from_top).otherwise(pitch_y - from_top), 2)


def third(value: Column, extent: Column, names: tuple[str, str, str]) -> Column:
    """Name of the third of ``[0, extent]`` that holds the value; outside counts to the edge."""
    return (
        F.when(value.isNull() | extent.isNull(), F.lit(None).cast("string"))
        .when(value * 3 < extent, names[0])
        .when(value * 3 < extent * 2, names[1])
        .otherwise(names[2])
    )
