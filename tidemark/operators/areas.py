"""Polygons against points and cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ring_edges(ring: Column) -> Column:
    """Edges (ax, ay, bx, by) of a ring, an array of (x, y), closed at its first vertex."""
    return F.zip_with(ring, F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1)), lambda a, b: F.struct(a.x.alias("ax"), a.y.alias("ay"), b.x.alias("bx"), b.y.alias("by")))


def contains(ring: Column, x: Column, y: Column) -> Column:
    """Whether a ray to the right of (x, y) crosses the ring an odd number of times; edges are half-open in y."""

    def crossed(e: Column) -> Column:
        return ((e.ay > y) != (e.by > y)) & (x < e.ax + (y - e.ay) * (e.bx - e.ax) / (e.by - e.ay))

    return F.size(F.filter(ring_edges(ring), crossed)) % 2 == 1


def area(ring: Column) -> Column:
    return F.abs(F.aggregate(ring_edges(ring), F.lit(0.0), lambda s, e: s + e.ax * e.by - e.bx * e.ay)) / 2.0


def bounds(ring: Column) -> dict[str, Column]:
    axis = lambda f, k: f(F.transform(ring, lambda v: v[k]))
    return {"x0": axis(F.array_min, "x"), "x1": axis(F.array_max, "x"), "y0": axis(F.array_min, "y"), "y1": axis(F.array_max, "y")}


def points_in_polygons(points: DataFrame, polygons: DataFrame, cell: float) -> DataFrame:
    """Rows of ``points`` (x, y) and ``polygons`` (ring) that hold them; polygons are copied to the cells under their bounds."""
    b = bounds(F.col("ring"))
    at = lambda c: F.floor(c / cell)
    rows = polygons.select("*", F.explode(F.sequence(at(b["x0"]), at(b["x1"]))).alias("_i")).select("*", F.explode(F.sequence(at(b["y0"]), at(b["y1"]))).alias("_j"))
    met = points.withColumns({"_i": at(F.col("x")), "_j": at(F.col("y"))}).join(rows, ["_i", "_j"]).drop("_i", "_j")
    return met.where(contains(F.col("ring"), F.col("x"), F.col("y")))


def rasterized(polygons: DataFrame, cell: float, id_: str) -> DataFrame:
    """(i, j, id): cells whose centre a polygon holds; the smallest wins, then the lower id."""
    b = bounds(F.col("ring"))
    at = lambda c: F.floor(c / cell)
    cells = polygons.select(id_, "ring", F.explode(F.sequence(at(b["x0"]), at(b["x1"]))).alias("i")).select("*", F.explode(F.sequence(at(b["y0"]), at(b["y1"]))).alias("j"))
    held = cells.where(contains(F.col("ring"), (F.col("i") + 0.5) * cell, (F.col("j") + 0.5) * cell))
    return held.groupBy("i", "j").agg(F.min_by(id_, F.struct(area(F.col("ring")).alias("a"), F.col(id_).alias("id"))).alias(id_))
