"""Frame products: which points a camera sees, at what range, and what its images and masks say about them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import rotations as Q
from tidemark.functions import scalars as S
from tidemark.operators import raster as R
from tidemark.operators.joins import range_join

#: Ranges of use (m), time window of a frame's candidates (s), splat radius: factor, least and most cells.
R_MIN, R_MAX, WINDOW, SPLAT, SPLAT_MIN, SPLAT_MAX = 1.0, 40.0, 45.0, 1.2, 1.0, 8.0
TURN = tuple(f"_m{a}{b}" for a in range(3) for b in range(3))


def candidates(points: DataFrame, frames: DataFrame, reach: float = R_MAX, window: float | None = WINDOW) -> DataFrame:
    """Pairs of points (x, y, z, gps) and frames (frame, pose) within ``reach`` in the plane and ``window`` seconds."""
    f = turned(frames).select("frame", "t", "e", "n", "h", *TURN, F.col("e").alias("cx"), F.col("n").alias("cy"))
    return range_join(points, f, reach, None if window is None else ("gps", "t", window)).drop("cx", "cy", "d2")


def turned(frames: DataFrame) -> DataFrame:
    """``frames`` with the nine entries of their world-to-camera rotation: worked out once a frame, not once a pair."""
    m = Q.vehicle(F.col("yaw"), F.col("roll"), F.col("pitch"))
    return frames.withColumns({name: m[k // 3][k % 3] for k, name in enumerate(TURN)})


def projected(pairs: DataFrame, w: int = S.PANO_W, h: int = S.PANO_H) -> DataFrame:
    """``pairs`` with panorama place ``u``, ``v``, range ``range`` and elevation ``el``, of ranges in use only."""
    m = [[F.col(c) for c in TURN[3 * k : 3 * k + 3]] for k in range(3)]
    cam = Q.applied(m, [F.col("x") - F.col("e"), F.col("y") - F.col("n"), F.col("z") - F.col("h")])
    # a step of its own: the three coordinates are used many times
    placed = pairs.withColumns({"_qx": cam[0], "_qy": cam[1], "_qz": cam[2]})
    at = S.panorama(F.col("_qx"), F.col("_qy"), F.col("_qz"), w, h)
    out = placed.withColumns({"u": at["u"], "v": at["v"], "range": at["r"], "el": at["el"]})
    return out.where(F.col("range").between(R_MIN, R_MAX)).drop("_qx", "_qy", "_qz", *TURN)


def splatted(seen: DataFrame, w: int, h: int, spacing: float, key: str = "id") -> DataFrame:
    """(frame, i, j, value, point): least range at each cell and the point it belongs to; a point covers an ellipse that widens to the poles.

    ``seen``: u, v in cells of a ``w`` by ``h`` panorama. At equal range the lower key counts.
    """
    row, column = S.cell_of(F.col("u"), F.col("v"), w, h)
    rho = F.least(F.greatest(SPLAT * spacing * w / (2 * math.pi) / F.col("range"), F.lit(SPLAT_MIN)), F.lit(SPLAT_MAX))
    flat = F.greatest(F.abs(F.cos((0.5 - (F.col("_i") + 0.5) / h) * math.pi)), F.lit(1e-6))
    sized = seen.withColumns({"_i": row, "_j": column, "_a": rho}).withColumn("_b", F.least(F.col("_a") / flat, F.lit(w / 2.0)))
    span = lambda c: F.sequence(-(F.col(c) + 0.999).cast("int"), (F.col(c) + 0.999).cast("int"))
    each = sized.select("frame", key, "range", "_i", "_j", "_a", "_b", F.explode(span("_a")).alias("di")).select("*", F.explode(span("_b")).alias("dj"))
    inside = F.col("dj") * F.col("dj") / (F.col("_b") * F.col("_b")) + F.col("di") * F.col("di") / (F.col("_a") * F.col("_a")) <= 1.0
    cells = each.where(inside & (F.col("_i") + F.col("di")).between(0, h - 1))
    at = cells.select("frame", (F.col("_i") + F.col("di")).alias("i"), F.pmod(F.col("_j") + F.col("dj"), F.lit(w)).alias("j"), "range", key)
    return at.groupBy("frame", "i", "j").agg(F.min(F.struct("range", F.col(key).alias("point"))).alias("m")).select("frame", "i", "j", F.col("m.range").alias("value"), "m.point")


def products(points: DataFrame, frames: DataFrame, w: int, h: int, spacing: float, key: str = "id") -> DataFrame:
    """(frame, i, j, depth_mm, point) of every frame: candidates, projection and splat as one plan."""
    cells = splatted(projected(candidates(points, frames), w, h), w, h, spacing, key)
    return cells.select("frame", "i", "j", S.depth_mm(F.col("value")).alias("depth_mm"), "point")


def depth_of(mm: Column) -> Column:
    """Metres of a stored depth; null where a cell is empty."""
    return F.when(mm > 0, mm * 0.001)


def visible_points(seen: DataFrame, product: DataFrame, w: int, h: int) -> DataFrame:
    """Rows of ``seen`` (frame, u, v in cells, range) with ``visible`` by the frame's closed depth, and their cell ``i``, ``j``."""
    by = ("frame",)
    closed = R.closed_depth(product.select("frame", "i", "j", depth_of(F.col("depth_mm")).alias("value")), w, h, by)
    around = closed.join(R.range_spread(closed, w, h, by).withColumnRenamed("value", "_spread"), ["frame", "i", "j"]).withColumnRenamed("value", "_depth")
    row, column = S.cell_of(F.col("u"), F.col("v"), w, h)
    met = seen.withColumns({"i": row, "j": column}).join(around, ["frame", "i", "j"], "left")
    return met.withColumn("visible", S.visible(F.col("range"), F.col("_depth"), F.col("_spread"), F.col("i"), h)).drop("_depth", "_spread")


def saturated(r: Column, g: Column, b: Column) -> Column:
    """Whether a channel is at its top, or all are at the bottom."""
    return (r == 255) | (g == 255) | (b == 255) | ((r <= 2) & (g <= 2) & (b <= 2))


def edges(depth: DataFrame, w: int, h: int, relative: float = 0.15, absolute: float = 0.5, lowest: float = -60.0) -> DataFrame:
    """(frame, i, j, depth_edge, sky_edge) of occupied cells: a neighbour lies farther by a jump, or is empty above the horizon.

    Columns wrap; beyond the upper and lower border a cell is its own neighbour.
    """
    sides = F.array(*[F.struct(F.lit(a).alias("di"), F.lit(b).alias("dj")) for a, b in ((0, 1), (0, -1), (1, 0), (-1, 0))])
    asked = depth.select("frame", F.col("i").alias("i0"), F.col("j").alias("j0"), F.col("value").alias("own"), F.explode(sides).alias("s"))
    asked = asked.select("frame", "i0", "j0", "own", F.least(F.greatest(F.col("i0") + F.col("s.di"), F.lit(0)), F.lit(h - 1)).alias("i"), F.pmod(F.col("j0") + F.col("s.dj"), F.lit(w)).alias("j"))
    met = asked.join(depth.select("frame", "i", "j", "value"), ["frame", "i", "j"], "left")
    el = 90.0 - (F.col("i0") + 0.5) / h * 180.0
    jump = F.coalesce(F.col("value") - F.col("own") > F.greatest(F.lit(absolute), relative * F.col("own")), F.lit(False))
    found = met.groupBy("frame", "i0", "j0").agg(F.bool_or(jump).alias("jump"), F.bool_or(F.col("value").isNull()).alias("open"))
    sky, keep = F.col("open") & (el > 0), el >= lowest
    return found.select("frame", F.col("i0").alias("i"), F.col("j0").alias("j"), (F.col("jump") & keep & ~sky).alias("depth_edge"), (sky & keep).alias("sky_edge"))
