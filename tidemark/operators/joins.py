"""Range, nearest and interval joins on grid and bucket keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def range_join(points: DataFrame, centres: DataFrame, radius: float, window: tuple[str, str, float] | None = None) -> DataFrame:
    """Rows of ``points`` (x, y, ...) and ``centres`` (cx, cy, ...) within ``radius`` in the plane, inclusive, with ``d2``.

    Cells are as wide as the radius; each centre is copied to its nine cells, so
    give the smaller side as ``centres``. ``window``: a column of each side and how
    far they may differ; it is a third axis of the cells, so that places met again
    and again don't meet all of their times.
    """
    cell = lambda c: F.floor(F.col(c) / radius)
    near = F.array(*[F.struct((cell("cx") + i).alias("_i"), (cell("cy") + j).alias("_j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    ring, cells = centres.select("*", F.explode(near).alias("_c")).select("*", "_c.*").drop("_c"), {"_i": cell("x"), "_j": cell("y")}
    if window:
        own, other, width = window
        at = lambda c: F.floor(F.col(c) / width)
        ring, cells = ring.select("*", F.explode(F.array(*[at(other) + k for k in (-1, 0, 1)])).alias("_k")), {**cells, "_k": at(own)}
    met = points.withColumns(cells).join(ring, list(cells)).drop(*cells)
    if window:
        met = met.where(F.abs(F.col(own) - F.col(other)) <= width)
    d2 = (F.col("x") - F.col("cx")) * (F.col("x") - F.col("cx")) + (F.col("y") - F.col("cy")) * (F.col("y") - F.col("cy"))
    return met.withColumn("d2", d2).where(F.col("d2") <= radius * radius)


def nearest_within(points: DataFrame, centres: DataFrame, radius: float, point: str, centre: str) -> DataFrame:
    """(point, centre, d2) of the nearest centre within ``radius``; a tie goes to the lower id."""
    met = range_join(points, centres, radius)
    return met.groupBy(point).agg(F.min(F.struct("d2", centre)).alias("m")).select(point, f"m.{centre}", "m.d2")


def interval_join(points: DataFrame, intervals: DataFrame, t: str, bucket: float) -> DataFrame:
    """Rows of ``points`` and ``intervals`` (lo, hi, ...) with lo < t <= hi, by buckets of time."""
    cut = intervals.select("*", F.explode(F.sequence(F.floor(F.col("lo") / bucket), F.floor(F.col("hi") / bucket))).alias("_b"))
    return points.withColumn("_b", F.floor(F.col(t) / bucket)).join(cut, "_b").where((F.col(t) > F.col("lo")) & (F.col(t) <= F.col("hi"))).drop("_b")


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether both have the same rows as often."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
