"""Polylines and series: resampling, subdivision, seam splits, smoothing, outlier repair."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def segments(df: DataFrame, by: str, order: list[str], axes: list[str]) -> DataFrame:
    """(by, n, <axis>0, <axis>1 ..., length) of consecutive vertices; n numbers them from 1."""
    w = Window.partitionBy(by).orderBy(*order)
    s = df.select(by, F.row_number().over(w).alias("n"), *[F.col(a).alias(a + "0") for a in axes], *[F.lead(a).over(w).alias(a + "1") for a in axes])
    sides = [(F.col(a + "1") - F.col(a + "0")) * (F.col(a + "1") - F.col(a + "0")) for a in axes]
    return s.where(F.col(axes[0] + "1").isNotNull()).withColumn("length", F.sqrt(sum(sides, F.lit(0.0))))


def resampled_along(df: DataFrame, by: str, order: list[str], axes: list[str], step: float) -> DataFrame:
    """(by, k, axes): points at arc length k * step, from the first vertex on."""
    s = segments(df, by, order, axes).where("length > 0")
    end = F.sum("length").over(Window.partitionBy(by).orderBy("n").rowsBetween(Window.unboundedPreceding, 0))
    s = s.withColumn("end", end).withColumn("start", F.col("end") - F.col("length"))
    first, last = F.ceil(F.col("start") / step), F.ceil(F.col("end") / step) - 1
    at = s.where(first <= last).select("*", F.explode(F.sequence(first, last)).alias("k"))
    share = (F.col("k") * step - F.col("start")) / F.col("length")
    return at.select(by, "k", *[(F.col(a + "0") + (F.col(a + "1") - F.col(a + "0")) * share).alias(a) for a in axes])


def subdivided(df: DataFrame, by: str, order: list[str], axes: list[str], longest: Column | float) -> DataFrame:
    """(by, n, m, axes): every segment cut into equal parts of ``longest`` at most (vertices end them); empty segments go."""
    s = segments(df, by, order, axes).where("length > 1e-9")
    parts = F.greatest(F.ceil(F.col("length") / longest), F.lit(1)).cast("int")
    each = s.withColumn("parts", parts).select("*", F.explode(F.sequence(F.lit(1), F.col("parts"))).alias("m"))
    return each.select(by, "n", "m", *[(F.col(a + "0") + (F.col(a + "1") - F.col(a + "0")) * F.col("m") / F.col("parts")).alias(a) for a in axes])


def seam_pieces(df: DataFrame, by: str, order: list[str], u: str, width: float) -> DataFrame:
    """``df`` with ``piece`` (from 0) and ``edge_share``: where on the way from the row before the seam is crossed (null: not).

    A step of over half the width crosses the seam; the share interpolates any other column there.
    """
    w = Window.partitionBy(by).orderBy(*order)
    before = F.lag(u).over(w)
    step = F.col(u) - before
    down = step < 0
    straight = F.col(u) + F.when(down, width).otherwise(-width)
    share = F.when(F.abs(step) > width / 2, (F.when(down, width).otherwise(0.0) - before) / (straight - before))
    marked = df.withColumn("edge_share", share)
    return marked.withColumn("piece", F.sum(F.col("edge_share").isNotNull().cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def smoothing_weights(window: int, degree: int) -> np.ndarray:
    """Row p: weights of a window's values for the least-squares polynomial at its place p."""
    powers = np.vander(np.arange(window) - window // 2, degree + 1, increasing=True)
    return powers @ np.linalg.pinv(powers)


def smoothed(df: DataFrame, by: list[str], order: list[str], x: str, window: int = 5, degree: int = 2) -> DataFrame:
    """``smooth``: polynomial fit over a centred window; at the ends the fit of the first or last window; short series stay."""
    w, half, weights = Window.partitionBy(*by).orderBy(*order), window // 2, smoothing_weights(window, degree)
    whole = Window.partitionBy(*by)
    place, rest = F.row_number().over(w) - 1, F.count("*").over(whole) - F.row_number().over(w)
    fit = lambda p: sum((F.lead(x, k - p).over(w) * float(weights[p, k]) for k in range(window)), F.lit(0.0))
    out = F.when(F.count("*").over(whole) < window, F.col(x))
    for p in range(half):
        out = out.when(place == p, fit(p)).when(rest == p, fit(window - 1 - p))
    return df.withColumn("smooth", out.otherwise(fit(half)))


def repaired(df: DataFrame, by: str, order: list[str], t: str, x: str, around: int = 5, gate: float = 3.0) -> DataFrame:
    """``outlier`` and ``repaired``: values that leave the rolling median by over ``gate`` robust deviations are refilled linearly."""
    w = Window.partitionBy(by).orderBy(*order)
    off = df.withColumn("_off", F.abs(F.col(x) - F.percentile(x, F.lit(0.5)).over(w.rowsBetween(-around, around))))
    spread = off.groupBy(by).agg((F.percentile("_off", F.lit(0.5)) * 1.4826 * gate).alias("_limit"))
    kept = off.join(spread, by).withColumn("outlier", F.col("_off") > F.col("_limit"))
    good = F.when(~F.col("outlier"), F.struct(F.col(t).alias("t"), F.col(x).alias("x")))
    ends = kept.withColumns({"_a": F.last(good, True).over(w.rowsBetween(Window.unboundedPreceding, 0)), "_b": F.first(good, True).over(w.rowsBetween(0, Window.unboundedFollowing))})
    a, b = F.col("_a"), F.col("_b")
    line = F.when(a.isNull(), b["x"]).when(b.isNull() | (a["t"] == b["t"]), a["x"]).otherwise(a["x"] + (b["x"] - a["x"]) * (F.col(t) - a["t"]) / (b["t"] - a["t"]))
    return ends.withColumn("repaired", F.when(F.col("outlier"), line).otherwise(F.col(x))).drop("_off", "_limit", "_a", "_b")
