"""Wires in plan, scan planes over time, and lines drawn into panoramas."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import rotations as Q
from tidemark.operators import graph as G
from tidemark.operators.clusters import cells
from tidemark.operators.raster import spread

#: Numbers of cells are packed into one node number.
PACK = 10_000_000
MOMENTS = ("xx", "yy", "zz", "xy", "xz", "yz")


def dilated(mask: DataFrame, radius: int) -> DataFrame:
    """Cells within a square of the mask's."""
    return spread(mask.select("i", "j", F.lit(1).alias("value")), radius).select("i", "j").distinct()


def eroded(mask: DataFrame, radius: int) -> DataFrame:
    """Cells of which the whole square around is in the mask."""
    whole = (2 * radius + 1) ** 2
    return spread(mask.select("i", "j", F.lit(1).alias("value")), radius).groupBy("i", "j").agg(F.count("*").alias("n")).where(F.col("n") == whole).select("i", "j")


def wires(points: DataFrame, cell: float = 0.25, lowest: float = 3.0, free: float = 1.5, gap: float = 1.5, length: float = 5.0, ratio: float = 0.1, least: int = 8) -> DataFrame:
    """``points`` (x, y, hag) of wires: high, with nothing close below, in thin long lines of plan cells.

    Thin cells are those that an opening of the unsupported ones removes; gaps are
    bridged by a closing; a component counts with ``least`` cells, four deviations of
    ``length`` along it and a small ``ratio`` of the deviations across and along.
    """
    placed = cells(points, cell, "yx")
    high = F.col("hag") > lowest
    plan = placed.groupBy("i", "j").agg(F.min(F.when(high, F.col("hag"))).alias("low"), F.max(F.when(~high, F.col("hag"))).alias("under"))
    alone = G.cut(plan.where(F.col("low").isNotNull() & (F.col("under").isNull() | (F.col("under") < F.col("low") - free))).select("i", "j"))
    thin = G.cut(alone.join(dilated(eroded(alone, 1), 1), ["i", "j"], "left_anti"))
    reach = (round(gap / cell) | 1) // 2
    bridged = G.cut(eroded(dilated(thin, reach), reach).union(thin).distinct().withColumn("node", F.col("i") * PACK + F.col("j")))
    beside = spread(bridged.select("i", "j", F.col("node").alias("value")), 1).withColumnRenamed("value", "a")
    edges = beside.join(bridged.withColumnRenamed("node", "b"), ["i", "j"]).select("a", "b")
    named = bridged.join(G.components(bridged, edges), "node")
    y, x = F.col("i") * cell, F.col("j") * cell
    sizes = named.groupBy("component").agg(F.count("*").alias("n"), F.var_samp(x).alias("xx"), F.var_samp(y).alias("yy"), F.covar_samp(x, y).alias("xy"))
    half, root = (F.col("xx") + F.col("yy")) / 2, F.sqrt((F.col("xx") - F.col("yy")) * (F.col("xx") - F.col("yy")) / 4 + F.col("xy") * F.col("xy"))
    sizes = sizes.where(F.col("n") >= least).withColumns({"e1": half + root, "e2": half - root})
    long_ = sizes.where((4 * F.sqrt("e1") >= length) & (F.col("e2") / F.greatest(F.col("e1"), F.lit(1e-9)) < ratio)).select("component")
    kept = named.join(long_, "component").select("i", "j").join(thin, ["i", "j"], "left_semi")
    return placed.where(high).join(kept, ["i", "j"], "left_semi").select(*points.columns)


def scan_planes(points: DataFrame, by: str, t: str, bucket: float, least: int, gate: float) -> DataFrame:
    """(by, start, n, t, x, y, z, rms): planes through the points of two buckets of time at a time, every bucket beginning one.

    Buckets are summed once and sent to the two windows that they lie in; windows
    with few points or too rough a plane go. Places are taken from the group's
    first, so that sums of squares stay exact.
    """
    first = points.groupBy(by).agg(F.min(F.struct(t, "x", "y", "z")).alias("o"), F.max(t).alias("_last"))
    own = points.join(F.broadcast(first), by).withColumns({"b": F.floor((F.col(t) - F.col(f"o.{t}")) / bucket), "end": F.floor((F.col("_last") - F.col(f"o.{t}")) / bucket)})
    own = own.withColumns({"d" + c: F.col(c) - F.col("o." + c) for c in "xyz"})
    sums = own.groupBy(by, "b", "end", "o").agg(F.count("*").alias("n"), F.sum(t).alias("st"), *[F.sum("d" + c).alias("s" + c) for c in "xyz"], *[F.sum(F.col("d" + a) * F.col("d" + b)).alias(f"s{a}{b}") for a, b in MOMENTS])
    last = F.greatest(F.col("end") - 1, F.lit(0).cast("long"))
    sent = sums.withColumn("start", F.explode(F.array(F.col("b") - 1, F.col("b")))).where((F.col("start") >= 0) & (F.col("start") <= last))
    names = ["st", *["s" + c for c in "xyz"], *["s" + x for x in MOMENTS]]
    w = sent.groupBy(by, "start", "o").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names]).where(F.col("n") >= least)
    w = w.withColumns({f"c{a}{b}": F.col(f"s{a}{b}") / F.col("n") - F.col(f"s{a}") / F.col("n") * F.col(f"s{b}") / F.col("n") for a, b in MOMENTS})
    w = Q.with_eigenvalues(w, {x: "c" + x for x in MOMENTS}, ("e0", "e1", "e2"))
    w = w.withColumn("rms", F.sqrt(F.greatest("e2", F.lit(0.0)))).where(F.col("rms") <= gate)
    return w.select(by, "start", "n", (F.col("st") / F.col("n")).alias("t"), *[(F.col("o." + c) + F.col("s" + c) / F.col("n")).alias(c) for c in "xyz"], "rms")


def subdivided_from(lines: DataFrame, place: list[Column], degrees: float, most: int = 20_000) -> DataFrame:
    """``lines`` (segments ax..bz) with points along them that a camera at ``place`` sees at most ``degrees`` apart.

    The closest approach to the camera, at least half a metre, bounds the angle of a
    step; the segment's end belongs to it, its start to the one before.
    """
    a, b = ([F.col(p + c) for c in "xyz"] for p in "ab")
    d = [q - p for p, q in zip(a, b)]
    dot = lambda u, v: sum((x * y for x, y in zip(u, v)), F.lit(0.0))
    rows = lines.withColumn("_l", F.sqrt(dot(d, d))).where(F.col("_l") >= 1e-9)
    t = F.least(F.greatest(dot([c - p for c, p in zip(place, a)], d) / (F.col("_l") * F.col("_l")), F.lit(0.0)), F.lit(1.0))
    rows = rows.withColumn("_t", t)
    off = [p + v * F.col("_t") - c for p, v, c in zip(a, d, place)]
    near = F.greatest(F.sqrt(dot(off, off)), F.lit(0.5))
    n = F.least(F.greatest(F.ceil(F.round(F.col("_l") / (near * math.tan(math.radians(degrees))), 9)), F.lit(1).cast("long")), F.lit(most).cast("long"))
    rows = rows.withColumn("_n", n).withColumn("step", F.explode(F.sequence(F.lit(1).cast("long"), "_n")))
    at = {c: p + v * (F.col("step") / F.col("_n")) for c, p, v in zip("xyz", a, d)}
    return rows.withColumns(at).drop("_l", "_t", "_n")
