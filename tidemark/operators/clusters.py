"""Ground, local shape and objects of point clouds, and the linking of clusters across tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import rotations as Q
from tidemark.operators import graph as G
from tidemark.operators import raster as R

#: Point classes of shape.
STRUCTURE, VEGETATION = 1, 2
#: Least points and planarity of a planar voxel, normals of ground and facade, and the classes they give.
VOXEL_POINTS, PLANAR, GROUND_NZ, FACADE_NZ, GROUND_CLASS = 30, 0.2, 0.7, 0.3, 2
GROUND, FACADE, OTHER = 0, 1, 2


def cells(points: DataFrame, size: float, axes: str = "xyz") -> DataFrame:
    """``points`` with the numbers (i, j, k) of their cell."""
    return points.withColumns({n: F.floor(F.col(c) / size) for n, c in zip("ijk", axes)})


def ground_raster(points: DataFrame, cell: float, reach: int, smooth: int = 2) -> DataFrame:
    """(i, j, value): lowest point of each cell, cells within ``reach`` filled by the nearest, then the median around."""
    lowest = cells(points, cell, "yx").groupBy("i", "j").agg(F.min("z").alias("value"))
    return R.median_filter(R.filled(lowest, reach), smooth)


def terrain(points: DataFrame, cell: float, ground: Column, reach: int) -> DataFrame:
    """(i, j, value): lowest ground point of each cell, holes within ``reach`` filled by the nearest cell."""
    return R.filled(cells(points.where(ground), cell, "yx").groupBy("i", "j").agg(F.min("z").alias("value")), reach)


def voxel_features(points: DataFrame, cell: float) -> DataFrame:
    """(i, j, k, n, own, multi, linear, planar, spherical, occupied, hag) of each voxel over its 27 neighbours.

    Sums, not points, go to the neighbours: a voxel sends eleven numbers to 27
    places, whatever it holds. ``points``: x, y, z, hag, nret. Coordinates are
    taken from the voxel's own centre, so that sums of squares stay exact.
    """
    own = cells(points, cell)
    centred = own.withColumns({c: F.col(c) - (F.col(n) + 0.5) * cell for c, n in zip("xyz", "ijk")})
    sums = {"s1": F.count("*").cast("double"), "sm": F.sum(F.when(F.col("nret") > 1, 1.0).otherwise(0.0)), "sh": F.sum("hag")}
    sums |= {f"s{c}": F.sum(c) for c in "xyz"} | {f"s{a}{b}": F.sum(F.col(a) * F.col(b)) for a, b in ("xx", "yy", "zz", "xy", "xz", "yz")}
    per = centred.groupBy("i", "j", "k").agg(*[v.alias(k) for k, v in sums.items()])
    span = (-1, 0, 1)
    shifts = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(c).alias("c")) for a in span for b in span for c in span])
    sent = per.select("*", F.explode(shifts).alias("d"))
    # seen from the receiving voxel's centre the sender's is off by the shift
    off = {c: -F.col(f"d.{k}") * cell for c, k in zip("xyz", "abc")}
    first = {f"t{c}": F.col(f"s{c}") + off[c] * F.col("s1") for c in "xyz"}
    second = {f"t{a}{b}": F.col(f"s{a}{b}") + off[a] * F.col(f"s{b}") + off[b] * F.col(f"s{a}") + off[a] * off[b] * F.col("s1") for a, b in ("xx", "yy", "zz", "xy", "xz", "yz")}
    moved = sent.select((F.col("i") + F.col("d.a")).alias("i"), (F.col("j") + F.col("d.b")).alias("j"), (F.col("k") + F.col("d.c")).alias("k"), "s1", "sm", *[v.alias(k) for k, v in (first | second).items()])
    pooled = moved.groupBy("i", "j", "k").agg(F.sum("s1").alias("n"), F.sum("sm").alias("m"), F.count("*").alias("occupied"), *[F.sum(k).alias(k) for k in first | second])
    both = per.select("i", "j", "k", F.col("s1").cast("long").alias("own"), (F.col("sh") / F.col("s1")).alias("hag")).join(pooled, ["i", "j", "k"])
    cov = {f"c{a}{b}": F.col(f"t{a}{b}") / F.col("n") - F.col(f"t{a}") / F.col("n") * F.col(f"t{b}") / F.col("n") for a, b in ("xx", "yy", "zz", "xy", "xz", "yz")}
    both = both.withColumns(cov)
    both = Q.with_eigenvalues(both, {x: "c" + x for x in ("xx", "yy", "zz", "xy", "xz", "yz")}, ("l1", "l2", "l3"))
    both = both.withColumns({c: F.greatest(c, F.lit(1e-9)) for c in ("l1", "l2", "l3")})
    return both.select(
        "i", "j", "k", F.col("n").cast("long").alias("n"), "own", (F.col("m") / F.col("n")).alias("multi"), ((F.col("l1") - F.col("l2")) / F.col("l1")).alias("linear"),
        ((F.col("l2") - F.col("l3")) / F.col("l1")).alias("planar"), (F.col("l3") / F.col("l1")).alias("spherical"), "occupied", "hag", "l1", "l2", "l3",
    )


def shape_class() -> Column:
    """Vegetation or structure from a voxel's features: many returns, or volume."""
    multi, sph = F.col("multi"), F.col("spherical")
    return F.when((multi >= 0.5) | (sph >= 0.25) | ((multi >= 0.3) & (sph >= 0.1)), VEGETATION).otherwise(STRUCTURE)


def planar_voxels(points: DataFrame, voxel: float, least: int = VOXEL_POINTS, planar: float = PLANAR) -> DataFrame:
    """(i, j, k, n, x, y, z, nz, ratio, cls): voxels with enough points on a plane: centre, steepness of the normal, class.

    Ground: most points are of the ground class and the normal is steep; facade: the
    normal is nearly level. The normal's z comes from the eigenvalues alone.
    """
    own = cells(points, voxel)
    centred = own.withColumns({"d" + c: F.col(c) - (F.col(n) + 0.5) * voxel for c, n in zip("xyz", "ijk")})
    pairs = ("xx", "yy", "zz", "xy", "xz", "yz")
    counts = centred.groupBy("i", "j", "k", "cls").agg(F.count("*").alias("n"), *[F.sum("d" + c).alias("s" + c) for c in "xyz"], *[F.sum(F.col("d" + a) * F.col("d" + b)).alias(f"s{a}{b}") for a, b in pairs])
    names = [*["s" + c for c in "xyz"], *["s" + x for x in pairs]]
    whole = counts.groupBy("i", "j", "k").agg(F.sum("n").alias("n"), F.max(F.struct("n", (-F.col("cls")).alias("minus"))).alias("m"), *[F.sum(c).alias(c) for c in names]).where(F.col("n") >= least)
    whole = whole.withColumns({f"c{a}{b}": F.col(f"s{a}{b}") / F.col("n") - F.col(f"s{a}") / F.col("n") * F.col(f"s{b}") / F.col("n") for a, b in pairs})
    whole = Q.with_eigenvalues(whole, {x: "c" + x for x in pairs}, ("e0", "e1", "e2"))
    flat = whole.where((F.col("e0") > 1e-12) & (F.col("e2") / F.col("e0") < planar))
    minor = (F.col("e2") - F.col("cxx")) * (F.col("e2") - F.col("cyy")) - F.col("cxy") * F.col("cxy")
    nz = F.sqrt(F.greatest(F.coalesce(F.try_divide(minor, (F.col("e2") - F.col("e0")) * (F.col("e2") - F.col("e1"))), F.lit(0.0)), F.lit(0.0)))
    place = [((F.col(n) + 0.5) * voxel + F.col("s" + c) / F.col("n")).alias(c) for c, n in zip("xyz", "ijk")]
    out = flat.select("i", "j", "k", "n", *place, nz.alias("nz"), (F.col("e2") / F.col("e0")).alias("ratio"), (-F.col("m.minus")).alias("_c"))
    return out.withColumn("cls", F.when((F.col("_c") == GROUND_CLASS) & (F.col("nz") >= GROUND_NZ), GROUND).when(F.col("nz") <= FACADE_NZ, FACADE).otherwise(OTHER)).drop("_c")


def curbs(points: DataFrame, grid: float, step: float) -> DataFrame:
    """(i, j, x, y, z, jump, di, dj): cells whose mean height differs by at least ``step`` from a 4-neighbour's, at the largest such jump.

    (di, dj) leads from the lower to the higher cell; of equal jumps the first of +i, -i, +j, -j.
    """
    mean = cells(points, grid, "xy").groupBy("i", "j").agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.round(F.avg("z"), 9).alias("z"))
    sides = F.array(*[F.struct(F.lit(o).alias("o"), F.lit(a).alias("a"), F.lit(b).alias("b")) for o, (a, b) in enumerate(((1, 0), (-1, 0), (0, 1), (0, -1)))])
    asked = mean.select("*", F.explode(sides).alias("s")).select("i", "j", "x", "y", "z", "s.*", (F.col("i") + F.col("s.a")).alias("ni"), (F.col("j") + F.col("s.b")).alias("nj"))
    met = asked.join(mean.select(F.col("i").alias("ni"), F.col("j").alias("nj"), F.col("z").alias("nz")), ["ni", "nj"]).withColumn("jump", F.col("nz") - F.col("z"))
    best = met.groupBy("i", "j").agg(F.max(F.struct(F.abs("jump").alias("size"), (-F.col("o")).alias("minus"), "jump", "a", "b", "x", "y", "z")).alias("m")).where(F.col("m.size") >= step)
    up = F.when(F.col("m.jump") > 0, 1).otherwise(-1)
    return best.select("i", "j", "m.x", "m.y", "m.z", F.col("m.size").alias("jump"), (F.col("m.a") * up).alias("di"), (F.col("m.b") * up).alias("dj"))


def tree_like(points: DataFrame, id_: str, cell: float = 0.5, least: float = 40.0, multi: float = 0.3, spread: float = 0.4, dense: int = 5) -> DataFrame:
    """(id, area, multi, spread, tree): whether a cluster is large, returns several echoes and fills its columns.

    ``spread`` is the median deviation of height over columns of ``dense`` points or
    more, 0 where there are none; ``points``: id, x, y, hag, nret.
    """
    columns = cells(points, cell, "xy").groupBy(id_, "i", "j").agg(F.count("*").alias("n"), F.stddev_pop("hag").alias("sd"), F.sum(F.when(F.col("nret") > 1, 1).otherwise(0)).alias("m"))
    out = columns.groupBy(id_).agg((F.count("*") * cell * cell).alias("area"), (F.sum("m") / F.sum("n")).alias("multi"), F.coalesce(F.percentile(F.when(F.col("n") >= dense, F.col("sd")), F.lit(0.5)), F.lit(0.0)).alias("spread"))
    return out.withColumn("tree", (F.col("area") >= least) & (F.col("multi") >= multi) & (F.col("spread") >= spread))


def cell_key(x: Column, y: Column) -> Column:
    """One number for a 1 m cell of the plane."""
    return F.floor(x) * 10_000_000 + F.floor(y)


def border_points(points: DataFrame, tile: str = "tile") -> DataFrame:
    """Points within a cell (1 m, eight neighbours) of one that another tile occupies."""
    placed = cells(points, 1.0, "xy")
    occupied = placed.select(tile, "i", "j").distinct()
    near = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    reach = occupied.select(F.col(tile).alias("_other"), F.explode(near).alias("s"), "i", "j").select("_other", (F.col("i") + F.col("s.a")).alias("i"), (F.col("j") + F.col("s.b")).alias("j"))
    # a cell's lowest and highest tile tell whether one of them is another
    ends = reach.groupBy("i", "j").agg(F.min("_other").alias("_lo"), F.max("_other").alias("_hi"))
    return placed.join(ends, ["i", "j"]).where((F.col("_lo") != F.col(tile)) | (F.col("_hi") != F.col(tile))).select(*points.columns)


def linked(points: DataFrame, voxel: float, eps: float, tile: str = "tile", cluster: str = "cluster") -> DataFrame:
    """(tile, cluster, chain): clusters of different tiles that come within ``eps`` (by voxels) are one; a chain's name is its least (tile, cluster).

    Only points near another tile are compared. ``points``: tile, cluster, x, y, z.
    """
    voxels = cells(border_points(points, tile), voxel).select(tile, cluster, "i", "j", "k").distinct()
    name = F.concat_ws(":", F.lpad(F.col(tile).cast("string"), 12, "0"), F.lpad(F.col(cluster).cast("string"), 12, "0"))
    voxels = voxels.withColumn("node", name)
    reach = int(eps / voxel)
    span = range(-reach, reach + 1)
    ball = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(c).alias("c")) for a in span for b in span for c in span if a * a + b * b + c * c <= (eps / voxel) ** 2])
    moved = voxels.select(F.col(tile).alias("_t"), F.col("node").alias("a"), "i", "j", "k", F.explode(ball).alias("s")).select("_t", "a", (F.col("i") + F.col("s.a")).alias("i"), (F.col("j") + F.col("s.b")).alias("j"), (F.col("k") + F.col("s.c")).alias("k"))
    edges = moved.join(voxels.select(tile, F.col("node").alias("b"), "i", "j", "k"), ["i", "j", "k"]).where(F.col("_t") != F.col(tile)).select("a", "b").distinct()
    nodes = points.select(tile, cluster, name.alias("node")).distinct()
    return nodes.join(G.components(nodes, edges), "node").select(tile, cluster, F.col("component").alias("chain"))


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Distance of a place to a segment in the plane."""
    dx, dy = bx - ax, by - ay
    t = F.least(F.greatest(F.coalesce(F.try_divide((px - ax) * dx + (py - ay) * dy, dx * dx + dy * dy), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    return F.hypot(px - (ax + t * dx), py - (ay + t * dy))


def near_segments(points: DataFrame, segments: DataFrame, reach: float, key: str, segment: str) -> DataFrame:
    """(key, segment, distance): the nearest segment (ax, ay, bx, by) within ``reach`` of each point; a segment is copied to the cells of its box grown by the reach."""
    at = lambda c: F.floor(c / reach)
    box = {"x": ("ax", "bx"), "y": ("ay", "by")}
    span = {c: F.sequence(at(F.least(a, b) - reach), at(F.greatest(a, b) + reach)) for c, (a, b) in box.items()}
    cut = segments.select("*", F.explode(span["x"]).alias("_i")).select("*", F.explode(span["y"]).alias("_j"))
    met = points.withColumns({"_i": at(F.col("x")), "_j": at(F.col("y"))}).join(cut, ["_i", "_j"])
    found = met.withColumn("_d", F.round(segment_distance(F.col("x"), F.col("y"), F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")), 9)).where(F.col("_d") <= reach)
    return found.groupBy(key).agg(F.min(F.struct(F.col("_d").alias("distance"), segment)).alias("m")).select(key, f"m.{segment}", "m.distance")
