"""Raster-neighbourhood operators on long-form cells (i, j, value): each cell emits to its neighbours, one aggregate gathers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(cells: DataFrame, radius: int = 1, wrap: int | None = None, height: int | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, i, j, di, dj, value): every cell's value at all places within ``radius``; columns wrap at ``wrap``, rows end at ``height``."""
    shifts = F.array(*[F.struct(F.lit(a).alias("di"), F.lit(b).alias("dj")) for a in range(-radius, radius + 1) for b in range(-radius, radius + 1)])
    each = cells.select(*by, "i", "j", "value", F.explode(shifts).alias("s"))
    j = F.col("j") + F.col("s.dj")
    out = each.select(*by, (F.col("i") + F.col("s.di")).alias("i"), (F.pmod(j, F.lit(wrap)) if wrap else j).alias("j"), "s.di", "s.dj", "value")
    return out.where(F.col("i").between(0, height - 1)) if height else out


def _along(cells: DataFrame, axis: str, wrap: int | None, height: int | None) -> DataFrame:
    """Every row of ``cells`` at the three places along one axis."""
    moved = cells.withColumn("_s", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))).withColumn(axis, F.col(axis) + F.col("_s")).drop("_s")
    if axis == "j" and wrap:
        moved = moved.withColumn("j", F.pmod("j", F.lit(wrap)))
    return moved.where(F.col("i").between(0, height - 1)) if axis == "i" and height else moved


def _extreme(cells: DataFrame, f, wrap: int | None, height: int | None, by: tuple[str, ...]) -> DataFrame:
    """(by, i, j, value, n): ``f`` (min or max) over the occupied ones of 3x3 cells, row by row and then column by column, and how many there are."""
    out = cells.select(*by, "i", "j", "value", F.lit(1).alias("n"))
    for axis in ("j", "i"):
        out = _along(out, axis, wrap, height).groupBy(*by, "i", "j").agg(f("value").alias("value"), F.sum("n").alias("n"))
    return out


def closed_depth(cells: DataFrame, wrap: int, height: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Ranges with small holes filled by the nearer surrounding: 3x3 minimum, then maximum, empty cells being infinitely far.

    Columns wrap, rows end at the border, and no cell gets farther than it was;
    ``by`` names the columns that tell rasters apart. Both passes go along rows,
    then columns (3 + 3 copies of a cell instead of 9).
    """
    nearer = _extreme(cells, F.min, wrap, height, by).select(*by, "i", "j", "value")
    reached = _extreme(nearer, F.max, wrap, height, by)
    # a maximum is finite if all of the places are: at the upper and lower border there are six
    places = F.when(F.col("i").isin(0, height - 1), 3 * min(2, height)).otherwise(9)
    opened = reached.where(F.col("n") == places).select(*by, "i", "j", F.col("value").alias("opened"))
    return cells.select(*by, "i", "j", "value").join(opened, [*by, "i", "j"], "full").select(*by, "i", "j", F.least("value", "opened").alias("value"))


def range_spread(cells: DataFrame, wrap: int, height: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Largest minus smallest value over 3x3, empty cells left out; columns wrap."""
    both = cells.select(*by, "i", "j", F.struct(F.col("value").alias("lo"), F.col("value").alias("hi")).alias("v"))
    for axis in ("j", "i"):
        both = _along(both, axis, wrap, height).groupBy(*by, "i", "j").agg(F.struct(F.min("v.lo").alias("lo"), F.max("v.hi").alias("hi")).alias("v"))
    return both.select(*by, "i", "j", (F.col("v.hi") - F.col("v.lo")).alias("value"))


def filled(cells: DataFrame, radius: int, wrap: int | None = None, height: int | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Cells and the empty places within ``radius`` of them, those with the nearest value (ties: upper, then left source); columns wrap, rows end at ``height``."""
    key = F.struct((F.col("di") * F.col("di") + F.col("dj") * F.col("dj")).alias("d"), (-F.col("di")).alias("a"), (-F.col("dj")).alias("b"))
    near = spread(cells, radius, wrap, height, by).where(F.col("di") * F.col("di") + F.col("dj") * F.col("dj") <= radius * radius)
    return near.groupBy(*by, "i", "j").agg(F.min_by("value", key).alias("value"))


def largest_jump(cells: DataFrame) -> DataFrame:
    """Largest absolute difference to a 4-neighbour."""
    sides = spread(cells).where(F.abs("di") + F.abs("dj") == 1).select("i", "j", F.col("value").alias("other"))
    return cells.join(sides, ["i", "j"]).groupBy("i", "j").agg(F.max(F.abs(F.col("value") - F.col("other"))).alias("value"))


def _mirrored(cells: DataFrame, width: int, height: int) -> DataFrame:
    """An image with a border of one cell, mirrored about the outermost cells."""
    for axis, size in (("i", height), ("j", width)):
        at = F.col(axis)
        cells = cells.withColumn(axis, F.explode(F.array_compact(F.array(at, F.when(at == 1, F.lit(-1)), F.when(at == size - 2, F.lit(size))))))
    return cells


def around_sums(cells: DataFrame, width: int, height: int, **kernels: list[list[float]]) -> DataFrame:
    """(i, j, one column a kernel): weighted 3x3 sums of an image without gaps, mirrored at its borders; a kernel's rows run with i."""
    each = spread(_mirrored(cells, width, height)).where(F.col("i").between(0, height - 1) & F.col("j").between(0, width - 1))
    weight = lambda k: F.element_at(F.array(*[F.lit(float(v)) for row in k for v in row]), (1 - F.col("di")) * 3 + 2 - F.col("dj"))
    return each.groupBy("i", "j").agg(*[F.sum(F.col("value") * weight(k)).alias(name) for name, k in kernels.items()])


def mean3(cells: DataFrame, width: int, height: int) -> DataFrame:
    """3x3 mean of an image of whole numbers, rounded half to even."""
    return around_sums(cells, width, height, total=[[1, 1, 1]] * 3).select("i", "j", F.rint(F.col("total") / 9.0).alias("value"))


def gradient(cells: DataFrame, width: int, height: int) -> DataFrame:
    """Sobel magnitude, an eighth."""
    g = around_sums(cells, width, height, gi=[[-1, -2, -1], [0, 0, 0], [1, 2, 1]], gj=[[-1, 0, 1], [-2, 0, 2], [-1, 0, 1]])
    return g.select("i", "j", (F.sqrt(F.col("gi") * F.col("gi") + F.col("gj") * F.col("gj")) / 8.0).alias("value"))


def laplacian(cells: DataFrame, width: int, height: int) -> DataFrame:
    return around_sums(cells, width, height, value=[[0, 1, 0], [1, -4, 1], [0, 1, 0]])


def median_filter(cells: DataFrame, radius: int = 2) -> DataFrame:
    """Median of the values within ``radius``, empty cells left out."""
    return spread(cells, radius).groupBy("i", "j").agg(F.percentile("value", F.lit(0.5)).alias("value")).join(cells.select("i", "j"), ["i", "j"], "left_semi")


def image_nearest(points: DataFrame, image: DataFrame, key: str, width: int, height: int) -> DataFrame:
    """(key, value) of places (u, v): the cell they lie in; columns wrap, rows are clamped."""
    v = F.least(F.greatest(F.col("v"), F.lit(0.0)), F.lit(float(height - 1)))
    at = points.select(key, F.floor(v).alias("i"), F.pmod(F.floor(F.pmod("u", F.lit(float(width)))), F.lit(width)).alias("j"))
    return at.join(image, ["i", "j"]).select(key, "value")


def image_bilinear(points: DataFrame, image: DataFrame, key: str, width: int, height: int) -> DataFrame:
    """(key, value) of places (u, v) between four cell centres; columns wrap, rows are clamped."""
    x = F.pmod("u", F.lit(float(width))) - 0.5
    y = F.least(F.greatest(F.least(F.greatest(F.col("v"), F.lit(0.0)), F.lit(float(height - 1))) - 0.5, F.lit(0.0)), F.lit(float(height - 1)))
    a, b = x - F.floor(x), y - F.floor(y)
    tap = lambda p, q: F.struct(F.least(F.floor(y) + q, F.lit(height - 1)).alias("i"), F.pmod(F.floor(x) + p, F.lit(width)).alias("j"), ((a if p else 1 - a) * (b if q else 1 - b)).alias("w"))
    taps = points.select(key, F.explode(F.array(*[tap(p, q) for p in (0, 1) for q in (0, 1)])).alias("s")).select(key, "s.*")
    return taps.join(image, ["i", "j"]).groupBy(key).agg(F.sum(F.col("w") * F.col("value")).alias("value"))


def bilinear(points: DataFrame, cells: DataFrame, key: str, cell: float) -> DataFrame:
    """(key, value) of points (x, y) on a ground raster: four taps between cell centres; points that lack one are left out."""
    fi, fj = F.col("x") / cell - 0.5, F.col("y") / cell - 0.5
    a, b = fi - F.floor(fi), fj - F.floor(fj)
    taps = F.array(*[F.struct((F.floor(fi) + p).alias("i"), (F.floor(fj) + q).alias("j"), ((a if p else 1 - a) * (b if q else 1 - b)).alias("w")) for p in (0, 1) for q in (0, 1)])
    met = points.select(key, F.explode(taps).alias("s")).select(key, "s.*").join(cells, ["i", "j"])
    return met.groupBy(key).agg(F.sum(F.col("w") * F.col("value")).alias("value"), F.count("*").alias("_n")).where("_n = 4").drop("_n")


def distance_to_change(labels: DataFrame, radius: int) -> DataFrame:
    """(i, j, value, distance): cells to the nearest cell of another label; ``radius`` where none is nearer."""
    near = spread(labels, radius).withColumnRenamed("value", "other").withColumn("_d", F.sqrt((F.col("di") * F.col("di") + F.col("dj") * F.col("dj")).cast("double")))
    met = labels.join(near, ["i", "j"])
    return met.groupBy("i", "j", "value").agg(F.least(F.coalesce(F.min(F.when(F.col("other") != F.col("value"), F.col("_d"))), F.lit(float(radius))), F.lit(float(radius))).alias("distance"))


def near_other(labels: DataFrame, radius: int, wrap: int | None = None) -> DataFrame:
    """Cells (i, j, value) within ``radius`` (Euclidean) of a cell with another label; places without a label are no border."""
    near = spread(labels, radius, wrap).where(F.col("di") * F.col("di") + F.col("dj") * F.col("dj") <= radius * radius)
    lowest = near.groupBy("i", "j").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    return labels.join(lowest, ["i", "j"]).where((F.col("_lo") != F.col("value")) | (F.col("_hi") != F.col("value"))).select("i", "j", "value")


def near_mask(mask: DataFrame, radius: int, wrap: int | None = None) -> DataFrame:
    """(i, j) within ``radius`` (square) of the mask's cells."""
    return spread(mask.select("i", "j", F.lit(1).alias("value")), radius, wrap).select("i", "j").distinct()


def cyclic_correlation(a: DataFrame, b: DataFrame, width: int, shifts: range) -> DataFrame:
    """(shift, ncc, n): correlation of ``a`` with ``b`` moved by ``shift`` columns, which wrap at ``width``."""
    moved = b.select("i", "j", F.col("value").alias("other"), F.explode(F.array(*[F.lit(s) for s in shifts])).alias("shift"))
    met = a.join(moved.withColumn("j", F.pmod(F.col("j") + F.col("shift"), F.lit(width))), ["i", "j"])
    return met.groupBy("shift").agg(F.corr("value", "other").alias("ncc"), F.count("*").alias("n"))


def uphill(cells: DataFrame, cut, radius: int = 1) -> DataFrame:
    """(i, j, pi, pj): the peak that steepest ascent leads to (ties: higher i, then j).

    Pointers double each round, so a path of n cells takes log n joins; ``cut``
    writes a round's table.
    """
    best = F.max(F.struct("value", (F.col("i") - F.col("di")).alias("i"), (F.col("j") - F.col("dj")).alias("j")))
    to = spread(cells, radius).join(cells.select("i", "j"), ["i", "j"], "left_semi").groupBy("i", "j").agg(best.alias("m"))
    step = cut(to.select("i", "j", F.col("m.i").alias("pi"), F.col("m.j").alias("pj")))
    while True:
        far = step.select(F.col("i").alias("pi"), F.col("j").alias("pj"), F.col("pi").alias("qi"), F.col("pj").alias("qj"))
        moved = step.join(far, ["pi", "pj"])
        after = cut(moved.select("i", "j", F.col("qi").alias("pi"), F.col("qj").alias("pj"), ((F.col("qi") != F.col("pi")) | (F.col("qj") != F.col("pj"))).alias("went")))
        step = after.drop("went")
        if after.where("went").isEmpty():
            return step
