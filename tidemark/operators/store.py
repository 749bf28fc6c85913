"""The point store: tiles of cell-sorted rows, their catalogue, and queries that read only the tiles and cells they need.

A store is a Parquet table partitioned by ``tile`` and, within a tile, sorted by
cell and first row; coordinates are whole millimetres. Cells (``ci``, ``cj``, counted
from the tile's corner) and time buckets are columns, so disc and time queries prune
partitions and row groups and never scan a whole tile list.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Metres a unit, width of a cell (m), seconds in a time bucket.
SCALE, CELL, BUCKET = 0.001, 4.0, 0.01
#: Row ids beside the coordinates; any other column is kept as it is.
AXES = ("x", "y", "z")


def quantised(points: DataFrame) -> DataFrame:
    """Coordinates in metres as whole millimetres; an overflow of 32 bits is an error, not a wrap."""
    mm = {c: F.rint(F.round(F.col(c) / SCALE, 6)) for c in AXES}
    checked = {c: F.when(F.abs(v) <= 2**31 - 1, v.cast("int")).otherwise(F.raise_error(F.lit(f"{c} overflows 32 bits")).cast("int")) for c, v in mm.items()}
    return points.withColumns(checked)


def metres(points: DataFrame) -> DataFrame:
    return points.withColumns({c: F.col(c) * SCALE for c in AXES})


def bounds(points: DataFrame) -> DataFrame:
    """One row a tile of ``points`` (metres): rows, extent, corner and shape of its cell grid, and its time range."""
    agg = points.groupBy("tile").agg(
        F.count("*").alias("n"), F.min("x").alias("min_e"), F.min("y").alias("min_n"), F.max("x").alias("max_e"), F.max("y").alias("max_n"), F.min("gps").alias("t_min"), F.max("gps").alias("t_max"),
    )
    agg = agg.withColumns({"e0": F.floor(F.col("min_e") / CELL) * CELL, "n0": F.floor(F.col("min_n") / CELL) * CELL})
    return agg.withColumns({"nx": F.floor((F.col("max_e") - F.col("e0")) / CELL) + 1, "ny": F.floor((F.col("max_n") - F.col("n0")) / CELL) + 1})


def catalogue(points: DataFrame) -> DataFrame:
    """``bounds`` with ``row_offset``: the rows of all tiles before, by name (a window over one row a tile)."""
    before = Window.orderBy("tile").rowsBetween(Window.unboundedPreceding, -1)
    return bounds(points).withColumn("row_offset", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long"))


def celled(points: DataFrame, tiles: DataFrame) -> DataFrame:
    """``points`` with cell (``ci`` row, ``cj`` column) and time bucket of their tile's grid; tiles are few and broadcast by size."""
    origin = tiles.select("tile", "e0", "n0", "t_min")
    at = points.join(origin, "tile")
    cells = {"ci": F.floor((F.col("y") - F.col("n0")) / CELL), "cj": F.floor((F.col("x") - F.col("e0")) / CELL), "bucket": F.floor((F.col("gps") - F.col("t_min")) / BUCKET)}
    return at.withColumns(cells).drop("e0", "n0", "t_min")


def rows(points: DataFrame, tiles: DataFrame, index: str = "id") -> DataFrame:
    """Store rows: ``row`` numbers a tile's points by cell, then source order, and ``point_id`` all points of the store."""
    w = Window.partitionBy("tile").orderBy("ci", "cj", index)
    placed = celled(points, tiles).withColumn("row", (F.row_number().over(w) - 1).cast("long"))
    return placed.join(tiles.select("tile", "row_offset"), "tile").withColumn("point_id", F.col("row_offset") + F.col("row")).drop("row_offset")


def write(points: DataFrame, root: str, index: str = "id") -> None:
    """Writes ``points`` (tile, x, y, z in metres, gps, ...) as a store, and its catalogue beside it."""
    tiles = catalogue(points)
    tiles.write.mode("overwrite").parquet(f"{root}/tiles")
    tiles = points.sparkSession.read.parquet(f"{root}/tiles")
    placed = quantised(rows(points, tiles, index))
    placed.repartition("tile").sortWithinPartitions("tile", "row").write.mode("overwrite").partitionBy("tile").parquet(f"{root}/rows")


class Store:
    """A written store; ``registration`` (group, dx, dy, dz, yaw, cx, cy by time range t0 < t <= t1) moves the points it covers."""

    def __init__(self, spark: SparkSession, root: str, registration: DataFrame | None = None):
        self.tiles = spark.read.parquet(f"{root}/tiles")
        self.rows = spark.read.option("mergeSchema", "true").parquet(f"{root}/rows")
        self.registration = registration

    def points(self, rows_: DataFrame | None = None) -> DataFrame:
        """Rows in metres, registered where a registration is set."""
        found = metres(self.rows if rows_ is None else rows_)
        return found if self.registration is None else registered(found, self.registration)

    def disc(self, cx: float, cy: float, radius: float) -> DataFrame:
        """Rows within ``radius`` in the plane, inclusive, across tiles: tiles by extent, cells by distance, then the points."""
        near = near_cells(tiles_near(self.tiles, cx, cy, radius), cx, cy, radius)
        names = [r.tile for r in near.select("tile").distinct().collect()]
        cells = self.rows.where(F.col("tile").isin(names)).join(F.broadcast(near), ["tile", "ci", "cj"], "left_semi")
        x, y = F.col("x") * SCALE - cx, F.col("y") * SCALE - cy
        return cells.where(x * x + y * y <= radius * radius)

    def time(self, t0: float, t1: float, box: tuple[float, float, float, float] | None = None) -> DataFrame:
        """Rows with t0 <= gps <= t1, of tiles that the range (and ``box``: min and max e, n) can meet."""
        names = [r.tile for r in tiles_in(self.tiles, t0, t1, box).select("tile").collect()]
        return self.rows.where(F.col("tile").isin(names) & F.col("gps").between(t0, t1))


def distance2(e: Column, n: Column, min_e: Column, min_n: Column, max_e: Column, max_n: Column) -> Column:
    """Squared distance of a place to a box; 0 inside."""
    dx = F.greatest(min_e - e, F.lit(0.0), e - max_e)
    dy = F.greatest(min_n - n, F.lit(0.0), n - max_n)
    return dx * dx + dy * dy


def box_distance2(e: Column, n: Column) -> Column:
    return distance2(e, n, F.col("min_e"), F.col("min_n"), F.col("max_e"), F.col("max_n"))


def tiles_near(tiles: DataFrame, cx: float, cy: float, radius: float) -> DataFrame:
    return tiles.where(box_distance2(F.lit(cx), F.lit(cy)) <= radius * radius)


def tiles_in(tiles: DataFrame, t0: float, t1: float, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Tiles whose time range (unknown: any) and extent overlap the given ones."""
    found = tiles.where(~F.coalesce((F.col("t_max") < t0) | (F.col("t_min") > t1), F.lit(False)))
    if box is not None:
        found = found.where((F.col("max_e") >= box[0]) & (F.col("min_e") <= box[2]) & (F.col("max_n") >= box[1]) & (F.col("min_n") <= box[3]))
    return found


def near_cells(tiles: DataFrame, cx: float, cy: float, radius: float) -> DataFrame:
    """(tile, ci, cj) of the cells that may hold a point of the disc: those whose centre is within the radius and half a diagonal."""
    reach = radius + CELL * math.sqrt(0.5)
    span = lambda lo, n, c: F.sequence(F.greatest(F.floor((c - reach - lo) / CELL), F.lit(0).cast("long")), F.least(F.ceil((c + reach - lo) / CELL), n - 1))
    some = tiles.where((F.floor((cy - reach - F.col("n0")) / CELL) < F.col("ny")) & (F.floor((cx - reach - F.col("e0")) / CELL) < F.col("nx")))
    grid = some.select("tile", "e0", "n0", "nx", F.explode(span(F.col("n0"), F.col("ny"), cy)).alias("ci"), "ny").select("*", F.explode(span(F.col("e0"), F.col("nx"), cx)).alias("cj"))
    dx, dy = F.col("e0") + (F.col("cj") + 0.5) * CELL - cx, F.col("n0") + (F.col("ci") + 0.5) * CELL - cy
    return grid.where(dx * dx + dy * dy <= reach * reach).select("tile", "ci", "cj")


def located(ids: DataFrame, tiles: DataFrame, key: str = "point_id") -> DataFrame:
    """``ids`` with the tile and local row of each global id, by the ranges of the catalogue (one array lookup a row)."""
    ordered = tiles.agg(F.array_sort(F.collect_list(F.struct("row_offset", "n", "tile"))).alias("_t"))
    at = F.element_at(F.filter("_t", lambda t: t["row_offset"] <= F.col(key)), -1)
    return ids.join(F.broadcast(ordered)).withColumn("_at", at).select(*ids.columns, F.col("_at.tile").alias("tile"), (F.col(key) - F.col("_at.row_offset")).alias("row"))


def registered(points: DataFrame, passes: DataFrame) -> DataFrame:
    """``points`` moved by their pass's turn about its centre and shift; points of no pass stay. ``passes``: t0, t1, dx, dy, dz, yaw, cx, cy."""
    names = ["t0", "t1", "dx", "dy", "dz", "yaw", "cx", "cy"]
    p = passes.select(*[F.col(c).alias("_" + c) for c in names])
    both = points.join(F.broadcast(p), (F.col("gps") > F.col("_t0")) & (F.col("gps") <= F.col("_t1")), "left")
    c, s = F.cos(F.radians("_yaw")), F.sin(F.radians("_yaw"))
    ex, ny = F.col("x") - F.col("_cx"), F.col("y") - F.col("_cy")
    moved = {"x": c * ex - s * ny + F.col("_cx") + F.col("_dx"), "y": s * ex + c * ny + F.col("_cy") + F.col("_dy"), "z": F.col("z") + F.col("_dz")}
    return both.withColumns({k: F.coalesce(v, F.col(k)) for k, v in moved.items()}).select(*points.columns)


def packed_returns(number: Column, count: Column) -> Column:
    """Return number in the low four bits, number of returns above."""
    return number.bitwiseOR(F.shiftleft(count, 4))


def grid_of(tiles: DataFrame, cell: float, pad: float) -> DataFrame:
    """One row: corner, cell and shape of a grid over all tiles, ``pad`` wider on every side."""
    e0, n0 = F.floor(F.min("min_e") - pad).cast("double"), F.floor(F.min("min_n") - pad).cast("double")
    e1, n1 = F.ceil(F.max("max_e") + pad), F.ceil(F.max("max_n") + pad)
    box = tiles.agg(e0.alias("e0"), n0.alias("n0"), e1.alias("e1"), n1.alias("n1"))
    return box.select("e0", "n0", F.lit(cell).alias("cell"), F.ceil((F.col("e1") - F.col("e0")) / cell).alias("nx"), F.ceil((F.col("n1") - F.col("n0")) / cell).alias("ny"))


def grid_cell(e: Column, n: Column, e0: Column, n0: Column, cell: float, nx: Column, ny: Column) -> dict[str, Column]:
    """Cell of a place, truncated and clamped to the grid; whether it lies inside (half open); and its rounded pixel."""
    clip = lambda v, hi: F.least(F.greatest(v.cast("long"), F.lit(0).cast("long")), hi - 1)
    inside = (e >= e0) & (e < e0 + nx * cell) & (n >= n0) & (n < n0 + ny * cell)
    return {"i": clip((n - n0) / cell, ny), "j": clip((e - e0) / cell, nx), "inside": inside, "px": F.rint((e - e0) / cell).cast("int"), "py": F.rint((n - n0) / cell).cast("int")}
