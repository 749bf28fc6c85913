"""Queries on the tiled point store, with oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import areas
from tidemark.operators import store as T
from tidemark.plans.registry import PTS, query, r
from tidemark.sources.tables import scan_points, table, tile_name

CAT = f"""WITH {PTS}, bb AS (SELECT tile, count(*) AS n, min(x) AS min_e, min(y) AS min_n, max(x) AS max_e, max(y) AS max_n, min(gps) AS t_min, max(gps) AS t_max, floor(min(x)/4)*4 AS e0, floor(min(y)/4)*4 AS n0 FROM pt GROUP BY 1),
cat AS (SELECT *, CAST(floor((max_e-e0)/4)+1 AS BIGINT) AS nx, CAST(floor((max_n-n0)/4)+1 AS BIGINT) AS ny, CAST(coalesce(sum(n) OVER (ORDER BY tile ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0) AS BIGINT) AS row_offset FROM bb),
st AS (SELECT pt.*, CAST(floor((y-n0)/4) AS BIGINT) AS ci, CAST(floor((x-e0)/4) AS BIGINT) AS cj, CAST(floor((gps-t_min)/0.01::DOUBLE) AS BIGINT) AS bucket, row_offset FROM pt JOIN cat USING (tile)), rw AS (SELECT *, row_number() OVER (PARTITION BY tile ORDER BY ci, cj, id) - 1 AS row FROM st)"""
NAMES = ("min_e", "min_n", "max_e", "max_n", "t_min", "t_max", "e0", "n0")


def _store(spark, d):
    points = scan_points(spark, d)
    tiles = T.catalogue(points)
    return points, tiles


@query(f"{CAT} SELECT tile, n, row_offset, nx, ny, {', '.join(f'round({c},4)+0.0 AS {c}' for c in NAMES)} FROM cat")
def tile_catalogue(spark, d):
    _, tiles = _store(spark, d)
    return tiles.select("tile", "n", "row_offset", "nx", "ny", *[r(c).alias(c) for c in NAMES])


@query(f"{CAT} SELECT tile, row, row_offset+row AS point_id, id, ci, cj, bucket, CAST(round_even(round(x/0.001::DOUBLE,6),0) AS INT) AS x, CAST(round_even(round(y/0.001::DOUBLE,6),0) AS INT) AS y, CAST(round_even(round(z/0.001::DOUBLE,6),0) AS INT) AS z FROM rw")
def store_rows(spark, d):
    """Rows of every tile in store order, in whole millimetres, with cell, time bucket and global id."""
    points, tiles = _store(spark, d)
    return T.quantised(T.rows(points, tiles)).select("tile", "row", "point_id", "id", "ci", "cj", "bucket", "x", "y", "z")


@query(f"{CAT}, q AS (SELECT DISTINCT (id*7)%(SELECT count(*) FROM pt) AS point_id FROM pt) SELECT point_id, tile, point_id-row_offset AS row FROM q JOIN cat ON point_id >= row_offset AND point_id < row_offset+n")
def locate_ids(spark, d):
    """Tile and local row of global ids, by the catalogue's ranges."""
    points, tiles = _store(spark, d)
    n = points.agg(F.count("*")).scalar()
    return T.located(points.select((F.col("id") * 7 % n).alias("point_id")).distinct(), tiles)


@query(f"{CAT}, b AS (SELECT *, greatest(min_e-3,0,3-max_e) AS dx, greatest(min_n+5,0,-5-max_n) AS dy FROM cat) SELECT tile, round(dx*dx+dy*dy,4)+0.0 AS d2 FROM b WHERE dx*dx+dy*dy <= 144")
def tiles_near(spark, d):
    _, tiles = _store(spark, d)
    return T.tiles_near(tiles, 3.0, -5.0, 12.0).select("tile", r(T.box_distance2(F.lit(3.0), F.lit(-5.0))).alias("d2"))


@query(f"{CAT} SELECT tile, row, id FROM rw JOIN cat USING (tile) WHERE pow(e0+(cj+0.5)*4-3,2)+pow(n0+(ci+0.5)*4+5,2) <= pow(12+4*sqrt(0.5),2) AND pow(greatest(min_e-3,0,3-max_e),2)+pow(greatest(min_n+5,0,-5-max_n),2) <= 144")
def disc_cells(spark, d):
    """Rows of the cells that a disc may touch: the superset that a store reads before it measures distances."""
    points, tiles = _store(spark, d)
    near = T.near_cells(T.tiles_near(tiles, 3.0, -5.0, 12.0), 3.0, -5.0, 12.0)
    return T.rows(points, tiles).join(F.broadcast(near), ["tile", "ci", "cj"], "left_semi").select("tile", "row", "id")


@query(f"{CAT} SELECT tile, row, id FROM rw WHERE pow(round_even(round(x/0.001::DOUBLE,6),0)*0.001::DOUBLE-3,2)+pow(round_even(round(y/0.001::DOUBLE,6),0)*0.001::DOUBLE+5,2) <= 144")
def store_disc(spark, d):
    """A disc query on a written store: tiles, cells, then distances."""
    return _written(spark, d).disc(3.0, -5.0, 12.0).select(F.col("tile").cast("long").alias("tile"), "row", "id")


@query(f"{CAT} SELECT tile, row, id FROM rw JOIN (SELECT tile FROM cat WHERE max_e >= -10 AND min_e <= 15 AND max_n >= -30 AND min_n <= 5) USING (tile) WHERE gps BETWEEN 20 AND 120")
def store_time(spark, d):
    """A time query with a box on a written store."""
    return _written(spark, d).time(20.0, 120.0, (-10.0, -30.0, 15.0, 5.0)).select(F.col("tile").cast("long").alias("tile"), "row", "id")


def _written(spark, d):
    from tidemark.operators.graph import folder

    root = folder(spark)
    T.write(scan_points(spark, d), root)
    return T.Store(spark, root)


PASSES = "ps AS (SELECT psid, min(t0) AS t0, max(t1) AS t1, psid*0.1::DOUBLE AS dx, -0.05::DOUBLE*psid AS dy, 0.02::DOUBLE*psid AS dz, psid*0.5::DOUBLE AS yaw FROM (SELECT CAST(floor(gps/30) AS BIGINT) AS psid, floor(gps/30)*30 AS t0, floor(gps/30)*30+30 AS t1 FROM pt WHERE gps < 150) GROUP BY 1)"


def _passes(spark, d):
    p = scan_points(spark, d).where("gps < 150").select(F.floor(F.col("gps") / 30).alias("k")).distinct()
    k = F.col("k")
    return p.select((k * 30).cast("double").alias("t0"), (k * 30 + 30).cast("double").alias("t1"), (k * 0.1).alias("dx"), (k * -0.05).alias("dy"), (k * 0.02).alias("dz"), (k * 0.5).alias("yaw"), F.lit(2.0).alias("cx"), F.lit(-3.0).alias("cy"))


MOVED = f"WITH {PTS}, {PASSES}, mv AS (SELECT id, pt.cls, pt.r, pt.g, pt.b, gps, coalesce(cos(radians(yaw))*(x-2)-sin(radians(yaw))*(y+3)+2+dx, x) AS x, coalesce(sin(radians(yaw))*(x-2)+cos(radians(yaw))*(y+3)-3+dy, y) AS y, coalesce(z+dz, z) AS z, ps.psid IS NOT NULL AS moved FROM pt LEFT JOIN ps ON gps > t0 AND gps <= t1)"


@query(f"{MOVED} SELECT id, round(x,4)+0.0 AS x, round(y,4)+0.0 AS y, round(z,4)+0.0 AS z FROM mv")
def registered_points(spark, d):
    """Points moved by the transform of the pass in whose time they lie; others stay."""
    return T.registered(scan_points(spark, d), _passes(spark, d)).select("id", *[r(c).alias(c) for c in "xyz"])


@query(f"{MOVED} SELECT id, CAST(round_even(round(x/0.001::DOUBLE,6),0) AS INT) AS x, CAST(round_even(round(y/0.001::DOUBLE,6),0) AS INT) AS y, CAST(round_even(round(z/0.001::DOUBLE,6),0) AS INT) AS z FROM mv")
def registered_integers(spark, d):
    return T.quantised(T.registered(scan_points(spark, d), _passes(spark, d))).select("id", "x", "y", "z")


@query(f"WITH {PTS} SELECT id, CAST(1 + id%nret + nret*16 AS BIGINT) AS packed FROM pt")
def packed_returns(spark, d):
    return scan_points(spark, d).select("id", T.packed_returns(F.col("id") % F.col("nret") + 1, F.col("nret")).alias("packed"))


@query(f"{CAT} SELECT tile, bucket//100 AS bucket, count(*) AS n, min(row) AS first_row FROM rw GROUP BY 1,2")
def time_buckets(spark, d):
    points, tiles = _store(spark, d)
    return T.rows(points, tiles).groupBy("tile", F.floor(F.col("bucket") / 100).alias("bucket")).agg(F.count("*").alias("n"), F.min("row").alias("first_row"))


@query("SELECT p_partkey, right('000' || (p_partkey%1000), 3) AS name FROM part")
def tile_names(spark, d):
    digits = F.col("p_partkey").cast("string")
    # lpad would cut longer keys
    key = F.when(F.length(digits) < 6, F.lpad(digits, 6, "0")).otherwise(digits)
    return table(spark, d, "part").select("p_partkey", tile_name(F.concat(F.lit("/data/laz/AB12_"), key, F.lit("_K.laz"))).alias("name"))


GRID = f"{CAT}, gr AS (SELECT floor(min(min_e)-5) AS e0, floor(min(min_n)-5) AS n0, ceil(max(max_e)+5) AS e1, ceil(max(max_n)+5) AS n1 FROM cat), gs AS (SELECT e0, n0, CAST(ceil((e1-e0)/0.5) AS BIGINT) AS nx, CAST(ceil((n1-n0)/0.5) AS BIGINT) AS ny FROM gr)"


@query(f"{GRID} SELECT e0, n0, 0.5::DOUBLE AS cell, nx, ny FROM gs")
def store_grid(spark, d):
    return T.grid_of(_store(spark, d)[1], 0.5, 5.0)


@query(f"{GRID}, q AS (SELECT id, x*1.3::DOUBLE AS e, y*1.3::DOUBLE AS n, gs.* FROM pt, gs) SELECT id, e>=e0 AND e<e0+nx*0.5 AND n>=n0 AND n<n0+ny*0.5 AS inside, least(greatest(CAST(trunc((n-n0)/0.5) AS BIGINT),0),ny-1) AS i, least(greatest(CAST(trunc((e-e0)/0.5) AS BIGINT),0),nx-1) AS j, CAST(round_even((e-e0)/0.5,0) AS INT) AS px, CAST(round_even((n-n0)/0.5,0) AS INT) AS py FROM q")
def grid_cells(spark, d):
    """Cell, pixel and membership of places in the store's grid."""
    points, tiles = _store(spark, d)
    at = points.select("id", (F.col("x") * 1.3).alias("e"), (F.col("y") * 1.3).alias("n")).join(F.broadcast(T.grid_of(tiles, 0.5, 5.0)))
    found = T.grid_cell(F.col("e"), F.col("n"), F.col("e0"), F.col("n0"), 0.5, F.col("nx"), F.col("ny"))
    return at.select("id", *[c.alias(k) for k, c in found.items()])


@query(f"{CAT}, lb AS (SELECT tile, (min_e+max_e)/2 AS x, (min_n+max_n)/2 AS y FROM cat) SELECT CAST(c.tile AS BIGINT) AS ring, count(lb.tile) AS labels, min(lb.tile) AS label FROM cat c LEFT JOIN lb ON lb.x > (c.tile//100-10)*20 AND lb.x < (c.tile//100-9)*20 AND lb.y > (c.tile%100-10)*20 AND lb.y < (c.tile%100-9)*20 GROUP BY 1")
def tile_layout(spark, d):
    """How many label points lie in the ring of each tile (a layout is sound with one), and which."""
    _, tiles = _store(spark, d)
    lo, ln = (F.floor(F.col("tile") / 100) - 10) * 20.0, (F.col("tile") % 100 - 10) * 20.0
    corner = lambda a, b: F.struct((lo + a).alias("x"), (ln + b).alias("y"))
    rings = tiles.select(F.col("tile").alias("ring"), F.array(corner(0, 0), corner(20, 0), corner(20, 20), corner(0, 20), corner(0, 0)).alias("polygon"))
    labels = tiles.select(F.col("tile").alias("label"), ((F.col("min_e") + F.col("max_e")) / 2).alias("x"), ((F.col("min_n") + F.col("max_n")) / 2).alias("y"))
    met = areas.points_in_polygons(labels, rings.withColumnRenamed("polygon", "ring_").withColumnRenamed("ring", "tile").withColumnRenamed("ring_", "ring"), 20.0)
    found = met.groupBy("tile").agg(F.count("label").alias("labels"), F.min("label").alias("label"))
    return tiles.select("tile").join(found, "tile", "left").select(F.col("tile").alias("ring"), F.coalesce("labels", F.lit(0).cast("long")).alias("labels"), "label")
