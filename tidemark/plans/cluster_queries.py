"""Queries on ground, shape and objects of point clouds, and on clusters across tiles, with oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import areas
from tidemark.operators import clusters as C
from tidemark.operators import graph as G
from tidemark.plans.registry import PTS, query, r
from tidemark.sources.tables import scan_points

FILLED = "SELECT i+a AS i, j+b AS j, arg_min(value, (a*a+b*b, -a, -b)) AS value FROM {t}, range(-{k},{k}+1) u(a), range(-{k},{k}+1) s(b) WHERE a*a+b*b <= {k}*{k} GROUP BY 1,2"
LOW = f"WITH {PTS}, lw AS (SELECT CAST(floor(y/5) AS BIGINT) AS i, CAST(floor(x/5) AS BIGINT) AS j, min(z) AS value FROM pt GROUP BY 1,2), fi AS ({FILLED.format(t='lw', k=2)})"


@query(f"{LOW} SELECT a.i, a.j, round(quantile_cont(b.value,0.5),4)+0.0 AS value FROM fi a JOIN fi b ON abs(a.i-b.i)<=2 AND abs(a.j-b.j)<=2 GROUP BY 1,2")
def ground_raster(spark, d):
    return C.ground_raster(scan_points(spark, d), 5.0, 2).select("i", "j", r("value").alias("value"))


GROUND = f"WITH {PTS}, lw AS (SELECT CAST(floor(y/5) AS BIGINT) AS i, CAST(floor(x/5) AS BIGINT) AS j, min(z) AS value FROM pt WHERE cls=2 GROUP BY 1,2), fi AS ({FILLED.format(t='lw', k=4)})"


@query(f"{GROUND} SELECT i, j, round(value,4)+0.0 AS value FROM fi")
def terrain_model(spark, d):
    return C.terrain(scan_points(spark, d), 5.0, F.col("cls") == 2, 4).select("i", "j", r("value").alias("value"))


@query(f"{GROUND} SELECT id, round(z-value,4)+0.0 AS height FROM pt JOIN fi ON fi.i=CAST(floor(y/5) AS BIGINT) AND fi.j=CAST(floor(x/5) AS BIGINT)")
def height_over_terrain(spark, d):
    t = C.terrain(scan_points(spark, d), 5.0, F.col("cls") == 2, 4)
    return C.cells(scan_points(spark, d), 5.0, "yx").join(t, ["i", "j"]).select("id", r(F.col("z") - F.col("value")).alias("height"))


EIGEN = """mu AS (SELECT *, (xx+yy+zz)/3 AS mu FROM cv), eq AS (SELECT *, sqrt((pow(xx-mu,2)+pow(yy-mu,2)+pow(zz-mu,2)+2*(xy*xy+xz*xz+yz*yz))/6) AS pp, (xx-mu)*((yy-mu)*(zz-mu)-yz*yz)-xy*(xy*(zz-mu)-yz*xz)+xz*(xy*yz-(yy-mu)*xz) AS det FROM mu), ph AS (SELECT *, CASE WHEN pp > 0 THEN acos(least(greatest(det/(2*pow(pp,3)),-1),1))/3 ELSE acos(0)/3 END AS phi FROM eq), ev AS (SELECT *, mu+2*pp*cos(phi) AS q1, mu+2*pp*cos(phi+2*pi()/3) AS q3, 3*mu-(mu+2*pp*cos(phi))-(mu+2*pp*cos(phi+2*pi()/3)) AS q2 FROM ph)"""
VOX = f"""WITH {PTS}, vc AS (SELECT *, CAST(floor(x/8) AS BIGINT) AS i, CAST(floor(y/8) AS BIGINT) AS j, CAST(floor(z/8) AS BIGINT) AS k, z+40 AS hag FROM pt), nb AS (SELECT c.i, c.j, c.k, p.x, p.y, p.z, p.nret, p.i AS pi, p.j AS pj, p.k AS pk FROM (SELECT DISTINCT i,j,k FROM vc) c JOIN vc p ON abs(c.i-p.i)<=1 AND abs(c.j-p.j)<=1 AND abs(c.k-p.k)<=1),
cv AS (SELECT i, j, k, count(*) AS n, avg(CASE WHEN nret>1 THEN 1.0 ELSE 0 END) AS multi, count(DISTINCT (pi,pj,pk)) AS occupied, var_pop(x) AS xx, var_pop(y) AS yy, var_pop(z) AS zz, covar_pop(x,y) AS xy, covar_pop(x,z) AS xz, covar_pop(y,z) AS yz FROM nb GROUP BY 1,2,3), {EIGEN}, ef AS (SELECT *, greatest(q1,1e-9) AS l1, greatest(q2,1e-9) AS l2, greatest(q3,1e-9) AS l3 FROM ev), ow AS (SELECT i, j, k, count(*) AS own, avg(hag) AS hag FROM vc GROUP BY 1,2,3)"""


def _voxels(spark, d):
    return C.voxel_features(scan_points(spark, d).withColumn("hag", F.col("z") + 40), 8.0)


@query(f"{VOX} SELECT i, j, k, n, own, occupied, round(multi,5) AS multi, round(hag,4) AS hag, round((l1-l2)/l1,3)+0.0 AS linear, round((l2-l3)/l1,3)+0.0 AS planar, round(l3/l1,3)+0.0 AS spherical FROM ef JOIN ow USING (i,j,k) WHERE n >= 4")
def voxel_shape(spark, d):
    """Shape of every voxel over its 27 neighbours; those of under four points have no three directions."""
    v = _voxels(spark, d).where("n >= 4")
    return v.select("i", "j", "k", "n", "own", "occupied", F.round("multi", 5).alias("multi"), F.round("hag", 4).alias("hag"), *[r(c, 3).alias(c) for c in ("linear", "planar", "spherical")])


@query(f"{VOX}, cl AS (SELECT i, j, k, CASE WHEN multi >= 0.5 OR round(l3/l1,6) >= 0.25 OR (multi >= 0.3 AND round(l3/l1,6) >= 0.1) THEN 2 ELSE 1 END AS cls FROM ef) SELECT id, cl.cls FROM vc JOIN cl USING (i,j,k)")
def shape_classes(spark, d):
    """Vegetation or structure for every point, by its voxel's shape."""
    v = _voxels(spark, d).withColumn("spherical", F.round("spherical", 6)).select("i", "j", "k", C.shape_class().alias("shape"))
    return C.cells(scan_points(spark, d), 8.0).join(v, ["i", "j", "k"]).select("id", F.col("shape").alias("cls"))


@query(f"""WITH {PTS}, vc AS (SELECT *, CAST(floor(x/12) AS BIGINT) AS i, CAST(floor(y/12) AS BIGINT) AS j, CAST(floor(z/12) AS BIGINT) AS k FROM pt), mj AS (SELECT i, j, k, arg_min(cls, (-n, cls)) AS maj FROM (SELECT i, j, k, cls, count(*) AS n FROM vc GROUP BY 1,2,3,4) GROUP BY 1,2,3), cv AS (SELECT i, j, k, count(*) AS n, avg(x) AS mx, avg(y) AS my, avg(z) AS mz, var_pop(x) AS xx, var_pop(y) AS yy, var_pop(z) AS zz, covar_pop(x,y) AS xy, covar_pop(x,z) AS xz, covar_pop(y,z) AS yz FROM vc GROUP BY 1,2,3 HAVING count(*) >= 5), {EIGEN},
nz AS (SELECT *, sqrt(greatest(coalesce(((q3-xx)*(q3-yy)-xy*xy)/nullif((q3-q1)*(q3-q2),0),0),0)) AS nz FROM ev WHERE q1 > 1e-12 AND q3/q1 < 0.2) SELECT i, j, k, n, round(mx,4)+0.0 AS x, round(my,4)+0.0 AS y, round(mz,4)+0.0 AS z, round(nz,3)+0.0 AS nz, round(q3/q1,4)+0.0 AS ratio, CASE WHEN maj=2 AND nz >= 0.7 THEN 0 WHEN nz <= 0.3 THEN 1 ELSE 2 END AS cls FROM nz JOIN mj USING (i,j,k)""")
def planar_patches(spark, d):
    """Planar voxels with centre, steepness and class."""
    v = C.planar_voxels(scan_points(spark, d), 12.0, 5)
    return v.select("i", "j", "k", "n", *[r(c).alias(c) for c in "xyz"], r("nz", 3).alias("nz"), r("ratio").alias("ratio"), "cls")


CURB = f"WITH {PTS}, mn AS (SELECT CAST(floor(x/4) AS BIGINT) AS i, CAST(floor(y/4) AS BIGINT) AS j, avg(x) AS x, avg(y) AS y, round(avg(z),9) AS z FROM pt GROUP BY 1,2), sd AS (SELECT * FROM (VALUES (0,1,0),(1,-1,0),(2,0,1),(3,0,-1)) t(o,a,b)), jp AS (SELECT m.*, o, a, b, q.z-m.z AS jump FROM mn m, sd JOIN mn q ON q.i=m.i+a AND q.j=m.j+b), cb AS (SELECT * FROM jp QUALIFY row_number() OVER (PARTITION BY i, j ORDER BY abs(jump) DESC, o)=1)"


@query(f"{CURB} SELECT i, j, round(x,4)+0.0 AS x, round(y,4)+0.0 AS y, round(z,4)+0.0 AS z, round(abs(jump),4) AS jump, CAST(a*sign(jump) AS INT) AS di, CAST(b*sign(jump) AS INT) AS dj FROM cb WHERE abs(jump) >= 8")
def curb_points(spark, d):
    return C.curbs(scan_points(spark, d), 4.0, 8.0).select("i", "j", *[r(c).alias(c) for c in "xyz"], F.round("jump", 4).alias("jump"), F.col("di").cast("int").alias("di"), F.col("dj").cast("int").alias("dj"))


SEG = "sg AS (SELECT k AS seg, -40.0::DOUBLE AS ax, k*7-30.0::DOUBLE AS ay, 40.0::DOUBLE AS bx, k*6-28.0::DOUBLE AS by_ FROM range(10) t(k))"
DIST = "sqrt(pow({p}x-(ax+tt*(bx-ax)),2)+pow({p}y-(ay+tt*(by_-ay)),2))"


def _segments(spark):
    k = F.col("id")
    return spark.range(10).select(k.alias("seg"), F.lit(-40.0).alias("ax"), (k * 7 - 30.0).alias("ay"), F.lit(40.0).alias("bx"), (k * 6 - 28.0).alias("by"))


@query(f"WITH {PTS}, {SEG}, q AS (SELECT id, x, y, sg.*, least(greatest(((x-ax)*(bx-ax)+(y-ay)*(by_-ay))/((bx-ax)*(bx-ax)+(by_-ay)*(by_-ay)),0),1) AS tt FROM pt, sg), ds AS (SELECT id, seg, round({DIST.format(p='')},9) AS d FROM q) SELECT id, arg_min(seg, (d, seg)) AS seg, round(min(d),4)+0.0 AS distance FROM ds WHERE d <= 3 GROUP BY 1")
def nearest_segment(spark, d):
    """Nearest line segment within 3 m of every point, and how far it is."""
    near = C.near_segments(scan_points(spark, d).select("id", "x", "y"), _segments(spark), 3.0, "id", "seg")
    return near.select("id", "seg", r("distance").alias("distance"))


@query(f"{CURB}, {SEG}, q AS (SELECT cb.i, cb.j, cb.x, cb.y, sg.*, least(greatest(((x-ax)*(bx-ax)+(y-ay)*(by_-ay))/((bx-ax)*(bx-ax)+(by_-ay)*(by_-ay)),0),1) AS tt FROM cb, sg WHERE abs(jump) >= 8) SELECT DISTINCT i, j FROM q WHERE round({DIST.format(p='')},9) <= 2")
def gated_curbs(spark, d):
    """Height jumps within 2 m of a line."""
    c = C.curbs(scan_points(spark, d), 4.0, 8.0).withColumn("key", F.struct("i", "j"))
    return C.near_segments(c, _segments(spark), 2.0, "key", "seg").select("key.i", "key.j")


@query(f"WITH {PTS}, c AS (SELECT cls AS cluster, floor(x/3) AS i, floor(y/3) AS j, count(*) AS n, stddev_pop(z) AS sd, sum(CASE WHEN nret>1 THEN 1 ELSE 0 END) AS m FROM pt GROUP BY 1,2,3), g AS (SELECT cluster, count(*)*9.0 AS area, sum(m)/sum(n) AS multi, coalesce(quantile_cont(CASE WHEN n >= 2 THEN sd END,0.5),0) AS spread FROM c GROUP BY 1) SELECT cluster, area, round(multi,5) AS multi, round(spread,4) AS spread, area >= 40 AND multi >= 0.3 AND spread >= 0.4 AS tree FROM g")
def tree_clusters(spark, d):
    p = scan_points(spark, d).select(F.col("cls").alias("cluster"), "x", "y", F.col("z").alias("hag"), "nret")
    return C.tree_like(p, "cluster", 3.0, dense=2).select("cluster", "area", F.round("multi", 5).alias("multi"), F.round("spread", 4).alias("spread"), "tree")


@query(f"WITH {PTS} SELECT tile, CAST(floor(x)*10000000+floor(y) AS BIGINT) AS key, count(*) AS n FROM pt GROUP BY 1,2")
def tile_occupancy(spark, d):
    return scan_points(spark, d).groupBy("tile", C.cell_key(F.col("x"), F.col("y")).alias("key")).agg(F.count("*").alias("n"))


@query(f"WITH {PTS}, c AS (SELECT DISTINCT tile, CAST(floor(x) AS BIGINT) AS i, CAST(floor(y) AS BIGINT) AS j FROM pt) SELECT id FROM pt WHERE EXISTS (SELECT 1 FROM c WHERE c.tile<>pt.tile AND abs(c.i-floor(x))<=1 AND abs(c.j-floor(y))<=1)")
def border_points(spark, d):
    return C.border_points(scan_points(spark, d)).select("id")


CHAIN = f"""WITH RECURSIVE {PTS}, c1 AS (SELECT DISTINCT tile, CAST(floor(x) AS BIGINT) AS i, CAST(floor(y) AS BIGINT) AS j FROM pt), bp AS (SELECT * FROM pt WHERE EXISTS (SELECT 1 FROM c1 WHERE c1.tile<>pt.tile AND abs(c1.i-floor(x))<=1 AND abs(c1.j-floor(y))<=1)), vx AS (SELECT DISTINCT tile, id%6 AS cluster, floor(x/2) AS i, floor(y/2) AS j, floor(z/2) AS k FROM bp),
nd AS (SELECT DISTINCT tile, id%6 AS cluster, lpad(tile::VARCHAR,12,'0') || ':' || lpad((id%6)::VARCHAR,12,'0') AS node FROM pt), ed AS (SELECT DISTINCT na.node AS a, nb.node AS b FROM vx a JOIN vx b ON a.tile<>b.tile AND pow(a.i-b.i,2)+pow(a.j-b.j,2)+pow(a.k-b.k,2) <= 16 JOIN nd na ON na.tile=a.tile AND na.cluster=a.cluster JOIN nd nb ON nb.tile=b.tile AND nb.cluster=b.cluster),
wk AS (SELECT node, node AS c FROM nd UNION SELECT ed.b, wk.c FROM wk JOIN ed ON ed.a=wk.node), ch AS (SELECT node, min(c) AS chain FROM wk GROUP BY 1), lk AS (SELECT tile, cluster, chain FROM nd JOIN ch USING (node))"""


def _linked(spark, d):
    p = scan_points(spark, d).select("id", "tile", (F.col("id") % 6).alias("cluster"), "x", "y", "z")
    return p, C.linked(p, 2.0, 8.0)


@query(f"{CHAIN} SELECT tile, cluster, chain FROM lk")
def cluster_links(spark, d):
    """Clusters that reach over tile borders, joined into one."""
    return _linked(spark, d)[1]


@query(f"{CHAIN} SELECT size, count(*) AS chains FROM (SELECT chain, count(*) AS size FROM lk GROUP BY 1) GROUP BY 1")
def chain_sizes(spark, d):
    """How many joined objects consist of how many clusters."""
    sizes = _linked(spark, d)[1].groupBy("chain").agg(F.count("*").alias("size"))
    return sizes.groupBy("size").agg(F.count("*").alias("chains"))


@query(f"{CHAIN}, dn AS (SELECT chain, row_number() OVER (ORDER BY chain)-1 AS gid FROM (SELECT DISTINCT chain FROM lk)) SELECT pt.id, gid, (gid*97)%200+40 AS red, (gid*57)%200+40 AS green FROM pt JOIN lk ON lk.tile=pt.tile AND lk.cluster=pt.id%6 JOIN dn USING (chain)")
def recoloured_clusters(spark, d):
    """Every point with the number and colour of its joined object."""
    from tidemark.operators.sampling import ranked

    p, links = _linked(spark, d)
    links = G.cut(links)
    numbers = ranked(links.select("chain").distinct(), ["chain"]).select("chain", F.col("rank").cast("long").alias("gid"))
    done = p.join(links.join(numbers, "chain"), ["tile", "cluster"])
    return done.select("id", "gid", (F.col("gid") * 97 % 200 + 40).alias("red"), (F.col("gid") * 57 % 200 + 40).alias("green"))


# ---- areas

FACE = """fc AS (SELECT k AS face, (k%4)*20-40.0::DOUBLE AS x0, (k//4)*20-40.0::DOUBLE AS y0 FROM range(16) t(k))"""
INSIDE = f"WITH {PTS}, {FACE}, df AS (SELECT id, x, y, 'c' || (id%6) AS code, (id%6)//2 AS surface, id%6=5 AS small FROM pt WHERE id%12=0), ins AS (SELECT face, df.* FROM fc JOIN df ON x > x0 AND x < x0+20 AND y > y0 AND y < y0+20)"


def _faces(spark):
    k = F.col("id")
    x, y = k % 4 * 20 - 40.0, F.floor(k / 4) * 20 - 40.0
    corner = lambda a, b: F.struct((x + a).alias("x"), (y + b).alias("y"))
    return spark.range(16).select(k.alias("face"), F.array(corner(0, 0), corner(20, 0), corner(20, 20), corner(0, 20)).alias("ring"))


def _definitions(spark, d):
    i = F.col("id")
    return scan_points(spark, d).where("id % 12 = 0").select("id", "x", "y", F.concat(F.lit("c"), (i % 6).cast("string")).alias("code"), F.floor(i % 6 / 2).alias("surface"), (i % 6 == 5).alias("small"))


@query(f"{INSIDE}, ag AS (SELECT face, count(*) AS points, count(DISTINCT surface) FILTER (NOT small) AS surfaces, min(surface) FILTER (NOT small) AS surface, count(*) FILTER (small) AS smalls FROM ins GROUP BY 1) SELECT fc.face, coalesce(points,0) AS points, CASE WHEN surfaces=1 THEN 'resolved' WHEN surfaces=2 THEN 'merged' WHEN surfaces>2 THEN 'conflict' WHEN smalls>0 THEN 'small' ELSE 'unresolved' END AS status, CASE WHEN surfaces=1 THEN surface END AS cls FROM fc LEFT JOIN ag USING (face)")
def face_classes(spark, d):
    """Status and class of each face from the definition points in it: one surface class resolves it, several conflict or merge, small ones count alone."""
    met = areas.points_in_polygons(_definitions(spark, d), _faces(spark), 20.0)
    large = F.when(~F.col("small"), F.col("surface"))
    g = met.groupBy("face").agg(F.count("*").alias("points"), F.countDistinct(large).alias("surfaces"), F.min(large).alias("surface"), F.count_if("small").alias("smalls"))
    full = _faces(spark).select("face").join(g, "face", "left")
    status = F.when(F.col("surfaces") == 1, "resolved").when(F.col("surfaces") == 2, "merged").when(F.col("surfaces") > 2, "conflict").when(F.col("smalls") > 0, "small").otherwise("unresolved")
    return full.select("face", F.coalesce("points", F.lit(0).cast("long")).alias("points"), status.alias("status"), F.when(F.col("surfaces") == 1, F.col("surface")).alias("cls"))


@query(f"{INSIDE}, m AS (SELECT face, arg_min(code, (round(sqrt(pow(x-x0-10,2)+pow(y-y0-10,2)),9), code)) AS code, round(min(sqrt(pow(x-x0-10,2)+pow(y-y0-10,2))),4) AS distance FROM ins JOIN fc USING (face) GROUP BY 1) SELECT * FROM m")
def nearest_code(spark, d):
    """Code of the definition point nearest to the centroid of the face that holds it."""
    faces = _faces(spark).withColumns({"mx": F.col("ring")[0]["x"] + 10, "my": F.col("ring")[0]["y"] + 10})
    met = areas.points_in_polygons(_definitions(spark, d), faces, 20.0)
    away = F.round(F.hypot(F.col("x") - F.col("mx"), F.col("y") - F.col("my")), 9)
    best = met.groupBy("face").agg(F.min(F.struct(away.alias("d"), "code")).alias("m"))
    return best.select("face", "m.code", F.round("m.d", 4).alias("distance"))


@query(f"{INSIDE}, ag AS (SELECT face, count(DISTINCT surface) AS s FROM ins GROUP BY 1), st AS (SELECT fc.face, CASE WHEN s=1 THEN 'resolved' WHEN s>1 THEN 'conflict' ELSE 'unresolved' END AS status FROM fc LEFT JOIN ag USING (face)) SELECT status, count(*) AS n, count(*)*400.0 AS area, round(count(*)/16.0,4) AS share FROM st GROUP BY 1")
def face_summary(spark, d):
    """Faces and their area by status."""
    met = areas.points_in_polygons(_definitions(spark, d), _faces(spark), 20.0).groupBy("face").agg(F.countDistinct("surface").alias("s"))
    full = _faces(spark).join(met, "face", "left").select(areas.area(F.col("ring")).alias("a"), F.when(F.col("s") == 1, "resolved").when(F.col("s") > 1, "conflict").otherwise("unresolved").alias("status"))
    return full.groupBy("status").agg(F.count("*").alias("n"), F.sum("a").alias("area"), F.round(F.sum("a") / 6400.0, 4).alias("share"))


@query(f"WITH {PTS}, {FACE}, a AS (SELECT f.face, g.face AS into_, CASE WHEN f.x0=g.x0 AND abs(f.y0-g.y0)=20 OR f.y0=g.y0 AND abs(f.x0-g.x0)=20 THEN 20.0 ELSE 0 END AS shared FROM fc f, fc g WHERE f.face<>g.face) SELECT face, into_ AS neighbour, round(shared/80.0,4) AS share FROM a WHERE shared >= 0.2*80")
def shared_borders(spark, d):
    """Faces that share at least a fifth of their border with another, by the segments of their rings."""
    e = _faces(spark).select("face", F.explode(areas.ring_edges(F.col("ring"))).alias("e"))
    key = F.struct(F.least("e.ax", "e.bx").alias("x0"), F.least("e.ay", "e.by").alias("y0"), F.greatest("e.ax", "e.bx").alias("x1"), F.greatest("e.ay", "e.by").alias("y1"))
    e = e.select("face", key.alias("k"), F.hypot(F.col("e.ax") - F.col("e.bx"), F.col("e.ay") - F.col("e.by")).alias("length"))
    whole = e.groupBy("face").agg(F.sum("length").alias("perimeter"))
    met = e.join(e.select(F.col("face").alias("neighbour"), "k"), "k").where("face <> neighbour").groupBy("face", "neighbour").agg(F.sum("length").alias("shared"))
    out = met.join(whole, "face").where(F.col("shared") >= 0.2 * F.col("perimeter"))
    return out.select("face", "neighbour", F.round(F.col("shared") / F.col("perimeter"), 4).alias("share"))


@query(f"WITH {PTS}, {SEG}, sm AS (SELECT seg, ax+(bx-ax)*k/40.0 AS x, ay+(by_-ay)*k/40.0 AS y, k*0.1::DOUBLE AS h FROM sg, range(41) u(k)), oc AS (SELECT CAST(floor(y/2) AS BIGINT) AS i, CAST(floor(x/2) AS BIGINT) AS j, max(h) AS h FROM sm GROUP BY 1,2), q AS (SELECT i+a AS i, j+b AS j, a*a+b*b AS d2, -a AS na, -b AS nb, h FROM oc, range(-3,4) u(a), range(-3,4) s(b) WHERE a*a+b*b <= 9) SELECT i, j, CAST(least(floor(sqrt(min(d2))*2*10),255) AS INT) AS distance_dm, round(arg_min(h, (d2, na, nb)),4) AS height FROM q GROUP BY 1,2")
def line_rasters(spark, d):
    """Distance to the nearest line in tenths of a metre, and that line's height, for every cell within three cells."""
    from tidemark.operators.raster import spread

    s = _segments(spark).select("seg", "ax", "ay", "bx", "by", F.explode(F.sequence(F.lit(0), F.lit(40))).alias("k"))
    s = s.select((F.col("ax") + (F.col("bx") - F.col("ax")) * F.col("k") / 40.0).alias("x"), (F.col("ay") + (F.col("by") - F.col("ay")) * F.col("k") / 40.0).alias("y"), (F.col("k") * 0.1).alias("h"))
    occupied = C.cells(s, 2.0, "yx").groupBy("i", "j").agg(F.max("h").alias("value"))
    d2 = F.col("di") * F.col("di") + F.col("dj") * F.col("dj")
    near = spread(occupied, 3).where(d2 <= 9).groupBy("i", "j").agg(F.min(F.struct(d2.alias("d2"), (-F.col("di")).alias("a"), (-F.col("dj")).alias("b"), "value")).alias("m"))
    return near.select("i", "j", F.least(F.floor(F.sqrt(F.col("m.d2").cast("double")) * 20), F.lit(255).cast("long")).cast("int").alias("distance_dm"), F.round("m.value", 4).alias("height"))
