"""Queries on frame products, colours and labels of points, with oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import aggregates as A
from tidemark.operators import frames as P
from tidemark.operators import raster as R
from tidemark.operators import store as T
from tidemark.operators.sampling import shuffled
from tidemark.plans.registry import FRS, query, r
from tidemark.sources.tables import frames, scan_points, table

ZW, ZH, SPACING = 72, 36, 0.6
PAIRS = f"""WITH {FRS}, fq AS (SELECT *, cos(radians(yaw)) AS cy, sin(radians(yaw)) AS sy, cos(radians(-roll)) AS cr, sin(radians(-roll)) AS sr, cos(radians(-pitch)) AS cp, sin(radians(-pitch)) AS sp FROM fr),
pr AS (SELECT f.*, pt.id, pt.cls, pt.gps, pt.x, pt.y, pt.z, pt.r AS pr, pt.g AS pg, pt.b AS pb, x-e AS dx, y-n AS dy, z-h AS dz FROM pt JOIN fq f ON (x-e)*(x-e)+(y-n)*(y-n) <= 1600 AND abs(gps-t) <= 45),
cm AS (SELECT *, (cp*cy-sp*sr*sy)*dx+(cp*sy+sp*sr*cy)*dy+sp*cr*dz AS qx, -cr*sy*dx+cr*cy*dy-sr*dz AS qy, (-sp*cy-cp*sr*sy)*dx+(-sp*sy+cp*sr*cy)*dy+cp*cr*dz AS qz FROM pr),
ag AS (SELECT *, 180.0-degrees(atan2(qy,qx)) AS q, degrees(atan2(qz,sqrt(qx*qx+qy*qy))) AS el, sqrt(qx*qx+qy*qy+qz*qz) AS rg FROM cm),
pj AS (SELECT *, (q-360.0*floor(q/360.0))/360.0*{ZW} AS u, (90.0-el)/180.0*{ZH} AS v FROM ag WHERE rg BETWEEN 1 AND 40),
cc AS (SELECT *, least(greatest(CAST(trunc(v) AS BIGINT),0),{ZH - 1}) AS i, CAST(trunc(u) AS BIGINT)%{ZW} AS j FROM pj)"""
PRODUCT = f"""{PAIRS}, sz AS (SELECT *, least(greatest(1.2::DOUBLE*{SPACING}*{ZW}/(2*pi())/rg,1.0),8.0) AS ra FROM cc), sb AS (SELECT *, least(ra/greatest(abs(cos((0.5-(i+0.5)/{ZH})*pi())),1e-6),{ZW}/2.0) AS rb FROM sz), e1 AS (SELECT *, unnest(range(-CAST(trunc(ra+0.999) AS INT), CAST(trunc(ra+0.999) AS INT)+1)) AS di FROM sb), e2 AS (SELECT *, unnest(range(-CAST(trunc(rb+0.999) AS INT), CAST(trunc(rb+0.999) AS INT)+1)) AS dj FROM e1),
sp2 AS (SELECT frame, i+di AS i, ((j+dj)%{ZW}+{ZW})%{ZW} AS j, rg, id FROM e2 WHERE dj*dj/(rb*rb)+di*di/(ra*ra) <= 1.0 AND i+di BETWEEN 0 AND {ZH - 1}), prod AS (SELECT frame, i, j, CAST(least(greatest(round_even(min(rg)*1000,0),1),65535) AS INT) AS depth_mm, arg_min(id, (rg, id)) AS point FROM sp2 GROUP BY 1,2,3)"""
CLOSED = f"""{PRODUCT}, dm AS (SELECT frame, i, j, depth_mm*0.001::DOUBLE AS value FROM prod), gg AS (SELECT frame, a AS i, b AS j FROM fr, range({ZH}) t(a), range({ZW}) s(b)), d3 AS (SELECT a AS di, b AS dj FROM (VALUES (-1),(0),(1)) t(a), (VALUES (-1),(0),(1)) s(b)),
ero AS (SELECT gg.frame, gg.i, gg.j, min(coalesce(dm.value,1e6)) AS value FROM gg, d3 LEFT JOIN dm ON dm.frame=gg.frame AND dm.i=gg.i+di AND dm.j=(gg.j+dj+{ZW})%{ZW} WHERE gg.i+di BETWEEN 0 AND {ZH - 1} GROUP BY 1,2,3), dil AS (SELECT gg.frame, gg.i, gg.j, max(e.value) AS value FROM gg, d3 JOIN ero e ON e.frame=gg.frame AND e.i=gg.i+di AND e.j=(gg.j+dj+{ZW})%{ZW} GROUP BY 1,2,3),
cl AS (SELECT frame, i, j, least(dil.value, coalesce(dm.value,1e6)) AS value FROM dil LEFT JOIN dm USING (frame,i,j)), cd AS (SELECT * FROM cl WHERE value < 1e6), sd AS (SELECT gg.frame, gg.i, gg.j, max(cd.value)-min(cd.value) AS spread FROM gg, d3 JOIN cd ON cd.frame=gg.frame AND cd.i=gg.i+di AND cd.j=(gg.j+dj+{ZW})%{ZW} GROUP BY 1,2,3),
vis AS (SELECT cc.*, value IS NOT NULL AND rg <= value + greatest(0.15, 0.03*rg, least(coalesce(spread,0),2.0), least(0.12/greatest(sin(abs(radians(90.0-(i+0.5)/{ZH}*180.0))),0.05),2.0)) AS visible FROM cc LEFT JOIN cd USING (frame,i,j) LEFT JOIN sd USING (frame,i,j))"""


def _seen(spark, d):
    return P.projected(P.candidates(scan_points(spark, d), frames(spark, d)), ZW, ZH)


def _product(spark, d):
    return P.products(scan_points(spark, d), frames(spark, d), ZW, ZH, SPACING)


@query(f"{PAIRS} SELECT frame, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM pr GROUP BY 1")
def frame_candidates(spark, d):
    """Points in reach of each frame in place and time."""
    return P.candidates(scan_points(spark, d), frames(spark, d)).groupBy("frame").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@query(f"{PAIRS} SELECT frame, id, round(u,4)+0.0 AS u, round(v,4)+0.0 AS v, round(rg,4) AS range FROM pj")
def frame_projection(spark, d):
    return _seen(spark, d).select("frame", "id", r("u").alias("u"), r("v").alias("v"), r("range").alias("range"))


@query(f"{PRODUCT} SELECT frame, i, j, depth_mm, point FROM prod")
def frame_products(spark, d):
    """Depth and point of every frame's cells: gather, project and splat."""
    return _product(spark, d)


@query(f"{PRODUCT}, q AS (SELECT frame, id, (id*37)%8000+0.25::DOUBLE AS u, (id*91)%4200+0.5::DOUBLE AS v FROM pt, fr), c AS (SELECT frame, id, CAST(trunc(u*{ZW}/8000.0) AS BIGINT)%{ZW} AS j, least(greatest(CAST(trunc(v*{ZW}/8000.0) AS BIGINT),0),{ZH - 1}) AS i FROM q) SELECT frame, id, i, j, depth_mm*0.001::DOUBLE AS range, point FROM c LEFT JOIN prod USING (frame,i,j)")
def product_lookup(spark, d):
    """Cell, range and point at full-resolution places of every frame; empty cells are null."""
    places = scan_points(spark, d).select("id", (F.col("id") * 37 % 8000 + 0.25).alias("u"), (F.col("id") * 91 % 4200 + 0.5).alias("v")).join(F.broadcast(frames(spark, d).select("frame")))
    row, column = S.cell_of(F.col("u") * ZW / S.PANO_W, F.col("v") * ZW / S.PANO_W, ZW, ZH)
    met = places.withColumns({"i": row, "j": column}).join(_product(spark, d), ["frame", "i", "j"], "left")
    return met.select("frame", "id", "i", "j", P.depth_of(F.col("depth_mm")).alias("range"), "point")


@query(f"{CLOSED} SELECT frame, id, visible FROM vis")
def product_visible(spark, d):
    """Which candidates a frame sees, by its own closed depth."""
    return P.visible_points(_seen(spark, d), _product(spark, d), ZW, ZH).select("frame", "id", "visible")


FILL = f"fl AS (SELECT frame, i+a AS i, (j+b+{ZW})%{ZW} AS j, arg_min(point, (a*a+b*b, -a, -b)) AS point FROM prod, (VALUES (-2),(-1),(0),(1),(2)) t(a), (VALUES (-2),(-1),(0),(1),(2)) s(b) WHERE a*a+b*b <= 4 AND i+a BETWEEN 0 AND {ZH - 1} GROUP BY 1,2,3)"


@query(f"{PRODUCT}, {FILL} SELECT fl.frame, fl.i, fl.j, fl.point, pt.intensity, pt.cls, CAST(floor(255*ln(1+pt.intensity)/ln(65536.0)) AS INT) AS grey FROM fl JOIN pt ON pt.id=fl.point")
def layer_gather(spark, d):
    """Attributes of the point in each cell, small holes filled by the nearest cell, with the grey value of a picture."""
    cells = R.filled(_product(spark, d).select("frame", "i", "j", F.col("point").alias("value")), 2, ZW, ZH, ("frame",)).withColumnRenamed("value", "point")
    p = scan_points(spark, d).select(F.col("id").alias("point"), "intensity", "cls")
    return cells.join(p, "point").select("frame", "i", "j", "point", "intensity", "cls", F.floor(255 * F.log1p("intensity") / F.log(F.lit(65536.0))).cast("int").alias("grey"))


@query(f"{PRODUCT}, {FILL} SELECT frame, i, j, coalesce(pt.cls, 255) AS label FROM fl LEFT JOIN pt ON pt.id=fl.point AND pt.tile%3<>0")
def label_gather(spark, d):
    """Labels of the point in each cell; points of tiles without labels read as nothing (255)."""
    cells = R.filled(_product(spark, d).select("frame", "i", "j", F.col("point").alias("value")), 2, ZW, ZH, ("frame",))
    labels = scan_points(spark, d).where("tile % 3 <> 0").select(F.col("id").alias("value"), "cls")
    return cells.join(labels, "value", "left").select("frame", "i", "j", F.coalesce("cls", F.lit(255)).alias("label"))


@query(f"{PRODUCT}, dm AS (SELECT frame, i, j, depth_mm*0.001::DOUBLE AS value FROM prod), sd AS (SELECT * FROM (VALUES (0,1),(0,-1),(1,0),(-1,0)) t(di,dj)), x AS (SELECT a.frame, a.i, a.j, bool_or(coalesce(b.value-a.value > greatest(0.5, 0.15*a.value), false)) AS jump, bool_or(b.value IS NULL) AS open FROM dm a CROSS JOIN sd LEFT JOIN dm b ON b.frame=a.frame AND b.i=least(greatest(a.i+di,0),{ZH - 1}) AND b.j=(a.j+dj+{ZW})%{ZW} GROUP BY 1,2,3), y AS (SELECT *, open AND 90.0-(i+0.5)/{ZH}*180.0 > 0 AS sky, 90.0-(i+0.5)/{ZH}*180.0 >= -60 AS keep FROM x) SELECT frame, i, j, jump AND keep AND NOT sky AS depth_edge, sky AND keep AS sky_edge FROM y")
def depth_edges(spark, d):
    """Cells at the near side of a jump in depth, and those against the sky."""
    depth = _product(spark, d).select("frame", "i", "j", P.depth_of(F.col("depth_mm")).alias("value"))
    return P.edges(depth, ZW, ZH)


# ---- images and masks: the parts are an image of 20 columns that every camera sees, in other colours

IMG = "hh AS (SELECT count(*) // 20 AS h FROM part), im AS (SELECT p_partkey // 20 AS a, p_partkey % 20 AS b, (p_size*5)%256 AS value FROM part)"
SEEN = f"ix AS (SELECT vis.*, least(floor(v/{ZH}.0*hh.h),hh.h-1) AS a, floor(u/{ZW}.0*20)%20 AS b FROM vis, hh), px AS (SELECT ix.*, value AS c0, (value*7+frame*13)%256 AS c1, (value*11+frame)%256 AS c2 FROM ix JOIN im USING (a,b)), gd AS (SELECT *, (c0=255 OR c1=255 OR c2=255 OR (c0<=2 AND c1<=2 AND c2<=2)) AS sat, i >= {ZH - 4} AS veh FROM px)"


def _sampled(spark, d):
    """Visible and other candidates with the colour of their pixel; the lowest rows show the vehicle itself."""
    part = table(spark, d, "part")
    h = part.count() // 20
    image = part.select(F.floor(F.col("p_partkey") / 20).alias("a"), (F.col("p_partkey") % 20).alias("b"), (F.col("p_size") * 5 % 256).alias("value"))
    seen = P.visible_points(_seen(spark, d), _product(spark, d), ZW, ZH)
    at = seen.withColumns({"a": F.least(F.floor(F.col("v") / ZH * h), F.lit(h - 1).cast("long")), "b": F.floor(F.col("u") / ZW * 20) % 20}).join(image, ["a", "b"])
    vehicle = spark.range(ZH - 4, ZH).select(F.col("id").alias("i")).withColumn("on_vehicle", F.lit(True))
    at = at.withColumns({"c0": F.col("value"), "c1": (F.col("value") * 7 + F.col("frame") * 13) % 256, "c2": (F.col("value") * 11 + F.col("frame")) % 256})
    return at.join(F.broadcast(vehicle), "i", "left").fillna(False, ["on_vehicle"])


@query(f"{CLOSED}, {IMG}, {SEEN} SELECT frame, count(*) AS n, count(*) FILTER (sat) AS saturated, count(*) FILTER (veh) AS on_vehicle, count(*) FILTER (visible AND NOT sat AND NOT veh) AS used FROM gd GROUP BY 1")
def sample_quality(spark, d):
    s = _sampled(spark, d)
    sat = P.saturated(F.col("c0"), F.col("c1"), F.col("c2"))
    used = F.col("visible") & ~sat & ~F.col("on_vehicle")
    return s.groupBy("frame").agg(F.count("*").alias("n"), F.count_if(sat).alias("saturated"), F.count_if("on_vehicle").alias("on_vehicle"), F.count_if(used).alias("used"))


LIN = "CASE WHEN {c}/255.0<=0.04045 THEN {c}/255.0/12.92 ELSE pow(({c}/255.0+0.055)/1.055,2.4) END"
TOP = ", ".join(f"{LIN.format(c='c' + str(k))} AS l{k}" for k in range(3))
SRGB = "CAST(round_even(round(255*(CASE WHEN {c}<=0.0031308 THEN 12.92*{c} ELSE 1.055*pow({c},1/2.4::DOUBLE)-0.055 END),6),0) AS INT)"


@query(f"""{CLOSED}, {IMG}, {SEEN}, sc AS (SELECT id, frame, {TOP}, 1.0/(1.0+(rg/8.0)*(rg/8.0)) AS score FROM gd WHERE visible AND NOT sat AND NOT veh), tk AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, frame) <= 5),
md AS (SELECT id, quantile_cont(l0,0.5) AS m0, quantile_cont(l1,0.5) AS m1, quantile_cont(l2,0.5) AS m2, count(*) AS views, arg_min(frame, (-score, frame)) AS frame FROM tk GROUP BY 1), aw AS (SELECT tk.id, l0, l1, l2, sqrt((l0-m0)*(l0-m0)+(l1-m1)*(l1-m1)+(l2-m2)*(l2-m2)) AS away FROM tk JOIN md USING (id)), ma AS (SELECT id, quantile_cont(away,0.5) AS mad FROM aw GROUP BY 1),
kp AS (SELECT id, quantile_cont(l0,0.5) AS k0, quantile_cont(l1,0.5) AS k1, quantile_cont(l2,0.5) AS k2 FROM aw JOIN ma USING (id) WHERE round(away,9) <= round(2.5*mad+0.001,9) GROUP BY 1), fu AS (SELECT id, coalesce(k0,m0) AS f0, coalesce(k1,m1) AS f1, coalesce(k2,m2) AS f2, views, frame, mad FROM md JOIN ma USING (id) LEFT JOIN kp USING (id))
SELECT id, {SRGB.format(c='f0')} AS r, {SRGB.format(c='f1')} AS g, {SRGB.format(c='f2')} AS b, CAST(views AS INT) AS views, frame, CAST(floor(least(greatest(round(255.0*(1.0-(CASE WHEN views>=2 THEN mad ELSE 0.15 END)/0.15),6),0),255)) AS INT) AS conf FROM fu""")
def coloured_points(spark, d):
    """Colour of every point from the frames that see it: gather, project, hide, sample, keep the five best, fuse."""
    s = _sampled(spark, d).where(F.col("visible") & ~F.col("on_vehicle") & ~P.saturated(F.col("c0"), F.col("c1"), F.col("c2")))
    s = s.withColumns({"score": S.distance_score(F.col("range")), **{f"l{k}": S.to_linear(F.col(f"c{k}")) for k in range(3)}})
    fused = A.robust_colour(s, "id", ["l0", "l1", "l2"], "score", ["frame"])
    return fused.select("id", *[S.to_srgb(F.col(f"l{k}")).alias(c) for k, c in enumerate("rgb")], "views", F.col("best_frame").alias("frame"), "conf")


@query(f"""{CLOSED}, ms AS (SELECT *, (i*3+j//9+frame)%9 AS lab, (i*29+j*13+frame*7)%256 AS cf FROM vis WHERE visible AND i < {ZH - 4}), vt AS (SELECT id, frame, CASE WHEN lab=8 THEN 255 ELSE lab END AS lab, cf/255.0*(1.0/(1.0+(rg/8.0)*(rg/8.0))) AS w FROM ms WHERE lab<>7 AND lab<>8 AND cf >= 40),
sw AS (SELECT id, lab, sum(w) AS w, count(*) AS n FROM vt GROUP BY 1,2), tt AS (SELECT id, arg_min(lab, (-round(w,6), lab)) AS winner, max(round(w,6)) AS top, sum(w) AS total, sum(n) AS views FROM sw GROUP BY 1), bs AS (SELECT id, arg_min(frame, (-w, frame)) AS frame FROM vt WHERE w > 0 GROUP BY 1)
SELECT pt.id, coalesce(CASE WHEN total > 0 THEN winner END, 255) AS label, CAST(coalesce(CASE WHEN total > 0 THEN round_even(round(255*top/total,6),0) END, 0) AS INT) AS conf, CAST(coalesce(views,0) AS BIGINT) AS views, bs.frame FROM pt LEFT JOIN tt USING (id) LEFT JOIN bs USING (id)""")
def labelled_points(spark, d):
    """Label of every point by votes of the masks of the frames that see it; sky (7) and nothing (8, 255) cast none."""
    seen = P.visible_points(_seen(spark, d), _product(spark, d), ZW, ZH).where(F.col("visible") & (F.col("i") < ZH - 4))
    label = (F.col("i") * 3 + F.floor(F.col("j") / 9) + F.col("frame")) % 9
    conf = (F.col("i") * 29 + F.col("j") * 13 + F.col("frame") * 7) % 256
    votes = seen.withColumns({"label": label, "cf": conf}).where(~F.col("label").isin(7, 8) & (F.col("cf") >= 40)).withColumn("w", F.col("cf") / 255.0 * S.distance_score(F.col("range")))
    won = A.vote(votes, "id", "label", "w", ["frame"])
    full = scan_points(spark, d).select("id").join(won, "id", "left")
    return full.select("id", F.coalesce("winner", F.lit(255)).alias("label"), F.coalesce("conf", F.lit(0)).alias("conf"), F.coalesce("views", F.lit(0).cast("long")).alias("views"), F.col("best_frame").alias("frame"))


# ---- frames and tiles

BOXES = f"WITH {FRS}, bb AS (SELECT tile, min(x) AS min_e, min(y) AS min_n, max(x) AS max_e, max(y) AS max_n FROM pt GROUP BY 1)"


@query(f"{BOXES} SELECT tile, frame FROM bb JOIN fr ON e >= min_e-8 AND e <= max_e+8 AND n >= min_n-8 AND n <= max_n+8")
def frames_of_tiles(spark, d):
    """Frames whose place lies in a tile's extent grown by their reach: the tiles' boxes as intervals on a grid."""
    tiles = T.bounds(scan_points(spark, d))
    grown = tiles.select("tile", *[(F.col(c) + s).alias(c) for c, s in (("min_e", -8.0), ("min_n", -8.0), ("max_e", 8.0), ("max_n", 8.0))])
    at = lambda c: F.floor(c / 20)
    cut = grown.select("*", F.explode(F.sequence(at(F.col("min_e")), at(F.col("max_e")))).alias("ci")).select("*", F.explode(F.sequence(at(F.col("min_n")), at(F.col("max_n")))).alias("cj"))
    f = frames(spark, d).select("frame", "e", "n", at(F.col("e")).alias("ci"), at(F.col("n")).alias("cj"))
    return f.join(cut, ["ci", "cj"]).where(F.col("e").between(F.col("min_e"), F.col("max_e")) & F.col("n").between(F.col("min_n"), F.col("max_n"))).select("tile", "frame")


@query(f"{BOXES}, x AS (SELECT frame, tile, pow(greatest(min_e-e,0,e-max_e),2)+pow(greatest(min_n-n,0,n-max_n),2) AS d2 FROM fr, bb) SELECT frame, arg_min(tile, (round(d2,9), tile)) AS tile, round(min(d2),4)+0.0 AS d2 FROM x GROUP BY 1")
def camera_tiles(spark, d):
    """The tile nearest to each camera; the catalogue of tiles is one small row set, sent to every task."""
    f = frames(spark, d).select("frame", "e", "n").join(F.broadcast(T.bounds(scan_points(spark, d)).drop("n")))
    d2 = F.round(T.box_distance2(F.col("e"), F.col("n")), 9)
    return f.groupBy("frame").agg(F.min(F.struct(d2.alias("d2"), "tile")).alias("m")).select("frame", "m.tile", r("m.d2").alias("d2"))


@query(f"WITH {FRS} SELECT frame FROM fr WHERE e BETWEEN -20 AND 15 AND n BETWEEN -12 AND 18")
def frames_in_box(spark, d):
    return frames(spark, d).where(F.col("e").between(-20, 15) & F.col("n").between(-12, 18)).select("frame")


@query(f"{BOXES}, q AS (SELECT frame, pass_id%4 AS cls, e, n FROM fr) SELECT tile, count(frame) AS near, count(*) FILTER (cls=0) AS clean, count(*) FILTER (cls=1) AS unverified, count(*) FILTER (cls=2) AS usable, count(*) FILTER (cls=3) AS reject FROM bb LEFT JOIN q ON sqrt(pow(greatest(min_e-e,0,e-max_e),2)+pow(greatest(min_n-n,0,n-max_n),2)) <= 20 GROUP BY 1")
def tile_summary(spark, d):
    """Frames within 20 m of each tile, by their quality."""
    tiles, f = T.bounds(scan_points(spark, d)).drop("n"), frames(spark, d).select("frame", (F.col("pass_id") % 4).alias("cls"), "e", "n")
    met = tiles.join(F.broadcast(f), F.sqrt(T.box_distance2(F.col("e"), F.col("n"))) <= 20, "left")
    names = ("clean", "unverified", "usable", "reject")
    return met.groupBy("tile").agg(F.count("frame").alias("near"), *[F.count_if(F.col("cls") == k).alias(c) for k, c in enumerate(names)])


@query(f"{PAIRS}, s AS (SELECT frame, id, row_number() OVER (PARTITION BY frame ORDER BY md5(id || ':7'), id) AS k FROM pr) SELECT frame, id FROM s WHERE k <= 10")
def sampled_candidates(spark, d):
    """Ten candidates of each frame, by a seeded shuffle."""
    from pyspark.sql.window import Window

    pairs = P.candidates(scan_points(spark, d), frames(spark, d)).select("frame", "id")
    w = Window.partitionBy("frame").orderBy(shuffled("id", 7), "id")
    return pairs.withColumn("k", F.row_number().over(w)).where("k <= 10").drop("k")
