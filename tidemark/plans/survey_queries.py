"""Queries on rotations, colour differences, rasters, paths, areas, samples, fits and merges, with oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import rotations as Q
from tidemark.functions import scalars as S
from tidemark.operators import areas, fits, merging, paths, sampling
from tidemark.operators import joins as J
from tidemark.operators import raster as R
from tidemark.operators.graph import cut
from tidemark.plans.registry import EV, PT, W, query, r
from tidemark.sources.tables import spatial_points, table, timed_events

CELLS = f"WITH {PT}, c AS (SELECT CAST(floor(x/2) AS BIGINT) AS i, CAST(floor(y/2) AS BIGINT) AS j, min(z) AS value FROM p GROUP BY 1,2)"


def _cells(spark, d):
    return spatial_points(spark, d).groupBy(F.floor(F.col("x") / 2).alias("i"), F.floor(F.col("y") / 2).alias("j")).agg(F.min("z").alias("value"))


# ---- rotations

ANG = "g AS (SELECT p_partkey, (p_partkey % 360) - 180.0 AS yaw, (p_size % 60) - 30.0 AS roll, (p_partkey % 50) - 25.0 AS pitch FROM part)"
TRIG = "q AS (SELECT *, cos(radians(yaw)) AS cy, sin(radians(yaw)) AS sy, cos(radians(-roll)) AS cr, sin(radians(-roll)) AS sr, cos(radians(-pitch)) AS cp, sin(radians(-pitch)) AS sp FROM g)"


def _angles(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", ((F.col("p_partkey") % 360) - 180.0).alias("yaw"), ((F.col("p_size") % 60) - 30.0).alias("roll"), ((F.col("p_partkey") % 50) - 25.0).alias("pitch"))


@query(f"""WITH {ANG}, {TRIG} SELECT p_partkey, round(cp*cy-sp*sr*sy,5)+0.0 AS m00, round(cp*sy+sp*sr*cy,5)+0.0 AS m01, round(sp*cr,5)+0.0 AS m02, round(-cr*sy,5)+0.0 AS m10, round(cr*cy,5)+0.0 AS m11, round(-sr,5)+0.0 AS m12,
round(-sp*cy-cp*sr*sy,5)+0.0 AS m20, round(-sp*sy+cp*sr*cy,5)+0.0 AS m21, round(cp*cr,5)+0.0 AS m22 FROM q""")
def vehicle_rotation(spark, d):
    m = Q.vehicle(F.col("yaw"), F.col("roll"), F.col("pitch"))
    return _angles(spark, d).select("p_partkey", *[r(m[i][j], 5).alias(f"m{i}{j}") for i in range(3) for j in range(3)])


@query(f"WITH {ANG} SELECT p_partkey, yaw, roll+0.0 AS roll, pitch+0.0 AS pitch FROM g")
def rotation_angles(spark, d):
    yaw, roll, pitch = Q.vehicle_angles(Q.vehicle(F.col("yaw"), F.col("roll"), F.col("pitch")))
    # -180 and 180 are one angle
    return _angles(spark, d).select("p_partkey", r(F.when(F.abs(yaw - 180) < 1e-6, -180.0).otherwise(yaw), 5).alias("yaw"), r(roll, 5).alias("roll"), r(pitch, 5).alias("pitch"))


@query(f"WITH {ANG} SELECT p_partkey, round(abs(yaw-30.0 - 360.0*round((yaw-30.0)/360.0)),4)+0.0 AS angle FROM g")
def rotation_distance(spark, d):
    z = F.lit(0.0)
    return _angles(spark, d).select("p_partkey", r(Q.angle_between(Q.vehicle(F.col("yaw"), z, z), Q.vehicle(F.lit(30.0), z, z))).alias("angle"))


@query(f"WITH {PT} SELECT vec_id, round(x,3)+0.0 AS x, round(y,3)+0.0 AS y, round(z,3)+0.0 AS z FROM p")
def pano_world_round_trip(spark, d):
    """World to panorama under a turned, shifted camera and back; the points must return."""
    k = F.col("label").cast("double")
    m = Q.times(Q.boresight(F.lit(0.3), F.lit(-0.2), F.lit(0.7)), Q.vehicle(k * 31, k % 5, k % 7))
    centre = [F.lit(1000.0), F.lit(-500.0), F.lit(30.0)]
    seen = Q.applied(m, [F.col(a) - c for a, c in zip("xyz", centre)])
    p = S.panorama(*seen)
    there = spatial_points(spark, d).select("vec_id", "label", p["u"].alias("u"), p["v"].alias("v"), p["r"].alias("range"))
    ray = S.ray(F.col("u"), F.col("v"))
    back = Q.applied(Q.transposed(m), [ray[a] * F.col("range") for a in "xyz"])
    return there.select("vec_id", *[r(b + c, 3).alias(a) for a, b, c in zip("xyz", back, centre)])


@query(f"WITH {EV} SELECT event_id, round(cos(radians((event_id % 90)*0.25)/2),5)+0.0 AS w, round(sin(radians((event_id % 90)*0.25)/2),5)+0.0 AS z FROM e")
def quaternion_interpolation(spark, d):
    half = F.radians((F.col("event_id") % 90).cast("double")) / 2
    z = F.lit(0.0)
    w, _, _, k = Q.between([F.lit(1.0), z, z, z], [F.cos(half), z, z, F.sin(half)], F.lit(0.25))
    return timed_events(spark, d).select("event_id", r(w, 5).alias("w"), r(k, 5).alias("z"))


@query(f"""WITH {PT}, s AS (SELECT label, var_pop(x) AS xx, var_pop(y) AS yy, var_pop(z) AS zz, covar_pop(x,y) AS xy, covar_pop(x,z) AS xz, covar_pop(y,z) AS yz FROM p GROUP BY 1),
m AS (SELECT *, (xx+yy+zz)/3 AS mu FROM s), q AS (SELECT *, sqrt((pow(xx-mu,2)+pow(yy-mu,2)+pow(zz-mu,2)+2*(xy*xy+xz*xz+yz*yz))/6) AS pp, (xx-mu)*((yy-mu)*(zz-mu)-yz*yz)-xy*(xy*(zz-mu)-yz*xz)+xz*(xy*yz-(yy-mu)*xz) AS det FROM m),
f AS (SELECT label, mu, pp, acos(least(greatest(det/(2*pow(pp,3)),-1),1))/3 AS phi FROM q) SELECT label, round(mu+2*pp*cos(phi),4)+0.0 AS l1, round(mu+2*pp*cos(phi-2*pi()/3),4)+0.0 AS l2, round(mu+2*pp*cos(phi+2*pi()/3),4)+0.0 AS l3 FROM f""")
def covariance_eigenvalues(spark, d):
    s = spatial_points(spark, d).groupBy("label").agg(*[F.covar_pop(a, b).alias(a + b) for a, b in ("xx", "yy", "zz", "xy", "xz", "yz")])
    return s.select("label", *[r(e).alias(f"l{i}") for i, e in enumerate(Q.eigenvalues(*[F.col(c) for c in ("xx", "yy", "zz", "xy", "xz", "yz")]), 1)])


@query(f"WITH {PT}, t AS (SELECT *, radians(label*2.0) AS a, label*0.5 AS s FROM p) SELECT vec_id, round(cos(a)*(x-10)-sin(a)*(y-20)+10+s,4)+0.0 AS x, round(sin(a)*(x-10)+cos(a)*(y-20)+20-s,4)+0.0 AS y, round(z+s,4)+0.0 AS z FROM t")
def group_transform(spark, d):
    """Each group's points turned about a centre and shifted by the group's own constants; unknown groups stay."""
    p = spatial_points(spark, d)
    known = p.select("label").distinct().select("label", (F.col("label") * 2.0).alias("turn"), (F.col("label") * 0.5).alias("s"))
    t = p.join(known, "label", "left").withColumns({"turn": F.coalesce("turn", F.lit(0.0)), "s": F.coalesce("s", F.lit(0.0))})
    x, y = S.rotated(F.col("x") - 10, F.col("y") - 20, F.col("turn"))
    return t.select("vec_id", r(x + 10 + F.col("s")).alias("x"), r(y + 20 - F.col("s")).alias("y"), r(F.col("z") + F.col("s")).alias("z"))


# ---- colour


@query("""WITH k AS (SELECT p_partkey, 50.0+(p_size%40) AS l1, (p_partkey%101)-50.0 AS a1, (p_size*7%101)-50.0 AS b1, 45.0+(p_partkey%30) AS l2, (p_size*3%101)-50.0 AS a2, (p_partkey*13%101)-50.0 AS b2 FROM part),
g AS (SELECT *, 1+0.5*(1-sqrt(pow((sqrt(a1*a1+b1*b1)+sqrt(a2*a2+b2*b2))/2,7)/(pow((sqrt(a1*a1+b1*b1)+sqrt(a2*a2+b2*b2))/2,7)+pow(25.0,7)))) AS g FROM k),
c AS (SELECT *, sqrt(g*a1*g*a1+b1*b1) AS c1, sqrt(g*a2*g*a2+b2*b2) AS c2, CASE WHEN a1=0 AND b1=0 THEN 0 ELSE degrees(atan2(b1,g*a1))-360*floor(degrees(atan2(b1,g*a1))/360) END AS h1, CASE WHEN a2=0 AND b2=0 THEN 0 ELSE degrees(atan2(b2,g*a2))-360*floor(degrees(atan2(b2,g*a2))/360) END AS h2 FROM g),
h AS (SELECT *, CASE WHEN c1*c2=0 THEN 0 WHEN h2-h1>180 THEN h2-h1-360 WHEN h2-h1<-180 THEN h2-h1+360 ELSE h2-h1 END AS dh0, CASE WHEN c1*c2=0 THEN h1+h2 WHEN abs(h1-h2)<=180 THEN (h1+h2)/2 WHEN h1+h2<360 THEN (h1+h2+360)/2 ELSE (h1+h2-360)/2 END AS hm, (l1+l2)/2 AS lm, (c1+c2)/2 AS cm FROM c),
t AS (SELECT *, 2*sqrt(c1*c2)*sin(radians(dh0/2)) AS dh, 1-0.17*cos(radians(hm-30))+0.24*cos(radians(2*hm))+0.32*cos(radians(3*hm+6))-0.20*cos(radians(4*hm-63)) AS t, 1+0.015*pow(lm-50,2)/sqrt(20+pow(lm-50,2)) AS sl, 1+0.045*cm AS sc, -2*sqrt(pow(cm,7)/(pow(cm,7)+pow(25.0,7)))*sin(radians(60*exp(-pow((hm-275)/25,2)))) AS rt FROM h),
u AS (SELECT p_partkey, (l2-l1)/sl AS l, (c2-c1)/sc AS c, dh/(1+0.015*cm*t) AS h, rt FROM t) SELECT p_partkey, round(sqrt(l*l+c*c+h*h+rt*c*h),4)+0.0 AS de FROM u""")
def ciede2000(spark, d):
    size, key = F.col("p_size"), F.col("p_partkey")
    a = (50.0 + size % 40, key % 101 - 50.0, size * 7 % 101 - 50.0)
    b = (45.0 + key % 30, size * 3 % 101 - 50.0, key * 13 % 101 - 50.0)
    return table(spark, d, "part").select("p_partkey", r(S.ciede2000(a, b)).alias("de"))


# ---- rasters

NINE = "(SELECT a.i, a.j, b.i-a.i AS di, b.j-a.j AS dj, b.value AS v FROM c a JOIN c b ON abs(a.i-b.i)<=1 AND abs(a.j-b.j)<=1)"


IMAGE = "n AS (SELECT count(*) // 20 AS h FROM part), c AS (SELECT p_partkey // 20 AS i, p_partkey % 20 AS j, (p_size*5)%256 AS value FROM part), d3 AS (SELECT a AS di, b AS dj FROM (VALUES (-1),(0),(1)) t(a), (VALUES (-1),(0),(1)) s(b)), nine AS (SELECT a.i, a.j, di, dj, b.value AS v FROM c a, d3, n JOIN c b ON b.i = CASE WHEN a.i+di < 0 THEN 1 WHEN a.i+di >= h THEN h-2 ELSE a.i+di END AND b.j = CASE WHEN a.j+dj < 0 THEN 1 WHEN a.j+dj >= 20 THEN 18 ELSE a.j+dj END)"


def _image(spark, d):
    """Parts as an image without gaps, 20 columns wide, and its height."""
    part = table(spark, d, "part")
    return part.select(F.floor(F.col("p_partkey") / 20).alias("i"), (F.col("p_partkey") % 20).alias("j"), (F.col("p_size") * 5 % 256).alias("value")), part.count() // 20


@query(f"WITH {IMAGE} SELECT i, j, round_even(sum(v)/9.0, 0) AS value FROM nine GROUP BY 1,2")
def footprint_mean(spark, d):
    image, h = _image(spark, d)
    return R.mean3(image, 20, h).select("i", "j", "value")


@query(f"WITH {IMAGE} SELECT i, j, round(sqrt(pow(sum(v*di*(2-abs(dj))),2)+pow(sum(v*dj*(2-abs(di))),2))/8,4)+0.0 AS value FROM nine GROUP BY 1,2")
def gradient_magnitude(spark, d):
    image, h = _image(spark, d)
    return R.gradient(image, 20, h).select("i", "j", r("value").alias("value"))


@query(f"WITH {IMAGE}, l AS (SELECT i, j, sum(CASE WHEN di=0 AND dj=0 THEN -4*v WHEN di=0 OR dj=0 THEN v ELSE 0 END) AS v FROM nine GROUP BY 1,2) SELECT CAST(count(*) AS BIGINT) AS n, round(var_pop(v),3) AS sharpness FROM l")
def laplacian_sharpness(spark, d):
    image, h = _image(spark, d)
    return R.laplacian(image, 20, h).agg(F.count("*").alias("n"), F.round(F.var_pop("value"), 3).alias("sharpness"))


@query(f"{CELLS} SELECT a.i, a.j, round(quantile_cont(b.value,0.5),4)+0.0 AS value FROM c a JOIN c b ON abs(a.i-b.i)<=2 AND abs(a.j-b.j)<=2 GROUP BY 1,2")
def median_filter(spark, d):
    return R.median_filter(_cells(spark, d)).select("i", "j", r("value").alias("value"))


TAPS = """f AS (SELECT vec_id, z, x/2-0.5 AS fi, y/2-0.5 AS fj FROM p), o AS (SELECT unnest([0,0,1,1]) AS a, unnest([0,1,0,1]) AS b), t AS (SELECT vec_id, z, floor(fi)+a AS i, floor(fj)+b AS j, (CASE a WHEN 1 THEN fi-floor(fi) ELSE 1-(fi-floor(fi)) END)*(CASE b WHEN 1 THEN fj-floor(fj) ELSE 1-(fj-floor(fj)) END) AS w FROM f, o)"""


PLACES = "q AS (SELECT vec_id, x-20*floor(x/20) AS u, y+5 AS v FROM p)"


def _places(spark, d):
    return spatial_points(spark, d).select("vec_id", F.col("x").alias("u"), (F.col("y") + 5).alias("v"))


@query(f"WITH {PT}, {IMAGE}, {PLACES}, f AS (SELECT vec_id, u-0.5 AS fx, least(greatest(least(greatest(v,0),h-1)-0.5,0),h-1) AS fy, h FROM q, n), o AS (SELECT a, b FROM (VALUES (0),(1)) t(a), (VALUES (0),(1)) s(b)), t AS (SELECT vec_id, least(floor(fy)+b,h-1) AS i, (floor(fx)+a+20)%20 AS j, (CASE a WHEN 1 THEN fx-floor(fx) ELSE 1-(fx-floor(fx)) END)*(CASE b WHEN 1 THEN fy-floor(fy) ELSE 1-(fy-floor(fy)) END) AS w FROM f, o) SELECT vec_id, round(sum(w*value),4)+0.0 AS value FROM t JOIN c USING (i,j) GROUP BY 1")
def bilinear_sample(spark, d):
    image, h = _image(spark, d)
    return R.image_bilinear(_places(spark, d), image, "vec_id", 20, h).select("vec_id", r("value").alias("value"))


@query(f"WITH {PT}, {IMAGE}, {PLACES}, t AS (SELECT vec_id, floor(least(greatest(v,0),h-1)) AS i, floor(u)%20 AS j FROM q, n) SELECT vec_id, value FROM t JOIN c USING (i,j)")
def nearest_sample(spark, d):
    image, h = _image(spark, d)
    return R.image_nearest(_places(spark, d), image, "vec_id", 20, h).select("vec_id", "value")


@query(f"WITH {PT}, {IMAGE}, {PLACES}, m AS (SELECT i, j, round_even(sum(v)/9.0, 0) AS value FROM nine GROUP BY 1,2), f AS (SELECT vec_id, u-0.5 AS fx, least(greatest(least(greatest(v,0),h-1)-0.5,0),h-1) AS fy, h FROM q, n), o AS (SELECT a, b FROM (VALUES (0),(1)) t(a), (VALUES (0),(1)) s(b)), t AS (SELECT vec_id, least(floor(fy)+b,h-1) AS i, (floor(fx)+a+20)%20 AS j, (CASE a WHEN 1 THEN fx-floor(fx) ELSE 1-(fx-floor(fx)) END)*(CASE b WHEN 1 THEN fy-floor(fy) ELSE 1-(fy-floor(fy)) END) AS w FROM f, o) SELECT vec_id, round(sum(w*value),3)+0.0 AS value FROM t JOIN m USING (i,j) GROUP BY 1")
def footprint_sample(spark, d):
    """3x3 means of the image, sampled between cell centres."""
    image, h = _image(spark, d)
    return R.image_bilinear(_places(spark, d), R.mean3(image, 20, h), "vec_id", 20, h).select("vec_id", r("value", 3).alias("value"))


@query(f"WITH {PT}, {IMAGE}, {PLACES}, m AS (SELECT i, j, sqrt(pow(sum(v*di*(2-abs(dj))),2)+pow(sum(v*dj*(2-abs(di))),2))/8 AS value FROM nine GROUP BY 1,2), f AS (SELECT vec_id, u-0.5 AS fx, least(greatest(least(greatest(v,0),h-1)-0.5,0),h-1) AS fy, h FROM q, n), o AS (SELECT a, b FROM (VALUES (0),(1)) t(a), (VALUES (0),(1)) s(b)), t AS (SELECT vec_id, least(floor(fy)+b,h-1) AS i, (floor(fx)+a+20)%20 AS j, (CASE a WHEN 1 THEN fx-floor(fx) ELSE 1-(fx-floor(fx)) END)*(CASE b WHEN 1 THEN fy-floor(fy) ELSE 1-(fy-floor(fy)) END) AS w FROM f, o) SELECT vec_id, round(sum(w*value),3)+0.0 AS value FROM t JOIN m USING (i,j) GROUP BY 1")
def gradient_sample(spark, d):
    image, h = _image(spark, d)
    return R.image_bilinear(_places(spark, d), R.gradient(image, 20, h), "vec_id", 20, h).select("vec_id", r("value", 3).alias("value"))


@query(f"""{CELLS}, s AS (SELECT i, j, value, unnest(range(-2,3)) AS di FROM c), q AS (SELECT *, unnest(range(-2,3)) AS dj FROM s), d AS (SELECT i+di AS i, j+dj AS j, arg_min(value, (di*di+dj*dj, -di, -dj)) AS ground FROM q WHERE di*di+dj*dj <= 4 GROUP BY 1,2), {TAPS}
SELECT vec_id, round(any_value(z)-sum(w*ground),4)+0.0 AS height FROM t JOIN d USING (i,j) GROUP BY 1 HAVING count(*)=4""")
def height_above_ground(spark, d):
    """Points over the bilinear ground: the lowest value of each cell, holes filled by the nearest."""
    p = spatial_points(spark, d)
    ground = R.bilinear(p, R.filled(_cells(spark, d), 2), "vec_id", 2.0)
    return p.join(ground, "vec_id").select("vec_id", r(F.col("z") - F.col("value")).alias("height"))


LAB = f"{CELLS}, lb AS (SELECT i, j, CASE WHEN value < -5 THEN 0 WHEN value < 5 THEN 1 ELSE 2 END AS value FROM c)"


def _labels(spark, d):
    return _cells(spark, d).withColumn("value", F.when(F.col("value") < -5, 0).when(F.col("value") < 5, 1).otherwise(2))


@query(f"{LAB} SELECT a.i, a.j, a.value AS label, round(least(coalesce(min(CASE WHEN a.value<>b.value THEN sqrt((a.i-b.i)*(a.i-b.i)+(a.j-b.j)*(a.j-b.j)) END),3.0),3.0),4) AS distance, round(least(1.0, least(coalesce(min(CASE WHEN a.value<>b.value THEN sqrt((a.i-b.i)*(a.i-b.i)+(a.j-b.j)*(a.j-b.j)) END),3.0),3.0)/3.0),4) AS factor FROM lb a JOIN lb b ON abs(a.i-b.i)<=3 AND abs(a.j-b.j)<=3 GROUP BY 1,2,3")
def distance_to_boundary(spark, d):
    found = R.distance_to_change(_labels(spark, d), 3)
    return found.select("i", "j", F.col("value").alias("label"), F.round("distance", 4).alias("distance"), F.round(F.least(F.lit(1.0), F.col("distance") / 3.0), 4).alias("factor"))


@query("""WITH c AS (SELECT p_partkey // 20 AS i, p_partkey % 20 AS j, p_size % 4 AS gt, (p_size + (p_partkey % 7 = 0)::INT) % 3 AS pred FROM part), v AS (SELECT * FROM c WHERE gt <> 3), k AS (SELECT * FROM (VALUES (0),(1),(2)) t(cls), (VALUES (1),(2)) s(reach)),
g AS (SELECT DISTINCT cls, reach, a.i, a.j FROM v a JOIN k ON a.gt=cls JOIN v b ON b.gt<>cls AND (a.i-b.i)*(a.i-b.i)+pow(least(abs(a.j-b.j),20-abs(a.j-b.j)),2) <= reach*reach), q AS (SELECT DISTINCT cls, reach, a.i, a.j FROM v a JOIN k ON a.pred=cls JOIN v b ON b.pred<>cls AND (a.i-b.i)*(a.i-b.i)+pow(least(abs(a.j-b.j),20-abs(a.j-b.j)),2) <= reach*reach)
SELECT cls, reach, count(*) FILTER (g.i IS NOT NULL AND q.i IS NOT NULL) AS both_, count(*) AS either FROM g FULL JOIN q USING (cls, reach, i, j) GROUP BY 1,2""")
def boundary_iou(spark, d):
    """Cells of a class near another labelled class, in truth and prediction: how many are both, and either; columns wrap."""
    c = table(spark, d, "part").select(F.floor(F.col("p_partkey") / 20).alias("i"), (F.col("p_partkey") % 20).alias("j"), (F.col("p_size") % 4).alias("gt"), ((F.col("p_size") + (F.col("p_partkey") % 7 == 0).cast("int")) % 3).alias("pred")).where("gt <> 3")
    edges = [R.near_other(c.select("i", "j", F.col(x).alias("value")), reach, 20).select(F.col("value").alias("cls"), F.lit(reach).alias("reach"), "i", "j", F.lit(x).alias("side")) for x in ("gt", "pred") for reach in (1, 2)]
    each = edges[0].union(edges[1]).union(edges[2]).union(edges[3]).groupBy("cls", "reach", "i", "j").agg(F.count("*").alias("n"))
    return each.groupBy("cls", "reach").agg(F.count_if(F.col("n") == 2).alias("both_"), F.count("*").alias("either"))


@query(f"{CELLS}, s AS (SELECT unnest(range(-2,3)) AS shift), m AS (SELECT a.value AS x, b.value AS y, shift FROM c b, s, c a WHERE a.i=b.i AND a.j=((b.j+shift)%64+64)%64) SELECT CAST(shift AS INT) AS shift, round(corr(x,y),5) AS ncc, count(*) AS n FROM m GROUP BY 1")
def cyclic_correlation(spark, d):
    c = _cells(spark, d)
    return R.cyclic_correlation(c, c, 64, range(-2, 3)).select("shift", F.round("ncc", 5).alias("ncc"), "n")


@query(f"""WITH RECURSIVE {CELLS.removeprefix('WITH ')}, m AS (SELECT a.i, a.j, max((b.value, b.i, b.j)) AS m FROM c a JOIN c b ON abs(a.i-b.i)<=1 AND abs(a.j-b.j)<=1 GROUP BY 1,2), s AS (SELECT i, j, m[2] AS ti, m[3] AS tj FROM m),
w AS (SELECT i, j, ti, tj FROM s UNION SELECT w.i, w.j, s.ti, s.tj FROM w JOIN s ON w.ti=s.i AND w.tj=s.j) SELECT i, j, ti AS pi, tj AS pj FROM w WHERE EXISTS (SELECT 1 FROM s WHERE s.i=w.ti AND s.j=w.tj AND s.ti=s.i AND s.tj=s.j)""")
def crown_peaks(spark, d):
    return R.uphill(_cells(spark, d), cut)


@query(f"WITH {PT} SELECT CAST(floor(x/5) AS BIGINT) AS i, CAST(floor(y/5) AS BIGINT) AS j, arg_max(label, (z, vec_id)) AS label, round(max(z),4)+0.0 AS z FROM p GROUP BY 1,2")
def top_down_view(spark, d):
    top = spatial_points(spark, d).groupBy(F.floor(F.col("x") / 5).alias("i"), F.floor(F.col("y") / 5).alias("j")).agg(F.max(F.struct("z", "vec_id", "label")).alias("m"))
    return top.select("i", "j", F.col("m.label").alias("label"), r("m.z").alias("z"))


@query("WITH g AS (SELECT (l_partkey%100)::INT AS row, l_linenumber%3 AS gt, (l_quantity::INT)%3 AS pred FROM lineitem) SELECT gt, pred, round(sum(cos(radians(90.0-(row+0.5)*1.8))),3) AS w FROM g GROUP BY 1,2")
def latitude_confusion(spark, d):
    g = table(spark, d, "lineitem").select((F.col("l_partkey") % 100).alias("row"), (F.col("l_linenumber") % 3).alias("gt"), (F.col("l_quantity").cast("int") % 3).alias("pred"))
    return g.groupBy("gt", "pred").agg(F.round(F.sum(F.cos(F.radians(90.0 - (F.col("row") + 0.5) * 1.8))), 3).alias("w"))


@query("""WITH v AS (SELECT l_orderkey AS cell, l_suppkey%6 AS native, l_quantity::DOUBLE AS q, pow(cos(radians(l_linenumber*10.0)),2) AS w FROM lineitem), n AS (SELECT cell, native, sum(q*w) AS s FROM v GROUP BY 1,2), t AS (SELECT cell, CASE WHEN native IN (0,1) THEN 0 WHEN native IN (2,3,4) THEN 1 ELSE 2 END AS cls, sum(s) AS s FROM n GROUP BY 1,2), a AS (SELECT cell, sum(s) AS total FROM t GROUP BY 1)
SELECT cell, arg_max(cls, (round(s,6), -cls)) AS cls, round(max(s)/any_value(total),5) AS conf FROM t JOIN a USING (cell) GROUP BY 1""")
def fused_classes(spark, d):
    """View probabilities weighted by cos^2, summed by common class; the largest wins, ties to the lower class."""
    v = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("cell"), (F.col("l_suppkey") % 6).alias("native"), (F.col("l_quantity").cast("double") * F.pow(F.cos(F.radians(F.col("l_linenumber") * 10.0)), F.lit(2.0))).alias("s"))
    common = F.when(F.col("native").isin(0, 1), 0).when(F.col("native").isin(2, 3, 4), 1).otherwise(2)
    t = v.groupBy("cell", common.alias("cls")).agg(F.sum("s").alias("s"))
    return t.groupBy("cell").agg(F.max_by("cls", F.struct(F.round("s", 6), -F.col("cls"))).alias("cls"), F.round(F.max("s") / F.sum("s"), 5).alias("conf"))


# ---- paths

LINE = f"WITH {EV}, v AS (SELECT user_id, row_number() {W} AS n, value AS x0, lead(value) {W} AS x1, t/3600 AS y0, lead(t/3600) {W} AS y1 FROM e), s AS (SELECT *, sqrt(pow(x1-x0,2)+pow(y1-y0,2)) AS len FROM v WHERE x1 IS NOT NULL)"


def _lines(spark, d):
    return timed_events(spark, d).select("user_id", "t", "event_id", F.col("value").alias("x"), (F.col("t") / 3600).alias("y"))


@query(f"""{LINE}, g AS (SELECT *, sum(len) OVER (PARTITION BY user_id ORDER BY n) AS b FROM s WHERE len>0), k AS (SELECT *, b-len AS a, unnest(range(ceil((b-len)/50)::BIGINT, ceil(b/50)::BIGINT)) AS k FROM g) SELECT user_id, k, round(x0+(x1-x0)*(k*50.0-a)/len,3)+0.0 AS x, round(y0+(y1-y0)*(k*50.0-a)/len,2)+0.0 AS y FROM k""")
def polyline_resample(spark, d):
    return paths.resampled_along(_lines(spark, d), "user_id", ["t", "event_id"], ["x", "y"], 50.0).select("user_id", "k", r("x", 3).alias("x"), r("y", 2).alias("y"))


@query(f"""{LINE}, k AS (SELECT *, greatest(ceil(len/100),1)::INT AS parts, unnest(range(1, greatest(ceil(len/100),1)::INT+1))::INT AS m FROM s WHERE len > 1e-9) SELECT user_id, CAST(n AS INT) AS n, m, round(x0+(x1-x0)*m/parts,3)+0.0 AS x, round(y0+(y1-y0)*m/parts,2)+0.0 AS y FROM k""")
def polyline_subdivide(spark, d):
    return paths.subdivided(_lines(spark, d), "user_id", ["t", "event_id"], ["x", "y"], 100.0).select("user_id", "n", "m", r("x", 3).alias("x"), r("y", 2).alias("y"))


@query(f"""WITH {EV}, u AS (SELECT event_id, user_id, t, value*7 - 360.0*floor(value*7/360.0) AS u FROM e), b AS (SELECT *, lag(u) {W} AS before FROM u), x AS (SELECT *, CASE WHEN abs(u-before)>180 THEN ((CASE WHEN u<before THEN 360.0 ELSE 0.0 END)-before)/(u+(CASE WHEN u<before THEN 360.0 ELSE -360.0 END)-before) END AS s FROM b)
SELECT event_id, CAST(count(s) {W} AS BIGINT) AS piece, round(s,4)+0.0 AS edge_share FROM x""")
def seam_split(spark, d):
    u = timed_events(spark, d).withColumn("u", F.col("value") * 7 - 360.0 * F.floor(F.col("value") * 7 / 360.0))
    return paths.seam_pieces(u, "user_id", ["t", "event_id"], "u", 360.0).select("event_id", "piece", r("edge_share").alias("edge_share"))


def _l(k: int) -> str:
    return f"lead(value,{k}) {W}" if k > 0 else f"lag(value,{-k}) {W}" if k else "value"


def _weighted(weights: tuple[int, ...], first: int) -> str:
    return "(" + "+".join(f"({w})*({_l(first + i)})" for i, w in enumerate(weights)) + ")/35.0"


@query(f"""WITH {EV}, n AS (SELECT *, row_number() {W} AS a, count(*) OVER (PARTITION BY user_id) AS n FROM e) SELECT event_id, round(CASE WHEN n<5 THEN value WHEN a=1 THEN {_weighted((31, 9, -3, -5, 3), 0)} WHEN a=2 THEN {_weighted((9, 13, 12, 6, -5), -1)} WHEN a=n THEN {_weighted((3, -5, -3, 9, 31), -4)} WHEN a=n-1 THEN {_weighted((-5, 6, 12, 13, 9), -3)} ELSE {_weighted((-3, 12, 17, 12, -3), -2)} END,4)+0.0 AS smooth FROM n""")
def smoothed_series(spark, d):
    return paths.smoothed(timed_events(spark, d), ["user_id"], ["t", "event_id"], "value").select("event_id", r("smooth").alias("smooth"))


@query(f"""WITH {EV}, o AS (SELECT *, abs(value-quantile_cont(value,0.5) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)) AS off FROM e), l AS (SELECT user_id, quantile_cont(off,0.5)*1.4826*1.5 AS lim FROM o GROUP BY 1), k AS (SELECT o.*, off>lim AS outlier FROM o JOIN l USING (user_id)),
b AS (SELECT *, last_value(CASE WHEN NOT outlier THEN t END IGNORE NULLS) {W} AS ta, last_value(CASE WHEN NOT outlier THEN value END IGNORE NULLS) {W} AS xa, first_value(CASE WHEN NOT outlier THEN t END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS tb, first_value(CASE WHEN NOT outlier THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS xb FROM k)
SELECT event_id, outlier, round(CASE WHEN NOT outlier THEN value WHEN ta IS NULL THEN xb WHEN tb IS NULL OR ta=tb THEN xa ELSE xa+(xb-xa)*(t-ta)/(tb-ta) END,4)+0.0 AS repaired FROM b""")
def repaired_series(spark, d):
    return paths.repaired(timed_events(spark, d), "user_id", ["t", "event_id"], "t", "value", gate=1.5).select("event_id", "outlier", r("repaired").alias("repaired"))


@query(f"WITH {EV}, i AS (SELECT user_id, min(t) AS lo, min(t)+864000 AS hi FROM e WHERE event_type='purchase' GROUP BY 1) SELECT event_id FROM e JOIN i USING (user_id) WHERE t>lo AND t<=hi")
def interval_cover(spark, d):
    e = timed_events(spark, d)
    i = e.where("event_type = 'purchase'").groupBy(F.col("user_id").alias("owner")).agg(F.min("t").alias("lo")).withColumn("hi", F.col("lo") + 864_000)
    cover = J.interval_join(e.select("event_id", "user_id", "t"), i, "t", 86_400.0)
    return cover.where("owner = user_id").select("event_id")


# ---- areas

POLY = "n AS (SELECT n_nationkey AS poly, (n_nationkey*7%41)-20.0 AS cx, (n_nationkey*11%37)-18.0 AS cy, 4.0+n_nationkey%6 AS s FROM nation), ed AS (SELECT poly, s, unnest([cx-s,cx+s,cx+s/2]) AS ax, unnest([cy-s,cy-s/3,cy+s]) AS ay, unnest([cx+s,cx+s/2,cx-s]) AS bx, unnest([cy-s/3,cy+s,cy-s]) AS byy FROM n)"


def _polygons(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("poly"), (F.col("n_nationkey") * 7 % 41 - 20.0).alias("cx"), (F.col("n_nationkey") * 11 % 37 - 18.0).alias("cy"), (4.0 + F.col("n_nationkey") % 6).alias("s"))
    cx, cy, s = F.col("cx"), F.col("cy"), F.col("s")
    v = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return n.select("poly", F.array(v(cx - s, cy - s), v(cx + s, cy - s / 3), v(cx + s / 2, cy + s)).alias("ring"))


CROSSED = "((ay>{y})<>(byy>{y})) AND {x} < ax+({y}-ay)*(bx-ax)/(byy-ay)"


@query(f"WITH {PT}, {POLY} SELECT poly, vec_id FROM p, ed WHERE {CROSSED.format(x='x', y='y')} GROUP BY 1,2 HAVING count(*)%2=1")
def point_in_polygon(spark, d):
    return areas.points_in_polygons(spatial_points(spark, d), _polygons(spark, d), 10.0).select("poly", "vec_id")


@query(f"""WITH {POLY}, ar AS (SELECT poly, abs(sum(ax*byy-bx*ay))/2 AS area FROM ed GROUP BY 1), g AS (SELECT unnest(range(-40,41)) AS i), c AS (SELECT g.i, h.i AS j, (g.i+0.5)*2.0 AS x, (h.i+0.5)*2.0 AS y FROM g, g h), w AS (SELECT c.i, c.j, poly FROM c, ed WHERE {CROSSED.format(x='c.x', y='c.y')} GROUP BY 1,2,3 HAVING count(*)%2=1) SELECT i, j, arg_min(poly, (area, poly)) AS poly FROM w JOIN ar USING (poly) GROUP BY 1,2""")
def polygon_raster(spark, d):
    return areas.rasterized(_polygons(spark, d), 2.0, "poly")


@query(f"WITH {POLY} SELECT poly, round(abs(sum(ax*byy-bx*ay))/2,4) AS area FROM ed GROUP BY 1")
def polygon_area(spark, d):
    return _polygons(spark, d).select("poly", F.round(areas.area(F.col("ring")), 4).alias("area"))


# ---- selections

EVENLY = "WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey)-1 AS rank, count(*) OVER () AS n FROM orders)"


@query(f"{EVENLY}, k AS (SELECT DISTINCT (unnest(range(0,100))*(n-1))//99 AS pos FROM (SELECT DISTINCT n FROM r)) SELECT o_orderkey, rank FROM r WHERE rank IN (SELECT pos FROM k)")
def evenly_spaced(spark, d):
    return sampling.evenly(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 100).select("o_orderkey", "rank")


@query(f"{EVENLY} SELECT o_orderkey FROM r WHERE rank % 7 = 0")
def every_kth_row(spark, d):
    return sampling.every_kth(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 7).select("o_orderkey")


@query("WITH m AS (SELECT c_custkey, c_nationkey, count(*) OVER (PARTITION BY c_nationkey) AS n, count(*) OVER () AS total, row_number() OVER (PARTITION BY c_nationkey ORDER BY md5(c_custkey || ':7'), c_custkey) AS pos FROM customer) SELECT c_custkey, c_nationkey FROM m WHERE pos <= greatest(1, round_even(50.0*n/total, 0))")
def proportional_sample(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return sampling.per_group(c, ["c_nationkey"], "c_custkey", F.greatest(F.lit(1.0), F.rint(F.lit(50.0) * F.col("_n") / c.count())), 7)


@query(f"WITH {EV}, b AS (SELECT *, ntile(5) {W} AS block FROM e), q AS (SELECT *, ntile(3) OVER (PARTITION BY user_id, block ORDER BY value, t, event_id) AS tercile FROM b), s AS (SELECT *, row_number() OVER (PARTITION BY user_id, block, tercile ORDER BY md5(event_id || ':3'), event_id) AS pos FROM q) SELECT event_id, CAST(block AS INT) AS block, CAST(tercile AS INT) AS tercile FROM s WHERE pos <= 2")
def block_tercile_sample(spark, d):
    cut_ = sampling.block_terciles(timed_events(spark, d), "user_id", ["t", "event_id"], "value")
    return sampling.per_group(cut_, ["user_id", "block", "tercile"], "event_id", F.lit(2), 3).select("event_id", "block", "tercile")


# ---- merges and comparisons


@query("""SELECT o_orderkey, CASE WHEN o_totalprice > 150000 THEN 'own' ELSE 'reference' END AS colour, o_totalprice <= 150000 AS fallback, length(o_orderpriority)::INT AS label, coalesce(m, -1) AS cluster FROM orders LEFT JOIN (SELECT l_orderkey AS o_orderkey, min(l_suppkey)::BIGINT AS m FROM lineitem WHERE l_discount > 0.08 GROUP BY 1) USING (o_orderkey)""")
def product_merge(spark, d):
    o = table(spark, d, "orders")
    clusters = table(spark, d, "lineitem").where("l_discount > 0.08").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_suppkey").cast("long").alias("cluster"))
    base, own = o.select("o_orderkey", F.lit("reference").alias("colour")), o.where("o_totalprice > 150000").select("o_orderkey", F.lit("own").alias("colour"))
    return merging.merged(base, "o_orderkey", own, o.select("o_orderkey", F.length("o_orderpriority").alias("label")), clusters).select("o_orderkey", "colour", "fallback", "label", "cluster")


BANDS = f"WITH {PT}, k AS (SELECT CAST(floor(x/4) AS BIGINT) AS i, CAST(floor(y/4) AS BIGINT) AS j, CASE WHEN z < 0 THEN label END AS low, CASE WHEN z >= 0 THEN label END AS high FROM p)"


@query(f"""{BANDS}, n AS (SELECT i, j, high, count(*) AS n FROM k WHERE high IS NOT NULL GROUP BY 1,2,3), own AS (SELECT i, j, arg_max(high, (n, -high)) AS own FROM n GROUP BY 1,2), grown AS (SELECT i+a AS i, j+b AS j, max(own) AS grown FROM own, (VALUES (-1),(0),(1)) t(a), (VALUES (-1),(0),(1)) s(b) GROUP BY 1,2),
lo AS (SELECT low, coalesce(own, grown) AS under, count(*) AS n FROM k LEFT JOIN own USING (i,j) LEFT JOIN grown USING (i,j) WHERE low IS NOT NULL GROUP BY 1,2), t AS (SELECT low, sum(n) AS total, max((n, -under)) FILTER (under IS NOT NULL) AS m FROM lo GROUP BY 1) SELECT low, -m[2] AS high FROM t WHERE m[1] >= 0.1*total""")
def band_attach(spark, d):
    k = spatial_points(spark, d).select(F.floor(F.col("x") / 4).alias("i"), F.floor(F.col("y") / 4).alias("j"), F.when(F.col("z") < 0, F.col("label")).alias("low"), F.when(F.col("z") >= 0, F.col("label")).alias("high"))
    return merging.attached(k, 0.1)


@query(f"""WITH {PT}, c AS (SELECT vec_id, vec_id%37 AS id, x, y, z FROM p), s AS (SELECT id, count(DISTINCT (floor(x/0.5), floor(y/0.5)))*0.25 AS area FROM c GROUP BY 1), f AS (SELECT arg_min(id, vec_id) AS id, arg_min(x, vec_id) AS x, arg_min(y, vec_id) AS y, arg_min(z, vec_id) AS z FROM c GROUP BY floor(x/2), floor(y/2), floor(z/2)),
n AS (SELECT a.id, b.id AS into_, count(*) AS n FROM f a JOIN s sa ON sa.id=a.id JOIN f b ON (a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z) <= 25 JOIN s sb ON sb.id=b.id WHERE sa.area < 3.3 AND sb.area >= 3.5 GROUP BY 1,2) SELECT id, -(max((n, -into_)))[2] AS "into" FROM n GROUP BY 1""")
def fragment_absorb(spark, d):
    c = spatial_points(spark, d).select(F.col("vec_id").alias("point"), (F.col("vec_id") % 37).alias("id"), "x", "y", "z")
    return merging.absorbed(c, "id", 2.0, 5.0, 3.3, 3.5)


@query("""WITH p AS (SELECT l_orderkey, max(l_extendedprice)::DOUBLE/1000 AS a, min(l_extendedprice)::DOUBLE/1000+l_orderkey%20 AS b FROM lineitem GROUP BY 1) SELECT CAST(l_orderkey%5 AS BIGINT) AS grp, count(*) AS n, round(quantile_cont(a,0.5),4) AS median_before, round(quantile_cont(b,0.5),4) AS median_after, round(avg(CASE WHEN a-b > 2 THEN 1.0 ELSE 0 END),5) AS improved, round(avg(CASE WHEN b-a > 2 THEN 1.0 ELSE 0 END),5) AS worsened FROM p GROUP BY 1""")
def before_after(spark, d):
    p = table(spark, d, "lineitem").groupBy("l_orderkey").agg((F.max("l_extendedprice").cast("double") / 1000).alias("a"), (F.min("l_extendedprice").cast("double") / 1000).alias("b")).withColumn("b", F.col("b") + F.col("l_orderkey") % 20)
    share = lambda c: F.round(F.avg(F.when(c > 2, 1.0).otherwise(0.0)), 5)
    middle = lambda c: F.round(F.percentile(c, F.lit(0.5)), 4)
    return p.groupBy((F.col("l_orderkey") % 5).alias("grp")).agg(F.count("*").alias("n"), middle("a").alias("median_before"), middle("b").alias("median_after"), share(F.col("a") - F.col("b")).alias("improved"), share(F.col("b") - F.col("a")).alias("worsened"))


@query("SELECT user_id, round(quantile_cont(value,0.5) FILTER (event_type='click'),4) AS click, round(quantile_cont(value,0.5) FILTER (event_type='view'),4) AS view, round(quantile_cont(value,0.5) FILTER (event_type='purchase'),4) AS purchase FROM events GROUP BY 1")
def pivoted_medians(spark, d):
    e = table(spark, d, "events").groupBy("user_id").pivot("event_type", ["click", "view", "purchase"]).agg(F.round(F.percentile("value", F.lit(0.5)), 4))
    return e.select("user_id", "click", "view", "purchase")


@query("SELECT user_id, CAST(sum(('0x' || substr(sha256(event_id || '|' || event_type),1,10))::BIGINT) AS BIGINT) AS digest FROM events GROUP BY 1")
def content_digest(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(merging.digest(F.concat_ws("|", F.col("event_id").cast("string"), "event_type")).alias("digest"))


@query("WITH l AS (SELECT DISTINCT l_orderkey, l_suppkey%7 AS pass FROM lineitem), c AS (SELECT l_orderkey, l_suppkey%7 AS pass, count(*) AS n FROM lineitem GROUP BY 1,2), o AS (SELECT c.*, row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, pass) AS pos FROM c WHERE pass <> l_orderkey%7) SELECT l_orderkey, pass::BIGINT AS pass, n FROM o WHERE pos=1")
def dominant_other_pass(spark, d):
    c = table(spark, d, "lineitem").groupBy("l_orderkey", (F.col("l_suppkey") % 7).cast("long").alias("pass")).agg(F.count("*").alias("n")).where(F.col("pass") != F.col("l_orderkey") % 7)
    return c.groupBy("l_orderkey").agg(F.max(F.struct("n", (-F.col("pass")).alias("minus"))).alias("m")).select("l_orderkey", (-F.col("m.minus")).alias("pass"), "m.n")


# ---- fits


@query(f"""WITH {PT}, a AS (SELECT label, quantile_cont(x,0.5) AS o FROM p GROUP BY 1), b AS (SELECT label, avg(x) AS o FROM p JOIN a USING (label) WHERE abs(x-o)<=20 GROUP BY 1), c AS (SELECT label, avg(x) AS o FROM p JOIN b USING (label) WHERE abs(x-o)<=10 GROUP BY 1) SELECT label, round(avg(x),4)+0.0 AS "offset", count(*) AS n FROM p JOIN c USING (label) WHERE abs(x-o)<=5 GROUP BY 1""")
def shrinking_gate_offset(spark, d):
    return fits.gated_offset(spatial_points(spark, d).select("label", "x"), "x", ["label"], [20.0, 10.0, 5.0]).select("label", r("offset").alias("offset"), "n")


@query("SELECT user_id, count(*) AS n, round(regr_intercept(value, ts_h),3)+0.0 AS c0, round(regr_slope(value, ts_h),4)+0.0 AS c1, round(regr_r2(value, ts_h),4)+0.0 AS r2 FROM (SELECT user_id, value, extract(hour FROM ts)::DOUBLE AS ts_h FROM events) GROUP BY 1")
def normal_equations(spark, d):
    e = table(spark, d, "events").select("user_id", "value", F.hour(F.col("ts").cast("timestamp")).cast("double").alias("h"))
    f = fits.least_squares(e, [F.lit(1.0), F.col("h")], F.col("value"), ["user_id"])
    return f.select("user_id", "n", r(F.col("coefficients")[0], 3).alias("c0"), r(F.col("coefficients")[1]).alias("c1"), r("r2").alias("r2"))


@query(f"WITH {EV}, d AS (SELECT user_id, t, value, lag(value) {W} AS a FROM e) SELECT user_id, max(abs(value-a)) FILTER (a IS NOT NULL) AS largest, count(a) AS steps FROM d GROUP BY 1")
def largest_steps(spark, d):
    w = Window.partitionBy("user_id").orderBy("t", "event_id")
    s = timed_events(spark, d).withColumn("a", F.lag("value").over(w))
    return s.groupBy("user_id").agg(F.max(F.abs(F.col("value") - F.col("a"))).alias("largest"), F.count("a").alias("steps"))
