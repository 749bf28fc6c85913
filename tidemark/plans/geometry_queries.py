"""Queries on scan planes, wires, lines in panoramas, invariance of transforms and small tables, with oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import rotations as Q
from tidemark.functions import scalars as S
from tidemark.operators import detection as D
from tidemark.operators import fits
from tidemark.operators import frames as P
from tidemark.operators import ordered as O  # noqa: E741
from tidemark.operators import posetables as T
from tidemark.plans import report_queries
from tidemark.plans.cluster_queries import EIGEN
from tidemark.plans.pose_queries import AT, EP, MAT, SEG, TURNED, _poses
from tidemark.plans.registry import FRS, PTS, as_sql, query, r
from tidemark.sources.tables import frames, scan_points, table

# ---- planes and wires


@query(f"""WITH {PTS}, o AS (SELECT psid, min(gps) AS t0, max(gps) AS t1 FROM pt GROUP BY 1), bk AS (SELECT pt.*, CAST(floor((gps-t0)/20.0) AS BIGINT) AS bu, CAST(floor((t1-t0)/20.0) AS BIGINT) AS en FROM pt JOIN o USING (psid)), w AS (SELECT *, unnest([bu-1,bu]) AS st FROM bk), cv AS (SELECT psid, st, count(*) AS n, avg(gps) AS t, avg(x) AS mx, avg(y) AS my, avg(z) AS mz, var_pop(x) AS xx, var_pop(y) AS yy, var_pop(z) AS zz, covar_pop(x,y) AS xy, covar_pop(x,z) AS xz, covar_pop(y,z) AS yz FROM w WHERE st >= 0 AND st <= greatest(en-1,0) GROUP BY 1,2 HAVING count(*) >= 12), {EIGEN}
SELECT psid, st AS start, n, round(t,4) AS t, round(mx,4)+0.0 AS x, round(my,4)+0.0 AS y, round(mz,4)+0.0 AS z, round(sqrt(greatest(q3,0)),3) AS rms FROM ev WHERE sqrt(greatest(q3,0)) <= 9""")
def scan_planes(spark, d):
    p = D.scan_planes(scan_points(spark, d), "psid", "gps", 20.0, 12, 9.0)
    return p.select("psid", "start", "n", F.round("t", 4).alias("t"), *[r(c).alias(c) for c in "xyz"], F.round("rms", 3).alias("rms"))


WIRE = f"""WITH RECURSIVE {PTS}, wp AS (SELECT id, x, y, z+20 AS hag FROM pt WHERE id%3<>0 UNION ALL SELECT 100000+k, k*0.9-30.0::DOUBLE, k*0.3-10.0::DOUBLE, 60.0::DOUBLE FROM range(70) t(k)), pc AS (SELECT *, CAST(floor(y/1) AS BIGINT) AS i, CAST(floor(x/1) AS BIGINT) AS j FROM wp), pl AS (SELECT i, j, min(hag) FILTER (hag > 45) AS low, max(hag) FILTER (hag <= 45) AS under FROM pc GROUP BY 1,2),
al AS (SELECT i, j FROM pl WHERE low IS NOT NULL AND (under IS NULL OR under < low-1.5)), s3 AS (SELECT a, b FROM (VALUES (-1),(0),(1)) t(a), (VALUES (-1),(0),(1)) u(b)), er AS (SELECT i+a AS i, j+b AS j FROM al, s3 GROUP BY 1,2 HAVING count(*)=9), op AS (SELECT DISTINCT i+a AS i, j+b AS j FROM er, s3), th AS (SELECT i, j FROM al WHERE NOT EXISTS (SELECT 1 FROM op WHERE op.i=al.i AND op.j=al.j)),
di AS (SELECT DISTINCT i+a AS i, j+b AS j FROM th, s3), cl AS (SELECT i+a AS i, j+b AS j FROM di, s3 GROUP BY 1,2 HAVING count(*)=9), br AS (SELECT i, j FROM cl UNION SELECT i, j FROM th), ed AS (SELECT p.i*10000000+p.j AS a, q.i*10000000+q.j AS b FROM br p JOIN br q ON abs(p.i-q.i)<=1 AND abs(p.j-q.j)<=1), wk AS (SELECT i*10000000+j AS node, i*10000000+j AS c FROM br UNION SELECT ed.b, wk.c FROM wk JOIN ed ON ed.a=wk.node), co AS (SELECT node, min(c) AS comp FROM wk GROUP BY 1),
ms AS (SELECT comp, count(*) AS n, var_samp(j*1.0) AS xx, var_samp(i*1.0) AS yy, covar_samp(j*1.0,i*1.0) AS xy FROM br JOIN co ON co.node=i*10000000+j GROUP BY 1 HAVING count(*) >= 8), eg AS (SELECT comp, (xx+yy)/2+sqrt(pow(xx-yy,2)/4+xy*xy) AS e1, (xx+yy)/2-sqrt(pow(xx-yy,2)/4+xy*xy) AS e2 FROM ms), kc AS (SELECT i, j FROM br JOIN co ON co.node=i*10000000+j JOIN eg USING (comp) WHERE 4*sqrt(e1) >= 5 AND e2/greatest(e1,1e-9) < 0.1)"""


@query(f"{WIRE} SELECT id FROM pc WHERE hag > 45 AND EXISTS (SELECT 1 FROM kc WHERE kc.i=pc.i AND kc.j=pc.j) AND EXISTS (SELECT 1 FROM th WHERE th.i=pc.i AND th.j=pc.j)")
def wire_points(spark, d):
    """Points of a wire strung over a scan."""
    k = F.col("id")
    wire = spark.range(70).select((k + 100000).alias("id"), (k * 0.9 - 30.0).alias("x"), (k * 0.3 - 10.0).alias("y"), F.lit(60.0).alias("hag"))
    p = scan_points(spark, d).where("id % 3 <> 0").select("id", "x", "y", (F.col("z") + 20).alias("hag")).union(wire)
    return D.wires(p, 1.0, 45.0, 1.5, 3.0, 5.0, 0.1, 8).select("id")


# ---- lines in panoramas

LN = "ln AS (SELECT k AS line, -30.0::DOUBLE AS ax, k*5-20.0::DOUBLE AS ay, 0.0::DOUBLE AS az, 30.0::DOUBLE AS bx, k*4-18.0::DOUBLE AS by_, 2.0::DOUBLE AS bz FROM range(8) t(k))"


def _lines(spark):
    k = F.col("id")
    return spark.range(8).select(k.alias("line"), F.lit(-30.0).alias("ax"), (k * 5 - 20.0).alias("ay"), F.lit(0.0).alias("az"), F.lit(30.0).alias("bx"), (k * 4 - 18.0).alias("by"), F.lit(2.0).alias("bz"))


@query(f"""{MAT}, {LN}, w3 AS (SELECT ln.*, mt.*, sqrt(pow(bx-ax,2)+pow(by_-ay,2)+pow(bz-az,2)) AS l FROM ln, mt WHERE frame%4=0), w4 AS (SELECT *, least(greatest(((e-ax)*(bx-ax)+(n-ay)*(by_-ay)+(h-az)*(bz-az))/(l*l),0),1) AS tt FROM w3), w5 AS (SELECT *, greatest(sqrt(pow(ax+(bx-ax)*tt-e,2)+pow(ay+(by_-ay)*tt-n,2)+pow(az+(bz-az)*tt-h,2)),0.5) AS dm FROM w4), q AS (SELECT *, least(greatest(CAST(ceil(round(l/(dm*tan(radians(5.0))),9)) AS BIGINT),1),20000) AS k FROM w5), u AS (SELECT *, unnest(range(1,k+1)) AS step FROM q), w0 AS (SELECT frame, line, step, ax+(bx-ax)*(step/k)-e AS dx, ay+(by_-ay)*(step/k)-n AS dy, az+(bz-az)*(step/k)-h AS dz, m00,m01,m02,m10,m11,m12,m20,m21,m22 FROM u),
w1 AS (SELECT frame, line, step, m00*dx+m01*dy+m02*dz AS x, m10*dx+m11*dy+m12*dz AS y, m20*dx+m21*dy+m22*dz AS z FROM w0), w2 AS (SELECT *, 180.0-degrees(atan2(y,x)) AS a, sqrt(x*x+y*y+z*z) AS rg FROM w1) SELECT frame, line, step, round((a-360.0*floor(a/360.0))/360.0*8000,3)+0.0 AS u, round((90.0-degrees(atan2(z,sqrt(x*x+y*y))))/180.0*4000,3)+0.0 AS v, round(0.14::DOUBLE/greatest(rg,0.5)*8000/(2*pi()),4) AS half_width, rg BETWEEN 1 AND 40 AS in_range FROM w2""")
def projected_lines(spark, d):
    """Lines in the panoramas of some frames: sampled by angle, projected, with the width of their tolerance."""
    f = P.turned(frames(spark, d).where("frame % 4 = 0"))
    met = D.subdivided_from(f.join(F.broadcast(_lines(spark))), [F.col("e"), F.col("n"), F.col("h")], 5.0)
    m = [[F.col(c) for c in P.TURN[3 * k : 3 * k + 3]] for k in range(3)]
    met = met.withColumns(dict(zip(("qx", "qy", "qz"), Q.applied(m, [F.col("x") - F.col("e"), F.col("y") - F.col("n"), F.col("z") - F.col("h")]))))
    at = S.panorama(F.col("qx"), F.col("qy"), F.col("qz"))
    met = met.withColumns({"u": at["u"], "v": at["v"], "rg": at["r"]})
    width = 0.14 / F.greatest(F.col("rg"), F.lit(0.5)) * S.PANO_W / (2 * 3.141592653589793)
    return met.select("frame", "line", "step", r("u", 3).alias("u"), r("v", 3).alias("v"), F.round(width, 4).alias("half_width"), F.col("rg").between(1, 40).alias("in_range"))


# ---- poses


@query(f"WITH {FRS} SELECT frame, 0.0::DOUBLE AS worst FROM fr")
def transform_invariance(spark, d):
    """How far a place in the panorama moves when points and pose get the same pass transform: not at all."""
    f = frames(spark, d)
    moves = f.select("pass_id").distinct().select("pass_id", (F.col("pass_id") * 0.1).alias("dx"), (F.col("pass_id") * -0.2).alias("dy"), F.lit(0.05).alias("dz"), (F.col("pass_id") * 0.7).alias("dyaw"), F.lit(3.0).alias("cx"), F.lit(-4.0).alias("cy"))
    p = scan_points(spark, d).where("id % 10 = 3").select("id", "x", "y", "z")
    both = f.select("frame", "pass_id").join(F.broadcast(p))
    c, s = F.cos(F.radians("dyaw")), F.sin(F.radians("dyaw"))
    moved = both.join(F.broadcast(moves), "pass_id").select(
        "frame", "id", (c * (F.col("x") - 3.0) - s * (F.col("y") + 4.0) + 3.0 + F.col("dx")).alias("x"), (s * (F.col("x") - 3.0) + c * (F.col("y") + 4.0) - 4.0 + F.col("dy")).alias("y"), (F.col("z") + F.col("dz")).alias("z")
    )

    def seen(rows, poses, name):
        at = P.turned(poses).select("frame", "t", "e", "n", "h", *P.TURN)
        m = [[F.col(k) for k in P.TURN[3 * k : 3 * k + 3]] for k in range(3)]
        out = rows.join(F.broadcast(at), "frame")
        out = out.withColumns(dict(zip(("qx", "qy", "qz"), Q.applied(m, [F.col("x") - F.col("e"), F.col("y") - F.col("n"), F.col("z") - F.col("h")]))))
        uv = S.panorama(F.col("qx"), F.col("qy"), F.col("qz"))
        return out.select("frame", "id", uv["u"].alias("u" + name), uv["v"].alias("v" + name))

    met = seen(both.drop("pass_id"), f, "0").join(seen(moved, T.transformed(f, moves), "1"), ["frame", "id"])
    du = F.abs(F.col("u0") - F.col("u1"))
    off = F.greatest(F.least(du, S.PANO_W - du), F.abs(F.col("v0") - F.col("v1")))
    return met.groupBy("frame").agg(r(F.max(off), 4).alias("worst"))


@query(f"WITH {FRS}, q AS (SELECT pass_id, arg_min(frame, frame) AS frame, arg_min(e, frame) AS e, arg_min(n, frame) AS n FROM fr GROUP BY 1), m AS (SELECT *, pass_id*0.7::DOUBLE AS yaw FROM q) SELECT pass_id, frame, round(sqrt(pow(e-3,2)+pow(n+4,2)),3) AS lever, round(sqrt(pow(cos(radians(yaw))*(e-3)-sin(radians(yaw))*(n+4)+3+0.1-e,2)+pow(sin(radians(yaw))*(e-3)+cos(radians(yaw))*(n+4)-4-n,2)),3)+0.0 AS shift FROM m")
def lever_arms(spark, d):
    """How far a small turn about a far centre moves the first camera of each pass."""
    first = frames(spark, d).groupBy("pass_id").agg(F.min(F.struct("frame", "e", "n")).alias("m")).select("pass_id", "m.*")
    moves = first.select("pass_id", F.lit(0.1).alias("dx"), F.lit(0.0).alias("dy"), F.lit(0.0).alias("dz"), (F.col("pass_id") * 0.7).alias("dyaw"), F.lit(3.0).alias("cx"), F.lit(-4.0).alias("cy"))
    flat = first.withColumns({k: F.lit(0.0) for k in ("h", "yaw", "roll", "pitch")})
    after = T.transformed(flat, moves).select("frame", F.col("e").alias("e1"), F.col("n").alias("n1"))
    met = first.join(after, "frame")
    return met.select("pass_id", "frame", F.round(F.hypot(F.col("e") - 3.0, F.col("n") + 4.0), 3).alias("lever"), r(F.hypot(F.col("e1") - F.col("e"), F.col("n1") - F.col("n")), 3).alias("shift"))


@query(f"{SEG}, c AS (SELECT frame, user_id, t+12.5 AS tq FROM ep WHERE frame%7=0), {AT}, yy AS (SELECT frame, a[1]+coalesce(b[1]-a[1],0)*k AS e, a[3]+coalesce(b[3]-a[3],0)*k AS roll, a[4]+coalesce(b[4]-a[4],0)*k AS pitch, {TURNED}-180.0+1.5 AS yaw FROM ww), gg AS (SELECT frame, e, cos(radians(yaw)) AS cy, sin(radians(yaw)) AS sy, cos(radians(-roll)) AS cr, sin(radians(-roll)) AS sr, cos(radians(-pitch)) AS cp, sin(radians(-pitch)) AS sp FROM yy) SELECT frame, round(e,3)+0.0 AS e, round(cp*cy-sp*sr*sy,5)+0.0 AS m00, round(-cr*sy,5)+0.0 AS m10, round(cp*cr,5)+0.0 AS m22 FROM gg")
def initial_poses(spark, d):
    """Rotation and place from which a refinement starts: the pose at an offset in time, turned by a first guess."""
    p = _poses(spark, d)
    later = p.where("frame % 7 = 0").select("frame", "user_id", (F.col("t") + 12.5).alias("t"))
    at = O.interpolated(later, p, "user_id", "t", ["e", "n", "roll", "pitch"], ["yaw"], 86_400.0)
    m = Q.vehicle(F.col("yaw") + 1.5, F.col("roll"), F.col("pitch"))
    return at.select("frame", as_sql("e", 3).alias("e"), as_sql(m[0][0], 5).alias("m00"), as_sql(m[1][0], 5).alias("m10"), as_sql(m[2][2], 5).alias("m22"))


@query(f"WITH {FRS}, a AS (SELECT frame, 'dt' AS kind, pass_id, t+k*0.1::DOUBLE AS time FROM fr, range(-5,6) u(k) UNION ALL SELECT f.frame, 'xpass', g.pass_id, g.t+k*0.5::DOUBLE FROM fr f JOIN fr g ON g.pass_id<>f.pass_id AND sqrt(pow(f.e-g.e,2)+pow(f.n-g.n,2)) <= 12, range(-4,5) u(k)) SELECT frame, kind, count(*) AS n, round(min(time),3) AS first, round(max(time),3) AS last FROM a GROUP BY 1,2")
def time_candidates(spark, d):
    """Times at which a frame's pose is tried: offsets on its own pass, and around frames of other passes nearby."""
    from tidemark.operators.joins import range_join

    f = frames(spark, d)
    ticks = lambda lo, hi, step: F.explode(F.transform(F.sequence(F.lit(lo), F.lit(hi)), lambda k: k * step))
    own = f.select("frame", F.lit("dt").alias("kind"), "t", ticks(-5, 5, 0.1).alias("o"))
    other = f.select(F.col("pass_id").alias("p2"), F.col("t").alias("t2"), F.col("e").alias("cx"), F.col("n").alias("cy"))
    near = range_join(f.select("frame", "pass_id", F.col("e").alias("x"), F.col("n").alias("y")), other, 12.0).where("pass_id <> p2")
    cross = near.select("frame", F.lit("xpass").alias("kind"), F.col("t2").alias("t"), ticks(-4, 4, 0.5).alias("o"))
    every = own.union(cross).withColumn("time", F.col("t") + F.col("o"))
    return every.groupBy("frame", "kind").agg(F.count("*").alias("n"), F.round(F.min("time"), 3).alias("first"), F.round(F.max("time"), 3).alias("last"))


# ---- reports and small tables


@query(f"{report_queries.PAIRED} SELECT count(*) AS n, round(quantile_cont(ma,0.5),3) AS before, round(quantile_cont(mb,0.5),3) AS after, count(*) FILTER (mb < ma) AS improved, count(*) FILTER (mb > ma) AS worsened FROM mg")
def colour_comparison(spark, d):
    """Two sources by a difference at each frame: medians, and how many got better and worse."""
    rows = report_queries._classed(spark, d).select(F.hypot("du", "dv").alias("a"), F.hypot(F.col("du") * 0.8 - 0.3, F.when(F.col("frame") % 7 != 0, F.col("dv") * 0.9 + 0.2)).alias("b"))
    return rows.agg(F.count("*").alias("n"), F.round(F.percentile("a", F.lit(0.5)), 3).alias("before"), F.round(F.percentile("b", F.lit(0.5)), 3).alias("after"), F.count_if(F.col("b") < F.col("a")).alias("improved"), F.count_if(F.col("b") > F.col("a")).alias("worsened"))


@query(f"WITH {report_queries.MEAS}, s AS (SELECT pass_id, du, 1.0/greatest(sharpness/10,0.5) AS inv FROM ms WHERE du IS NOT NULL) SELECT pass_id, count(*) AS n, round(regr_intercept(du, inv),3)+0.0 AS c0, round(regr_slope(du, inv),3)+0.0 AS c1, round(quantile_cont(du,0.5),3)+0.0 AS median FROM s GROUP BY 1 HAVING count(*) >= 10 AND var_pop(inv) > 0")
def offset_models(spark, d):
    """Linear model of an offset on the inverse range, by pass."""
    s = report_queries._measured(spark, d).where("du is not null").select("pass_id", "du", (1.0 / F.greatest(F.col("sharpness") / 10, F.lit(0.5))).alias("inv"))
    enough = s.groupBy("pass_id").agg(F.count("*").alias("n"), F.var_pop("inv").alias("v"), F.percentile("du", F.lit(0.5)).alias("median")).where("n >= 10 and v > 0").drop("n", "v")
    f = fits.least_squares(s.join(enough.select("pass_id"), "pass_id"), [F.lit(1.0), F.col("inv")], F.col("du"), ["pass_id"])
    return f.join(enough, "pass_id").select("pass_id", "n", r(F.col("coefficients")[0], 3).alias("c0"), r(F.col("coefficients")[1], 3).alias("c1"), r("median", 3).alias("median"))


@query(f"WITH {PTS}, l AS (SELECT tile, id, ln(1+intensity) AS v FROM pt), q AS (SELECT tile, quantile_cont(v,0.01) AS lo, quantile_cont(v,0.99) AS hi FROM l GROUP BY 1) SELECT id, round(least(greatest((v-lo)/greatest(hi-lo,1e-6),0),1),5)+0.0 AS value FROM l JOIN q USING (tile)")
def stretched_intensity(spark, d):
    """Intensity of each tile between its first and last percentile, in logarithms."""
    l_ = scan_points(spark, d).select("tile", "id", F.log1p("intensity").alias("v"))
    q = l_.groupBy("tile").agg(F.percentile("v", F.array(F.lit(0.01), F.lit(0.99))).alias("q"))
    span = F.greatest(F.col("q")[1] - F.col("q")[0], F.lit(1e-6))
    return l_.join(q, "tile").select("id", r(F.least(F.greatest((F.col("v") - F.col("q")[0]) / span, F.lit(0.0)), F.lit(1.0)), 5).alias("value"))


@query(f"WITH {PTS} SELECT pass_id, psid, count(*) AS n FROM (SELECT CAST(floor(gps/40) AS BIGINT) AS pass_id, psid, gps FROM pt UNION ALL SELECT CAST(floor(gps/40) AS BIGINT)+1, psid, gps FROM pt WHERE gps-floor(gps/40)*40 >= 37 UNION ALL SELECT CAST(floor(gps/40) AS BIGINT)-1, psid, gps FROM pt WHERE gps-floor(gps/40)*40 <= 3) WHERE pass_id BETWEEN 0 AND (SELECT CAST(floor(max(gps)/40) AS BIGINT) FROM pt) GROUP BY 1,2")
def pass_scan_lines(spark, d):
    """Points of each scan line in the time of each pass and three seconds around it."""
    p = scan_points(spark, d).select("gps", "psid")
    last = p.agg(F.floor(F.max("gps") / 40)).scalar()
    k = F.floor(F.col("gps") / 40)
    into = F.col("gps") - k * 40
    near = F.array_compact(F.array(k, F.when(into >= 37, k + 1), F.when(into <= 3, k - 1)))
    return p.select("psid", F.explode(near).alias("pass_id")).where((F.col("pass_id") >= 0) & (F.col("pass_id") <= last)).groupBy("pass_id", "psid").agg(F.count("*").alias("n"))


@query("WITH v AS (SELECT p_partkey, radians(p_partkey%360+0.0) AS y, radians((p_partkey%90)-45.0) AS p FROM part) SELECT p_partkey, round(-sin(y)*cos(p),5)+0.0 AS fx, round(cos(y)*cos(p),5)+0.0 AS fy, round(sin(p),5)+0.0 AS fz, round(cos(y),5)+0.0 AS sx, round(sin(y),5)+0.0 AS sy, round(sin(y)*sin(p),5)+0.0 AS ux, round(-cos(y)*sin(p),5)+0.0 AS uy, round(cos(p),5)+0.0 AS uz FROM v")
def viewer_axes(spark, d):
    """Forward, side and up axes of a perspective viewer."""
    y, p = F.radians((F.col("p_partkey") % 360).cast("double")), F.radians((F.col("p_partkey") % 90 - 45).cast("double"))
    axes = {"fx": -F.sin(y) * F.cos(p), "fy": F.cos(y) * F.cos(p), "fz": F.sin(p), "sx": F.cos(y), "sy": F.sin(y), "ux": F.sin(y) * F.sin(p), "uy": -F.cos(y) * F.sin(p), "uz": F.cos(p)}
    return table(spark, d, "part").select("p_partkey", *[r(v, 5).alias(k) for k, v in axes.items()])


@query(f"WITH {PTS}, hk AS (SELECT tile, id%7 AS code, x, y FROM pt WHERE id%5=0), df AS (SELECT * FROM hk WHERE code IN (1,2,4)) SELECT tile, count(*) AS points, count(DISTINCT code) AS codes, (SELECT count(*) FROM hk h WHERE h.tile=df.tile AND code IN (0,3)) AS boundary FROM df GROUP BY 1")
def definition_points(spark, d):
    """Definition points of areas and vertices of hard boundaries by tile, chosen by code."""
    h = scan_points(spark, d).where("id % 5 = 0").select("tile", (F.col("id") % 7).alias("code"))
    area, hard = F.col("code").isin(1, 2, 4), F.col("code").isin(0, 3)
    out = h.groupBy("tile").agg(F.count_if(area).alias("points"), F.countDistinct(F.when(area, F.col("code"))).alias("codes"), F.count_if(hard).alias("boundary"))
    return out.where("points > 0")


#: Colours of the classes of points by name.
PALETTE = {"road": (128, 64, 128), "sidewalk": (244, 35, 232), "building": (230, 60, 60), "wall": (102, 102, 156), "fence": (190, 153, 153), "vegetation": (107, 142, 35), "terrain": (152, 251, 152), "water": (0, 130, 180), "guard_rail": (180, 165, 180), "stairs": (150, 100, 100)}


@query(f"WITH {PTS}, pal AS (SELECT * FROM (VALUES {', '.join(f'({k},{r_},{g},{b})' for k, (r_, g, b) in enumerate(PALETTE.values()) if k < 8)}) t(cls, red, green, blue)) SELECT id, coalesce(red,0) AS red, coalesce(green,0) AS green, coalesce(blue,0) AS blue FROM pt LEFT JOIN pal USING (cls)")
def class_colours(spark, d):
    """Colour of each point's class; classes without one are black."""
    pal = spark.createDataFrame([(k, *c) for k, c in enumerate(PALETTE.values()) if k < 8], "cls int, red int, green int, blue int")
    return scan_points(spark, d).select("id", "cls").join(F.broadcast(pal), "cls", "left").select("id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("red", "green", "blue")])
