"""Queries on pose tables, frame groups and view geometry, with oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import rotations as Q
from tidemark.functions import scalars as S
from tidemark.operators import ordered as O  # noqa: E741
from tidemark.operators import posetables as P
from tidemark.operators import sampling
from tidemark.plans.registry import EV, FRS, W, query, r
from tidemark.sources.tables import frames, timed_events

#: Events as a pose table: a user's events are a pass.
EP = f"{EV}, ep AS (SELECT event_id AS frame, user_id, event_id, t, value AS e, (event_id*17%500)/10.0::DOUBLE AS n, (event_id%40)*0.5::DOUBLE AS h, 3*value+180.0-360.0*floor((3*value+180.0)/360.0)-180.0 AS yaw, (event_id%21)-10.0::DOUBLE AS roll, (event_id%11)-5.0::DOUBLE AS pitch, user_id AS pass_id FROM e)"


def _poses(spark, d):
    i = F.col("event_id")
    return timed_events(spark, d).select(
        i.alias("frame"), "user_id", "event_id", "t", F.col("value").alias("e"), (i * 17 % 500 / 10.0).alias("n"), (i % 40 * 0.5).alias("h"), O.wrapped(3 * F.col("value")).alias("yaw"),
        (i % 21 - 10).cast("double").alias("roll"), (i % 11 - 5).cast("double").alias("pitch"), F.col("user_id").alias("pass_id"),
    )


@query(f"WITH {EP}, f AS (SELECT frame, CASE WHEN t-lag(t) {W} > 7200 OR sqrt(pow(e-lag(e) {W},2)+pow(n-lag(n) {W},2)) > 300 THEN 1 ELSE 0 END AS new, user_id, t, event_id FROM ep) SELECT frame, CAST(sum(new) {W} AS BIGINT) AS session FROM f")
def planar_sessions(spark, d):
    return P.planar_sessions(_poses(spark, d), "user_id", ["t", "event_id"], "t", "e", "n", 7200.0, 300.0).select("frame", "session")


def _grad(c: str) -> str:
    return f"CASE WHEN a IS NULL AND b IS NULL THEN 0.0 WHEN a IS NULL THEN {c}1/nullif(b,0) WHEN b IS NULL THEN {c}0/nullif(a,0) ELSE ({c}0/nullif(a,0)*b+{c}1/nullif(b,0)*a)/nullif(a+b,0) END"


@query(f"WITH {EP}, f AS (SELECT frame, t-lag(t) {W} AS a, lead(t) {W}-t AS b, e-lag(e) {W} AS e0, lead(e) {W}-e AS e1, n-lag(n) {W} AS n0, lead(n) {W}-n AS n1 FROM ep) SELECT frame, round(sqrt(pow({_grad('e')},2)+pow({_grad('n')},2)),4)+0.0 AS speed FROM f")
def planar_speed(spark, d):
    return P.planar_speed(_poses(spark, d), "user_id", ["t", "event_id"], "t", "e", "n").select("frame", r("speed").alias("speed"))


SEG = f"""WITH {EP}, fr AS (SELECT user_id, t, min((e,n,roll,pitch,yaw)) AS q FROM ep GROUP BY 1,2), s AS (SELECT user_id, t AS t0, q AS a, lead(t) OVER w AS t1, lead(q) OVER w AS b, lag(t) OVER w AS p FROM fr WINDOW w AS (PARTITION BY user_id ORDER BY t)), g AS (SELECT * FROM s WHERE t1 IS NOT NULL OR p IS NULL),
f1 AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY t0)=1)"""
AT = """bk AS (SELECT c.frame, c.user_id, c.tq, g.t0, g.a, g.t1, g.b FROM c ASOF LEFT JOIN g ON c.user_id=g.user_id AND c.tq >= g.t0), mm AS (SELECT bk.frame, bk.tq, coalesce(bk.t0,f1.t0) AS t0, CASE WHEN bk.t0 IS NULL THEN f1.a ELSE bk.a END AS a, CASE WHEN bk.t0 IS NULL THEN f1.t1 ELSE bk.t1 END AS t1, CASE WHEN bk.t0 IS NULL THEN f1.b ELSE bk.b END AS b FROM bk LEFT JOIN f1 USING (user_id)),
ww AS (SELECT *, CASE WHEN t1 IS NULL THEN 0.0 ELSE (tq-t0)/(t1-t0) END AS k FROM mm)"""
TURNED = "a[5]+(coalesce(b[5]-a[5],0)+180.0-360.0*floor((coalesce(b[5]-a[5],0)+180.0)/360.0)-180.0)*k+180.0"


@query(f"{SEG}, c AS (SELECT frame, user_id, t+90.0 AS tq FROM ep), {AT} SELECT frame, round(a[1]+coalesce(b[1]-a[1],0)*k,3)+0.0 AS e, round(a[2]+coalesce(b[2]-a[2],0)*k,3)+0.0 AS n, round(a[3]+coalesce(b[3]-a[3],0)*k,3)+0.0 AS roll, round(a[4]+coalesce(b[4]-a[4],0)*k,3)+0.0 AS pitch, round({TURNED}-360.0*floor(({TURNED})/360.0)-180.0,3)+0.0 AS yaw FROM ww")
def pose_offset(spark, d):
    """Pose of every frame 90 seconds later on its own pass, past the end along the last segment."""
    p = _poses(spark, d)
    later = p.select("frame", "user_id", (F.col("t") + 90.0).alias("t"))
    at = O.interpolated(later, p, "user_id", "t", ["e", "n", "roll", "pitch"], ["yaw"], 86_400.0)
    return at.select("frame", *[r(c, 3).alias(c) for c in ("e", "n", "roll", "pitch", "yaw")])


@query(f"""WITH {EP}, fr AS (SELECT user_id, t, min(yaw) AS yaw FROM ep GROUP BY 1,2), qq AS (SELECT user_id, t, sin(radians(yaw)/2) AS z, cos(radians(yaw)/2) AS w FROM fr), c AS (SELECT frame, user_id, t+45.0 AS tq FROM ep), b AS (SELECT c.*, q.t AS t0, q.z AS z0, q.w AS w0 FROM c ASOF LEFT JOIN qq q ON c.user_id=q.user_id AND c.tq >= q.t), a AS (SELECT b.*, q.t AS t1, q.z AS z1, q.w AS w1 FROM b ASOF LEFT JOIN qq q ON b.user_id=q.user_id AND b.tq <= q.t),
k AS (SELECT frame, CASE WHEN t1 IS NULL OR t1=t0 THEN 0.0 ELSE (tq-t0)/(t1-t0) END AS k, z0, coalesce(z1,z0) AS z1, w0, coalesce(w1,w0) AS w1 FROM a), m AS (SELECT frame, z0+(z1-z0)*k AS z, w0+(w1-w0)*k AS w FROM k), y AS (SELECT frame, 2*degrees(atan2(z,w))+180.0 AS y FROM m) SELECT frame, round(y-360.0*floor(y/360.0)-180.0,3)+0.0 AS yaw FROM y""")
def camera_orientation(spark, d):
    """Heading 45 seconds later from quaternions that are interpolated by component, held past the end."""
    p = _poses(spark, d)
    q = p.groupBy("user_id", "t").agg(F.min("yaw").alias("yaw")).select("user_id", "t", F.struct((F.sin(F.radians("yaw") / 2)).alias("z"), (F.cos(F.radians("yaw") / 2)).alias("w")).alias("id"))
    near = O.around(p.select("frame", "user_id", (F.col("t") + 45.0).alias("t")), q, "user_id", "t", 86_400.0)
    last = F.coalesce("after", "before")
    k = F.coalesce(F.try_divide(F.col("t") - F.col("before.t"), last["t"] - F.col("before.t")), F.lit(0.0))
    k = F.when(F.col("after").isNull(), 0.0).otherwise(k)
    mix = lambda c: F.col(f"before.id.{c}") + (last["id"][c] - F.col(f"before.id.{c}")) * k
    return near.select("frame", r(O.wrapped(2 * F.degrees(F.atan2(mix("z"), mix("w")))), 3).alias("yaw"))


TR = "tr AS (SELECT DISTINCT user_id AS pass_id, (user_id%5)*0.1::DOUBLE AS dx, (user_id%3)*-0.2::DOUBLE AS dy, 0.05::DOUBLE AS dz, (user_id%7)*0.4::DOUBLE AS dyaw, CASE WHEN user_id%2=0 THEN 10.0::DOUBLE END AS cx, CASE WHEN user_id%2=0 THEN -20.0::DOUBLE END AS cy FROM e WHERE user_id%4<>3)"


def _transforms(spark, d):
    u = F.col("user_id")
    centre = lambda v: F.when(u % 2 == 0, F.lit(v))
    return timed_events(spark, d).select("user_id").distinct().where(u % 4 != 3).select(
        u.alias("pass_id"), (u % 5 * 0.1).alias("dx"), (u % 3 * -0.2).alias("dy"), F.lit(0.05).alias("dz"), (u % 7 * 0.4).alias("dyaw"), centre(10.0).alias("cx"), centre(-20.0).alias("cy")
    )


@query(f"WITH {EP}, {TR}, mc AS (SELECT pass_id, avg(e) AS me, avg(n) AS mn FROM ep GROUP BY 1), j AS (SELECT ep.*, dx, dy, dz, dyaw, coalesce(cx,me) AS cx, coalesce(cy,mn) AS cy FROM ep JOIN mc USING (pass_id) LEFT JOIN tr USING (pass_id)) SELECT frame, round(coalesce(cos(radians(dyaw))*(e-cx)-sin(radians(dyaw))*(n-cy)+cx+dx,e),3)+0.0 AS e, round(coalesce(sin(radians(dyaw))*(e-cx)+cos(radians(dyaw))*(n-cy)+cy+dy,n),3)+0.0 AS n, round(coalesce(h+dz,h),3)+0.0 AS h, round(yaw+coalesce(dyaw,0)+180-360*floor((yaw+coalesce(dyaw,0)+180)/360)-180,3)+0.0 AS yaw, round(roll,3)+0.0 AS roll, round(pitch,3)+0.0 AS pitch FROM j")
def transformed_poses(spark, d):
    """Pose table under its pass transforms: the place turns and shifts, the heading turns, roll and pitch stay."""
    out = P.transformed(_poses(spark, d), _transforms(spark, d))
    return out.select("frame", *[r(c, 3).alias(c) for c in ("e", "n", "h", "yaw", "roll", "pitch")])


@query(f"WITH {EP}, {TR} SELECT frame, dx AS reg_de, dy AS reg_dn, dz AS reg_dh, dyaw AS reg_dyaw FROM ep LEFT JOIN tr USING (pass_id)")
def pass_deltas(spark, d):
    t = _transforms(spark, d).select("pass_id", F.col("dx").alias("reg_de"), F.col("dy").alias("reg_dn"), F.col("dz").alias("reg_dh"), F.col("dyaw").alias("reg_dyaw"))
    return _poses(spark, d).join(F.broadcast(t), "pass_id", "left").select("frame", "reg_de", "reg_dn", "reg_dh", "reg_dyaw")


@query(f"WITH {EP}, {TR} SELECT pass_id FROM tr WHERE sqrt(dx*dx+dy*dy+dz*dz) > 0.3")
def far_passes(spark, d):
    return _transforms(spark, d).where(F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy") + F.col("dz") * F.col("dz")) > 0.3).select("pass_id")


OV = "rf AS (SELECT frame, CASE WHEN frame%3=0 THEN 'refined' ELSE 'kept' END AS status, e+0.3 AS e2, n-0.4 AS n2, yaw+1.5 AS yaw2, CASE WHEN frame%9=0 THEN pass_id+1 ELSE pass_id END AS pass2 FROM ep)"


def _overlaid(spark, d):
    base = _poses(spark, d).withColumn("filename", F.concat(F.lit("f"), F.col("frame").cast("string")))
    fine = base.withColumns({"status": F.when(F.col("frame") % 3 == 0, "refined").otherwise("kept"), "e": F.col("e") + 0.3, "n": F.col("n") - 0.4, "yaw": F.col("yaw") + 1.5, "pass_id": F.when(F.col("frame") % 9 == 0, F.col("pass_id") + 1).otherwise(F.col("pass_id"))})
    return P.overlaid(base, fine, "frame", ["e", "n", "h", "roll", "pitch", "yaw"])


@query(f"WITH {EP}, {OV} SELECT frame, round(CASE WHEN status='refined' THEN e2 ELSE e END,4)+0.0 AS e, round(CASE WHEN status='refined' THEN n2 ELSE n END,4)+0.0 AS n, round(CASE WHEN status='refined' THEN yaw2 ELSE yaw END,4)+0.0 AS yaw, CASE WHEN status='refined' THEN pass2 ELSE pass_id END AS pass_id, status='refined' AS refined, status='refined' AND pass2<>pass_id AS pass_changed FROM ep JOIN rf USING (frame)")
def overlaid_poses(spark, d):
    return _overlaid(spark, d).select("frame", *[r(c).alias(c) for c in ("e", "n", "yaw")], "pass_id", "refined", "pass_changed")


@query(f"WITH {EP}, {OV} SELECT CASE WHEN status='refined' THEN 'base+refined+reg' ELSE 'base+reg' END AS status, count(*) AS n, count(*) FILTER (status='refined' AND pass2<>pass_id) AS pass_changed, round(quantile_cont(CASE WHEN status='refined' THEN 0.5 END,0.5),3) AS moved_median, round(quantile_cont(CASE WHEN status='refined' THEN 1.5 END,0.95),3) AS turned_p95 FROM ep JOIN rf USING (frame) GROUP BY 1")
def assembled_status(spark, d):
    """Status of assembled frames with what the overlay moved."""
    o = _overlaid(spark, d).withColumn("status", F.when(F.col("refined"), "base+refined+reg").otherwise("base+reg"))
    share = lambda c, p: F.round(F.percentile(c, F.lit(p)), 3)
    return o.groupBy("status").agg(F.count("*").alias("n"), F.count_if("pass_changed").alias("pass_changed"), share("moved", 0.5).alias("moved_median"), share("turned", 0.95).alias("turned_p95"))


RATE = f"""WITH {EP}, {TR}, f AS (SELECT frame, pass_id, user_id, t, event_id, yaw, coalesce(lag(yaw) {W}, yaw) AS y0, coalesce(lead(yaw) {W}, yaw) AS y1, coalesce(lag(t) {W}, t) AS t0, coalesce(lead(t) {W}, t) AS t1 FROM ep), g AS (SELECT *, 1000*abs((y1-y0+180.0-360.0*floor((y1-y0+180.0)/360.0)-180.0)/nullif(t1-t0,0)) AS rate, frame%4<>0 AS clean FROM f)"""


def _rated(spark, d):
    p = O.angle_rate(_poses(spark, d), "user_id", ["t", "event_id"], "t", "yaw").withColumn("rate", 1000 * F.col("rate"))
    far = far_passes(spark, d).withColumn("far", F.lit(True))
    return p.join(F.broadcast(far), "pass_id", "left").select("frame", "t", "pass_id", "yaw", "rate", (F.col("frame") % 4 != 0).alias("clean"), (F.col("frame") % 11 == 0).alias("refined"), F.coalesce("far", F.lit(False)).alias("far"))


@query(f"""{RATE}, pl AS (SELECT frame, row_number() OVER (ORDER BY frame)-1 AS rk, count(*) OVER () AS n FROM g WHERE clean AND coalesce(rate,0) < 5), ks AS (SELECT DISTINCT CAST(round_even(k*(n-1)/11.0::DOUBLE,0) AS BIGINT) AS rk FROM (SELECT DISTINCT n FROM pl), range(12) t(k)) SELECT 'turning' AS "group", frame FROM g WHERE coalesce(rate,0) > 8 UNION ALL SELECT 'straight', frame FROM pl WHERE n <= 12 OR rk IN (SELECT rk FROM ks) UNION ALL SELECT 'refined_or_far', frame FROM g WHERE frame%11=0 OR pass_id IN (SELECT pass_id FROM tr WHERE sqrt(dx*dx+dy*dy+dz*dz) > 0.3)""")
def frame_groups(spark, d):
    return P.frame_groups(_rated(spark, d), 12)


@query(f"""{RATE}, pl AS (SELECT frame, row_number() OVER (ORDER BY frame)-1 AS rk, count(*) OVER () AS n FROM g WHERE clean), ks AS (SELECT DISTINCT CAST(round_even(k*(n-1)/19.0::DOUBLE,0) AS BIGINT) AS rk FROM (SELECT DISTINCT n FROM pl), range(20) t(k)), tu AS (SELECT frame FROM g WHERE coalesce(rate,0) > 8) SELECT frame, 'turning' AS kind FROM tu UNION ALL SELECT frame, 'straight' FROM pl WHERE (n <= 20 OR rk IN (SELECT rk FROM ks)) AND frame NOT IN (SELECT frame FROM tu)""")
def frame_list(spark, d):
    """Turning frames, and evenly spread clean ones that don't turn."""
    rated = _rated(spark, d)
    turning = rated.where(F.coalesce("rate", F.lit(0.0)) > P.TURNING).select("frame")
    even = P.evenly_by_rank(rated.where("clean").select("frame"), ["frame"], 20)
    return turning.withColumn("kind", F.lit("turning")).union(even.join(turning, "frame", "left_anti").withColumn("kind", F.lit("straight")))


@query(f"{RATE}, s AS (SELECT frame, row_number() OVER (ORDER BY frame)-1 AS rk FROM ep WHERE e BETWEEN 50 AND 400 AND n BETWEEN 5 AND 45) SELECT frame FROM s WHERE rk%7=0")
def strided_frames(spark, d):
    """Distinct frames of a box, every seventh."""
    inside = _poses(spark, d).where(F.col("e").between(50, 400) & F.col("n").between(5, 45)).select("frame").distinct()
    return sampling.every_kth(inside, ["frame"], 7)


@query(f"{RATE}, x AS (SELECT frame, yaw, lag(yaw) {W} AS a, lead(yaw) {W} AS b, lag(t) {W} AS ta, lead(t) {W} AS tb, t, clean FROM g), y AS (SELECT clean, yaw, a+(b-a+180-360*floor((b-a+180)/360)-180)*((t-ta)/nullif(tb-ta,0)) AS old, a+(b-a+180-360*floor((b-a+180)/360)-180)*0.5 AS mid FROM x WHERE a IS NOT NULL AND b IS NOT NULL), z AS (SELECT clean, abs(old-yaw+180-360*floor((old-yaw+180)/360)-180) AS ro, abs(mid-yaw+180-360*floor((mid-yaw+180)/360)-180) AS rm FROM y) SELECT clean, count(*) AS n, round(quantile_cont(ro,0.5),3) AS old_median, round(quantile_cont(ro,0.95),3) AS old_p95, round(quantile_cont(rm,0.5),3) AS mid_median, round(quantile_cont(rm,0.95),3) AS mid_p95 FROM z GROUP BY 1")
def interpolation_benefit(spark, d):
    """How far two predictions of a heading are off: along the neighbours' line by time, and halfway between them."""
    w = Window.partitionBy("user_id").orderBy("t", "event_id")
    p = _poses(spark, d).withColumn("clean", F.col("frame") % 4 != 0)
    a, b, ta, tb = F.lag("yaw").over(w), F.lead("yaw").over(w), F.lag("t").over(w), F.lead("t").over(w)
    x = p.select("clean", "yaw", "t", a.alias("a"), b.alias("b"), ta.alias("ta"), tb.alias("tb")).where("a is not null and b is not null")
    turn = O.wrapped(F.col("b") - F.col("a"))
    off = lambda k: S.circular(F.col("a") + turn * k, F.col("yaw"))
    z = x.select("clean", off(F.try_divide(F.col("t") - F.col("ta"), F.col("tb") - F.col("ta"))).alias("old"), off(F.lit(0.5)).alias("mid"))
    share = lambda c, q: F.round(F.percentile(c, F.lit(q)), 3)
    return z.groupBy("clean").agg(F.count("*").alias("n"), *[share(c, q).alias(f"{c}_{k}") for c in ("old", "mid") for q, k in ((0.5, "median"), (0.95, "p95"))])


@query(f"WITH {EP}, al AS (SELECT frame, 0.5::DOUBLE AS score0, 0.5-(frame%5)*0.004::DOUBLE AS score, pass_id+(frame%2) AS src_pass, t-1.25 AS src_time, 0.1::DOUBLE AS dt, 2.0::DOUBLE AS dyaw FROM ep WHERE frame%3<>0), j AS (SELECT ep.frame, t, pass_id, al.*, coalesce(score0-score >= 0.01, false) AS gain FROM ep LEFT JOIN al USING (frame)) SELECT frame, round(CASE WHEN gain AND src_pass<>pass_id THEN src_time ELSE t END,3) AS t_base, CASE WHEN gain THEN src_pass ELSE pass_id END AS pass_target, CASE WHEN gain AND src_pass=pass_id THEN dt ELSE 0.0 END AS dt0, CASE WHEN gain THEN dyaw ELSE 0.0 END AS dyaw0, gain AND src_pass<>pass_id AS reassigned FROM j")
def planned_frames(spark, d):
    p, i = _poses(spark, d), F.col("frame")
    a = p.where(i % 3 != 0).select("frame", F.lit(0.5).alias("score0"), (0.5 - i % 5 * 0.004).alias("score"), (F.col("pass_id") + i % 2).alias("src_pass"), (F.col("t") - 1.25).alias("src_time"), F.lit(0.1).alias("dt"), F.lit(2.0).alias("dyaw"))
    return P.planned(p, a).withColumn("t_base", F.round("t_base", 3))


@query(f"{RATE} SELECT frame, CASE WHEN coalesce(rate,0)>8 THEN 0.3::DOUBLE ELSE 0.05::DOUBLE END AS dt, CASE WHEN coalesce(rate,0)>8 THEN 2.0::DOUBLE ELSE 0.5::DOUBLE END AS dyaw, 0.3::DOUBLE AS droll FROM g")
def prior_widths(spark, d):
    turning = F.coalesce("rate", F.lit(0.0)) > P.TURNING
    return _rated(spark, d).select("frame", *[P.prior_width(c, turning).alias(c) for c in ("dt", "dyaw", "droll")])


@query(f"WITH {EP} SELECT frame, pass_id, row_number() OVER (PARTITION BY pass_id ORDER BY t, frame) - 1 AS place, count(*) OVER (PARTITION BY pass_id) AS n FROM ep")
def pass_order(spark, d):
    w = Window.partitionBy("pass_id")
    return _poses(spark, d).select("frame", "pass_id", (F.row_number().over(w.orderBy("t", "frame")) - 1).cast("long").alias("place"), F.count("*").over(w).alias("n"))


@query(f"WITH {EP}, sg AS (SELECT user_id, min(t)+3600.0 AS t0, min(t)+864000.0 AS t1 FROM ep GROUP BY 1 UNION ALL SELECT user_id, max(t)-432000.0, max(t)-7200.0 FROM ep GROUP BY 1) SELECT frame, EXISTS (SELECT 1 FROM sg WHERE sg.user_id=ep.user_id AND t+120.0 >= t0 AND t+120.0 <= t1) AS covered FROM ep")
def covered_frames(spark, d):
    """Whether a frame's time, moved by the rig's offset, lies in a covered stretch of its own pass."""
    p = _poses(spark, d)
    ends = p.groupBy("user_id").agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    runs = ends.select("user_id", F.array(F.struct((F.col("lo") + 3600.0).alias("t0"), (F.col("lo") + 864000.0).alias("t1")), F.struct((F.col("hi") - 432000.0).alias("t0"), (F.col("hi") - 7200.0).alias("t1"))).alias("runs"))
    inside = F.exists("runs", lambda s: (F.col("t") + 120.0 >= s["t0"]) & (F.col("t") + 120.0 <= s["t1"]))
    return p.join(runs, "user_id").select("frame", inside.alias("covered"))


# ---- viewer and views

MAT = f"WITH {FRS}, fq AS (SELECT *, cos(radians(yaw)) AS cy, sin(radians(yaw)) AS sy, cos(radians(-roll)) AS cr, sin(radians(-roll)) AS sr, cos(radians(-pitch)) AS cp, sin(radians(-pitch)) AS sp FROM fr), mt AS (SELECT *, cp*cy-sp*sr*sy AS m00, cp*sy+sp*sr*cy AS m01, sp*cr AS m02, -cr*sy AS m10, cr*cy AS m11, -sr AS m12, -sp*cy-cp*sr*sy AS m20, -sp*sy+cp*sr*cy AS m21, cp*cr AS m22 FROM fq)"
ANGLES = "va AS (SELECT *, 90.0-degrees(atan2(m01,m00)) AS co, -degrees(asin(least(greatest(-m02,-1.0),1.0))) AS vp, degrees(atan2(m22,-m12))-90.0 AS vr FROM mt)"


def _matrix():
    return Q.vehicle(F.col("yaw"), F.col("roll"), F.col("pitch"))


@query(f"{MAT}, {ANGLES} SELECT frame, round(co+180-360*floor((co+180)/360)-180,4)+0.0 AS course, round(vp,4)+0.0 AS pitch, round(vr,4)+0.0 AS roll FROM va")
def viewer_angles(spark, d):
    found = P.viewer_angles(_matrix())
    return frames(spark, d).select("frame", *[r(v).alias(k) for k, v in found.items()])


@query(f"{MAT}, {ANGLES} SELECT frame, count(*) AS lines, any_value(length(regexp_replace(printf('f%d.jpg\t%.6f\t%.4f\t%.4f\t%.4f', frame, t, e, n, h), '[^\t]', '', 'g'))) + 3 AS tabs, any_value(printf('f%d.jpg\t%.6f\t%.4f\t%.4f\t%.4f', frame, t, e, n, h)) AS head FROM va GROUP BY 1")
def coordinate_lines(spark, d):
    """Lines of the viewer's coordinate file; compared up to the place, the angles are compared as numbers elsewhere."""
    line = P.coordinate_line(F.concat(F.lit("f"), F.col("frame").cast("string"), F.lit(".jpg")), F.col("t"), [F.col("e"), F.col("n"), F.col("h")], P.viewer_angles(_matrix()))
    f = frames(spark, d).select("frame", line.alias("line"))
    return f.groupBy("frame").agg(F.count("*").alias("lines"), F.max(F.size(F.split("line", "\t")) - 1).cast("long").alias("tabs"), F.max(F.substring_index("line", "\t", 5)).alias("head"))


VIEWS = "vw AS (SELECT id AS vid, (id*45)%360+0.0::DOUBLE AS vy, ((id%3)-1)*45.0::DOUBLE AS vp FROM pt WHERE id < 12), va AS (SELECT *, cos(radians(vy)) AS vcy, sin(radians(vy)) AS vsy, cos(radians(vp)) AS vcp, sin(radians(vp)) AS vsp FROM vw)"


def _views(spark):
    i = F.col("id")
    return spark.range(12).select(i.alias("vid"), (i * 45 % 360).cast("double").alias("vy"), ((i % 3 - 1) * 45).cast("double").alias("vp"))


@query(f"{MAT}, {VIEWS} SELECT vid, 'y' || right('00' || CAST(vy AS INT), 3) || '_p' || CASE WHEN vp < 0 THEN '-' ELSE '+' END || right('0' || CAST(abs(vp) AS INT), 2) AS name, round(vsy,5)+0.0 AS r0, round(-vcy,5)+0.0 AS r1, round(-vcy*vsp,5)+0.0 AS u0, round(-vsy*vsp,5)+0.0 AS u1, round(vcp,5)+0.0 AS u2, round(vcy*vcp,5)+0.0 AS f0, round(vsy*vcp,5)+0.0 AS f1, round(vsp,5)+0.0 AS f2 FROM va")
def view_axes(spark, d):
    m = P.view_axes(F.col("vy"), F.col("vp"))
    return _views(spark).select("vid", P.view_name(F.col("vy"), F.col("vp")).alias("name"), *[r(m[a][b], 5).alias(n) for n, a, b in (("r0", 0, 0), ("r1", 0, 1), ("u0", 1, 0), ("u1", 1, 1), ("u2", 1, 2), ("f0", 2, 0), ("f1", 2, 1), ("f2", 2, 2))])


LEVEL = "cos(radians(yaw)) AS lc, sin(radians(yaw)) AS ls"
PIX = "gx AS (SELECT a AS i, b AS j, (b+0.5)/16-0.5 AS x, -((a+0.5)/16-0.5) AS y FROM range(16) t(a), range(16) s(b)), ry AS (SELECT i, j, x/sqrt(x*x+y*y+0.25) AS x, y/sqrt(x*x+y*y+0.25) AS y, 0.5/sqrt(x*x+y*y+0.25) AS z FROM gx)"


@query(f"{MAT}, {VIEWS}, {PIX}, bd AS (SELECT frame, vid, i, j, vsy*x-vcy*vsp*y+vcy*vcp*z AS bx, -vcy*x-vsy*vsp*y+vsy*vcp*z AS by_, vcp*y+vsp*z AS bz, mt.*, {LEVEL} FROM ry, va, mt WHERE vid%4=0 AND frame%5=0), wd AS (SELECT *, lc*bx-ls*by_ AS wx, ls*bx+lc*by_ AS wy FROM bd), cd AS (SELECT frame, vid, i, j, m00*wx+m01*wy+m02*bz AS cx, m10*wx+m11*wy+m12*bz AS cy2, m20*wx+m21*wy+m22*bz AS cz FROM wd), an AS (SELECT *, 180.0-degrees(atan2(cy2,cx)) AS q FROM cd) SELECT frame, vid, i, j, round((q-360.0*floor(q/360.0))/360.0*8000,2)+0.0 AS u, round((90.0-degrees(atan2(cz,sqrt(cx*cx+cy2*cy2))))/180.0*4000,2)+0.0 AS v FROM an")
def view_to_panorama(spark, d):
    """Panorama place that each pixel of some views of a levelled camera samples."""
    rays = spark.range(16 * 16).select(F.floor(F.col("id") / 16).alias("i"), (F.col("id") % 16).alias("j"))
    ray = P.view_ray(F.col("i"), F.col("j"), 16, 90.0)
    rays = rays.select("i", "j", *[c.alias(k) for k, c in zip(("rx", "ry", "rz"), ray)])
    both = frames(spark, d).where("frame % 5 = 0").join(F.broadcast(_views(spark).where("vid % 4 = 0"))).join(F.broadcast(rays))
    body = Q.applied(Q.transposed(P.view_axes(F.col("vy"), F.col("vp"))), [F.col("rx"), F.col("ry"), F.col("rz")])
    both = both.withColumns(dict(zip(("bx", "by", "bz"), body)))
    level = Q.vehicle(F.col("yaw"), F.lit(0.0), F.lit(0.0))
    both = both.withColumns(dict(zip(("wx", "wy", "wz"), Q.applied(Q.transposed(level), [F.col("bx"), F.col("by"), F.col("bz")]))))
    both = both.withColumns(dict(zip(("cx", "cy", "cz"), Q.applied(_matrix(), [F.col("wx"), F.col("wy"), F.col("wz")]))))
    at = S.panorama(F.col("cx"), F.col("cy"), F.col("cz"))
    return both.select("frame", "vid", "i", "j", r(at["u"], 2).alias("u"), r(at["v"], 2).alias("v"))


@query(f"{MAT}, {VIEWS}, er AS (SELECT a AS i, b AS j, radians(180.0-(b+0.5)/24*360.0) AS az, radians(90.0-(a+0.5)/12*180.0) AS el FROM range(12) t(a), range(24) s(b)), cr AS (SELECT i, j, cos(el)*cos(az) AS cx, cos(el)*sin(az) AS cy2, sin(el) AS cz FROM er), wd AS (SELECT frame, vid, i, j, m00*cx+m10*cy2+m20*cz AS wx, m01*cx+m11*cy2+m21*cz AS wy, m02*cx+m12*cy2+m22*cz AS wz, va.*, {LEVEL} FROM cr, va, mt WHERE vid%4=0 AND frame%5=0), bd AS (SELECT *, lc*wx+ls*wy AS bx, -ls*wx+lc*wy AS by_ FROM wd), vd AS (SELECT frame, vid, i, j, vsy*bx-vcy*by_ AS d0, -vcy*vsp*bx-vsy*vsp*by_+vcp*wz AS d1, vcy*vcp*bx+vsy*vcp*by_+vsp*wz AS d2 FROM bd), pl AS (SELECT *, d0/d2*0.5 AS x, -d1/d2*0.5 AS y FROM vd WHERE d2 > 1e-6), wt AS (SELECT *, least(greatest(abs(x),abs(y))/0.5,1.0) AS far FROM pl WHERE abs(x) <= 0.5 AND abs(y) <= 0.5) SELECT frame, vid, i, j, round(x,4)+0.0 AS x, round(y,4)+0.0 AS y, round(pow(cos(far*pi()/2),2),4)+0.0 AS weight FROM wt")
def panorama_to_view(spark, d):
    """Place and weight in each view of the panorama cells that it shows; rotations are worked out once a frame and once a view."""
    cells = spark.range(12 * 24).select(F.floor(F.col("id") / 24).alias("i"), (F.col("id") % 24).alias("j"))
    ray = P.panorama_rays(F.col("i"), F.col("j"), 24, 12)
    cells = cells.select("i", "j", *[ray[k].alias("c" + k) for k in "xyz"])
    views = _entries(_views(spark).where("vid % 4 = 0"), P.view_axes(F.col("vy"), F.col("vp")), "v")
    cameras = _entries(frames(spark, d).where("frame % 5 = 0"), _matrix(), "m")
    cameras = _entries(cameras, Q.vehicle(F.col("yaw"), F.lit(0.0), F.lit(0.0)), "l")
    both = cameras.join(F.broadcast(views)).join(F.broadcast(cells))
    for name, before, m in (("w", "c", Q.transposed(_read("m"))), ("b", "w", _read("l")), ("d", "b", _read("v"))):
        both = both.withColumns({name + k: v for k, v in zip("xyz", Q.applied(m, [F.col(before + k) for k in "xyz"]))})
    at = P.view_place([F.col("dx"), F.col("dy"), F.col("dz")], 90.0)
    return both.where(at["inside"]).select("frame", "vid", "i", "j", *[r(at[k]).alias(k) for k in ("x", "y", "weight")])


def _entries(df, m, name):
    return df.withColumns({f"{name}{a}{b}": m[a][b] for a in range(3) for b in range(3)})


def _read(name):
    return [[F.col(f"{name}{a}{b}") for b in range(3)] for a in range(3)]


@query("SELECT event_id, round((CAST(value AS INT)%200-100)*360.0/2000,5)+0.0 AS degrees FROM events")
def shift_degrees(spark, d):
    """Columns of a 2,000 wide panorama as degrees of heading."""
    return timed_events(spark, d).select("event_id", r((F.rint("value").cast("int") % 200 - 100) * 360.0 / 2000, 5).alias("degrees"))
