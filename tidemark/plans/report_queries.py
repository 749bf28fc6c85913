"""Queries of quality reports, evaluations and product checks, with oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators import aggregates as A
from tidemark.operators import reports as R
from tidemark.operators import sampling
from tidemark.plans.registry import PTS, query, r
from tidemark.sources.tables import scan_points, table

# ---- frame quality: orders as measured frames

MEAS = """ms AS (SELECT o_orderkey AS frame, o_custkey%30 AS pass_id, CASE WHEN o_orderkey%13=0 THEN NULL ELSE (o_orderkey*7%41-20)*0.5::DOUBLE END AS du, CASE WHEN o_orderkey%13=0 THEN NULL ELSE (o_orderkey*11%31-15)*0.5::DOUBLE END AS dv, CASE WHEN o_orderkey%13=0 THEN NULL ELSE (o_orderkey%20)*0.6::DOUBLE END AS du_mad, CASE WHEN o_orderkey%13=0 THEN NULL ELSE (o_orderkey%23)*0.5::DOUBLE END AS dv_mad, CASE WHEN o_orderkey%13=0 THEN NULL ELSE (o_orderkey%50)/50.0::DOUBLE END AS inlier,
o_orderkey*37%3000 AS n, o_orderkey*17%1500 AS n_other, CASE WHEN o_orderkey%5=0 THEN NULL ELSE (o_orderkey%43-21)*0.8::DOUBLE END AS du_other, CASE WHEN o_orderkey%5=0 THEN NULL ELSE (o_orderkey%29-14)*0.7::DOUBLE END AS dv_other, (o_orderkey%17)*0.1::DOUBLE AS speed, (o_orderkey%19)*0.5::DOUBLE AS rate, (o_orderkey%97)*2.0::DOUBLE AS sharpness FROM orders)"""
CLASSED = f"""WITH {MEAS}, fl AS (SELECT *, n < 500 AS few, coalesce(n >= 500 AND abs(du)<=8 AND abs(dv)<=8 AND du_mad<=9 AND dv_mad<=9 AND inlier>=0.35, false) AS geo, coalesce(n_other>=500 AND du_other IS NOT NULL AND (abs(du_other)>8 OR abs(dv_other)>8), false) AS conflict, speed>=0.5 AND rate<=5 AS motion, sharpness>=60 AS sharp FROM ms),
cl AS (SELECT *, CASE WHEN geo AND motion AND sharp AND NOT conflict THEN 'clean' WHEN few AND motion AND sharp AND NOT conflict THEN 'unverified' WHEN (geo OR few) AND sharp THEN 'usable' ELSE 'reject' END AS cls FROM fl)"""


def _measured(spark, d):
    k = F.col("o_orderkey")
    miss = lambda c, m: F.when(k % m != 0, c.cast("double"))
    return table(spark, d, "orders").select(
        k.alias("frame"), (F.col("o_custkey") % 30).alias("pass_id"), miss((k * 7 % 41 - 20) * 0.5, 13).alias("du"), miss((k * 11 % 31 - 15) * 0.5, 13).alias("dv"), miss(k % 20 * 0.6, 13).alias("du_mad"), miss(k % 23 * 0.5, 13).alias("dv_mad"),
        miss(k % 50 / 50.0, 13).alias("inlier"), (k * 37 % 3000).alias("n"), (k * 17 % 1500).alias("n_other"), miss((k % 43 - 21) * 0.8, 5).alias("du_other"), miss((k % 29 - 14) * 0.7, 5).alias("dv_other"),
        (k % 17 * 0.1).alias("speed"), (k % 19 * 0.5).alias("rate"), (k % 97 * 2.0).alias("sharpness"),
    )


def _classed(spark, d):
    return _measured(spark, d).withColumns(R.frame_class())


@query(f"{CLASSED} SELECT frame, geo AS geometry_ok, conflict AS pass_conflict, motion AS motion_ok, sharp AS sharp_ok, cls, concat_ws('+', CASE WHEN few THEN 'few_edges' WHEN NOT geo THEN 'geometry' END, CASE WHEN conflict THEN 'pass_conflict' END, CASE WHEN speed<0.5 THEN 'slow' END, CASE WHEN rate>5 THEN 'turning' END, CASE WHEN NOT sharp THEN 'blur' END) AS reasons FROM cl")
def frame_quality(spark, d):
    return _classed(spark, d).select("frame", "geometry_ok", "pass_conflict", "motion_ok", "sharp_ok", "cls", "reasons")


@query(f"{CLASSED} SELECT cls, count(*) AS n, min(frame) AS first, max(frame) AS last, CAST(sum(frame) AS BIGINT) AS frames FROM cl GROUP BY 1")
def class_lists(spark, d):
    """Frames of each class; the list itself, ascending, is summed up by its ends and sum."""
    lists = _classed(spark, d).groupBy("cls").agg(F.array_sort(F.collect_list("frame")).alias("l"))
    return lists.select("cls", F.size("l").cast("long").alias("n"), F.element_at("l", 1).alias("first"), F.element_at("l", -1).alias("last"), F.aggregate("l", F.lit(0).cast("long"), lambda s, x: s + x).alias("frames"))


BASE = "count(*) AS n, count(du) AS with_fit, round(quantile_cont(abs(du),0.5),3) AS abs_du, round(quantile_cont(abs(dv),0.5),3) AS abs_dv, round(quantile_cont(du_mad,0.5),3) AS du_mad, round(quantile_cont(dv_mad,0.5),3) AS dv_mad, round(quantile_cont(inlier,0.5),3) AS inlier"


@query(f"{CLASSED}, t AS (SELECT *, CAST(rate > 8 AS INT) AS turning FROM cl) SELECT cls, turning, {BASE} FROM t GROUP BY GROUPING SETS ((), (cls), (turning))")
def baseline_summary(spark, d):
    """Pose quality over all frames, by class, and turning against straight."""
    rows = _classed(spark, d).withColumn("turning", (F.col("rate") > 8).cast("int"))
    c, t = F.col("cls"), F.col("turning")
    rows = rows.withColumns({"a_du": F.abs("du"), "a_dv": F.abs("dv")})
    return rows.groupingSets([[], [c], [t]], c, t).agg(F.count("*").alias("n"), F.count("du").alias("with_fit"), R.middle("a_du").alias("abs_du"), R.middle("a_dv").alias("abs_dv"), *[R.middle(x).alias(x) for x in ("du_mad", "dv_mad", "inlier")])


PAIRED = f"{CLASSED}, ab AS (SELECT frame, cls, pass_id, du AS du_a, dv AS dv_a, du*0.8-0.3 AS du_b, CASE WHEN frame%7=0 THEN NULL ELSE dv*0.9+0.2 END AS dv_b FROM cl), mg AS (SELECT *, sqrt(du_a*du_a+dv_a*dv_a) AS ma, sqrt(du_b*du_b+dv_b*dv_b) AS mb FROM ab)"


@query(f"{PAIRED} SELECT cls, pass_id, count(*) AS n, count(du_a) AS n_fit_a, count(du_b) AS n_fit_b, round(quantile_cont(abs(du_a),0.5),6) AS du_a_median, round(quantile_cont(abs(du_a),0.95),6) AS du_a_p95, round(quantile_cont(abs(du_b),0.5),6) AS du_b_median, round(quantile_cont(abs(dv_b),0.95),6) AS dv_b_p95, count(mb-ma) AS n_both, round(avg(CASE WHEN mb-ma < -2 THEN 1.0 WHEN mb-ma IS NOT NULL THEN 0.0 END),6) AS improved, round(avg(CASE WHEN mb-ma > 2 THEN 1.0 WHEN mb-ma IS NOT NULL THEN 0.0 END),6) AS worsened FROM mg GROUP BY ROLLUP (cls, pass_id)")
def pose_comparison(spark, d):
    """Two pose sources by group and pass: medians and tails of their offsets, and the share that got better or worse by over two pixels."""
    rows = _classed(spark, d).select("cls", "pass_id", F.col("du").alias("du_a"), F.col("dv").alias("dv_a"), (F.col("du") * 0.8 - 0.3).alias("du_b"), F.when(F.col("frame") % 7 != 0, F.col("dv") * 0.9 + 0.2).alias("dv_b"))
    delta = F.hypot("du_b", "dv_b") - F.hypot("du_a", "dv_a")
    rows = rows.withColumns({"delta": delta, **{f"a{c}": F.abs(c) for c in ("du_a", "du_b", "dv_b")}})
    share = lambda w: F.round(F.avg(F.when(F.col("delta").isNotNull(), F.when(w, 1.0).otherwise(0.0))), 6)
    p = lambda c, q: F.round(F.percentile(c, F.lit(q)), 6)
    return rows.rollup("cls", "pass_id").agg(F.count("*").alias("n"), F.count("du_a").alias("n_fit_a"), F.count("du_b").alias("n_fit_b"), p("adu_a", 0.5).alias("du_a_median"), p("adu_a", 0.95).alias("du_a_p95"), p("adu_b", 0.5).alias("du_b_median"), p("adv_b", 0.95).alias("dv_b_p95"), F.count("delta").alias("n_both"), share(F.col("delta") < -2).alias("improved"), share(F.col("delta") > 2).alias("worsened"))


@query(f"{CLASSED} SELECT cls, count(speed) AS speed_n, round(quantile_cont(speed,0.5),3) AS speed_median, round(quantile_cont(speed,0.75)-quantile_cont(speed,0.25),3) AS speed_iqr, round(min(speed),3) AS speed_min, round(max(speed),3) AS speed_max, count(*) FILTER (conflict) AS suspicious, count(*) FILTER (frame%30<>pass_id) AS mismatched FROM cl GROUP BY 1")
def alignment_summary(spark, d):
    rows = _classed(spark, d)
    return rows.groupBy("cls").agg(*R.quartiles("speed", "speed"), F.count_if("pass_conflict").alias("suspicious"), F.count_if(F.col("frame") % 30 != F.col("pass_id")).alias("mismatched"))


CONF = f"{CLASSED}, cf AS (SELECT frame, pass_id AS own, frame*7%30 AS other, (frame%10)/10.0::DOUBLE AS share, du_other AS b, CASE WHEN frame%6=0 THEN NULL ELSE du_other*0.6 END AS a, conflict FROM cl WHERE n_other > 0), cg AS (SELECT *, CASE WHEN share >= 0.5 THEN least(own,other) END AS lo, CASE WHEN share >= 0.5 THEN greatest(own,other) END AS hi, CAST(share >= 0.5 AS INT) AS crossed FROM cf)"


@query(f"{CONF} SELECT crossed, lo, hi, count(*) AS n, count(b) AS measured_before, count(a) AS measured_after, round(quantile_cont(abs(b),0.5),2) AS before, round(quantile_cont(abs(a),0.5),2) AS after, count(*) FILTER (conflict) AS conflicts FROM cg GROUP BY GROUPING SETS ((), (crossed), (crossed, lo, hi))")
def conflict_metric(spark, d):
    """Cross-pass conflicts over all frames, by whether another pass is in view, and by pair of passes."""
    rows = _classed(spark, d).where("n_other > 0").select((F.col("frame") % 10 / 10.0 >= 0.5).cast("int").alias("crossed"), F.col("pass_id").alias("own"), (F.col("frame") * 7 % 30).alias("other"), F.abs("du_other").alias("b"), F.when(F.col("frame") % 6 != 0, F.abs(F.col("du_other") * 0.6)).alias("a"), "pass_conflict")
    rows = rows.withColumns({"lo": F.when(F.col("crossed") == 1, F.least("own", "other")), "hi": F.when(F.col("crossed") == 1, F.greatest("own", "other"))})
    c, lo, hi = F.col("crossed"), F.col("lo"), F.col("hi")
    return rows.groupingSets([[], [c], [c, lo, hi]], c, lo, hi).agg(F.count("*").alias("n"), F.count("b").alias("measured_before"), F.count("a").alias("measured_after"), R.middle("b", 2).alias("before"), R.middle("a", 2).alias("after"), F.count_if("pass_conflict").alias("conflicts"))


@query(f"WITH {MEAS}, w AS (SELECT pass_id, du, dv, n, quantile_cont(du,0.5) OVER (PARTITION BY pass_id) AS m FROM ms WHERE du IS NOT NULL) SELECT pass_id, round(any_value(m),3) AS median, round(quantile_cont(abs(du-m),0.5),3) AS mad, count(*) AS n FROM w GROUP BY 1")
def offset_mad(spark, d):
    rows = _measured(spark, d).where("du is not null")
    return R.mad(rows, ["pass_id"], "du").join(rows.groupBy("pass_id").agg(F.count("*").alias("n")), "pass_id").select("pass_id", F.round("median", 3).alias("median"), F.round("mad", 3).alias("mad"), "n")


@query(f"WITH {MEAS}, e AS (SELECT pass_id, du, dv, sqrt(du*du+dv*dv) AS d, inlier FROM ms WHERE du IS NOT NULL), o AS (SELECT pass_id, count(*) AS n_total, count(*) FILTER (d <= 8) AS n_edge, sum(CASE WHEN d<=3 THEN 1.0 ELSE 0 END)/count(*) AS inl FROM e GROUP BY 1), m AS (SELECT pass_id, sqrt(avg(du*du+dv*dv)) AS rms, quantile_cont(du,0.5) AS dm FROM e WHERE d <= 8 GROUP BY 1), q AS (SELECT e.pass_id, quantile_cont(abs(du-dm),0.5) AS mad FROM e JOIN m USING (pass_id) WHERE d <= 8 GROUP BY 1) SELECT pass_id, n_total, n_edge, round(inl,4) AS inlier, CASE WHEN n_edge >= 5 THEN round(rms,4) END AS rms, CASE WHEN n_edge >= 5 THEN round(dm,4)+0.0 END AS du_median, CASE WHEN n_edge >= 5 THEN round(mad,4) END AS du_mad FROM o LEFT JOIN m USING (pass_id) LEFT JOIN q USING (pass_id)")
def robust_offsets(spark, d):
    """By pass: share of all offsets within reach, and root mean square, median and MAD of those in the window (none under five)."""
    e = _measured(spark, d).where("du is not null").withColumn("d", F.hypot("du", "dv"))
    whole = e.groupBy("pass_id").agg(F.count("*").alias("n_total"), F.count_if(F.col("d") <= 8).alias("n_edge"), F.avg(F.when(F.col("d") <= 3, 1.0).otherwise(0.0)).alias("inlier"))
    near = e.where("d <= 8")
    fit = R.mad(near, ["pass_id"], "du").join(near.groupBy("pass_id").agg(F.sqrt(F.avg(F.col("du") * F.col("du") + F.col("dv") * F.col("dv"))).alias("rms")), "pass_id")
    enough = lambda c: F.when(F.col("n_edge") >= 5, c)
    return whole.join(fit, "pass_id", "left").select("pass_id", "n_total", "n_edge", F.round("inlier", 4).alias("inlier"), enough(F.round("rms", 4)).alias("rms"), enough(r("median")).alias("du_median"), enough(F.round("mad", 4)).alias("du_mad"))


@query(f"WITH {MEAS}, b AS (SELECT CAST(floor(rate/2) AS BIGINT) AS band, CAST(floor(speed/0.4) AS BIGINT) AS sector, du, dv FROM ms WHERE du IS NOT NULL) SELECT band, sector, count(*) AS n, round(quantile_cont(du,0.5),4)+0.0 AS du, round(quantile_cont(dv,0.5),4)+0.0 AS dv FROM b GROUP BY GROUPING SETS ((band), (sector), (band, sector))")
def residual_structure(spark, d):
    rows = _measured(spark, d).where("du is not null").select(F.floor(F.col("rate") / 2).alias("band"), F.floor(F.col("speed") / 0.4).alias("sector"), "du", "dv")
    b, s = F.col("band"), F.col("sector")
    return rows.groupingSets([[b], [s], [b, s]], b, s).agg(F.count("*").alias("n"), r(F.percentile("du", F.lit(0.5))).alias("du"), r(F.percentile("dv", F.lit(0.5))).alias("dv"))


# ---- strata

STR = f"""WITH {PTS}, sx AS (SELECT id, cls, id%40+0.0::DOUBLE AS de, CASE WHEN id%9=0 THEN 0.0 ELSE sqrt(x*x+y*y) END AS dist, abs(z)*0.7::DOUBLE AS grad, degrees(atan2(z, sqrt(x*x+y*y))) AS el, degrees(atan2(y,x))+180.0 AS az, id%35 AS n_views, id//25 AS frame, psid, id%11<>0 AS ok FROM pt),
si AS (SELECT *, least(greatest(CAST(trunc(de/2) AS INT),0),19) AS bin, CASE WHEN dist > 0 THEN (dist>=0)::INT+(dist>=2)::INT+(dist>=3)::INT+(dist>=4)::INT+(dist>=6)::INT+(dist>=10)::INT+(dist>=15)::INT+(dist>=25)::INT+(dist>=40)::INT-1 ELSE 8 END AS di, greatest((grad>=0)::INT+(grad>=1)::INT+(grad>=2)::INT+(grad>=3)::INT+(grad>=4)::INT+(grad>=6)::INT+(grad>=8)::INT+(grad>=12)::INT+(grad>=16)::INT+(grad>=24)::INT-1,0) AS gi, least(greatest(CAST(trunc((el+90.0)/10.0) AS INT),0),17) AS ei, CAST(trunc(az/5.0) AS INT)%72 AS ai, least(n_views,31) AS vi FROM sx)"""


@query(f"{STR} SELECT family, CAST(stratum AS BIGINT) AS stratum, bin, count(*) AS n FROM (SELECT 'class' AS family, cls AS stratum, bin FROM si WHERE ok UNION ALL SELECT 'dist', di, bin FROM si WHERE ok UNION ALL SELECT 'grad', gi, bin FROM si WHERE ok UNION ALL SELECT 'elev', ei, bin FROM si WHERE ok UNION ALL SELECT 'az', ai, bin FROM si WHERE ok UNION ALL SELECT 'n_views', vi, bin FROM si WHERE ok UNION ALL SELECT 'frame', frame, bin FROM si WHERE ok UNION ALL SELECT 'psid', psid, bin FROM si WHERE ok) GROUP BY 1,2,3")
def eight_strata(spark, d):
    """Histograms of a difference in eight families of strata at once."""
    flat = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y"))
    p = scan_points(spark, d)
    families = R.strata(
        F.when(F.col("id") % 9 == 0, 0.0).otherwise(flat), F.abs("z") * 0.7, F.degrees(F.atan2(F.col("z"), flat)), F.degrees(F.atan2(F.col("y"), F.col("x"))) + 180.0, F.col("id") % 35, F.col("cls"), F.floor(F.col("id") / 25), F.col("psid")
    )
    return R.strata_counts(p, families, A.binned((F.col("id") % 40).cast("double"), 2.0, 20), F.col("id") % 11 != 0)


# ---- labels

LAB = f"WITH {PTS}, ev AS (SELECT tile, CASE WHEN id%6=0 THEN 255 ELSE cls%5 END AS truth, CASE WHEN id%7=0 THEN 255 WHEN id%4=0 THEN (cls+1)%5 ELSE cls%5 END AS predicted, id*29%256 AS conf, nret, id FROM pt)"


def _labels(spark, d):
    i, c = F.col("id"), F.col("cls")
    return scan_points(spark, d).select("id", "tile", F.when(i % 6 == 0, 255).otherwise(c % 5).alias("truth"), F.when(i % 7 == 0, 255).when(i % 4 == 0, (c + 1) % 5).otherwise(c % 5).alias("predicted"), (i * 29 % 256).alias("conf"), "nret")


@query(f"{LAB}, al AS (SELECT tile, truth, predicted FROM ev UNION ALL SELECT NULL, truth, predicted FROM ev), k AS (SELECT tile, c, count(*) FILTER (truth=c AND predicted=c)/count(*)::DOUBLE AS iou FROM (SELECT tile, truth, predicted, unnest(CASE WHEN truth=predicted THEN [truth] ELSE [truth,predicted] END) AS c FROM al WHERE truth<>255 AND predicted<>255) GROUP BY 1,2), m AS (SELECT tile, avg(iou) AS miou FROM k GROUP BY 1), g AS (SELECT tile, count(*) AS n, avg(CASE WHEN predicted<>255 THEN 1.0 ELSE 0 END) AS coverage, CAST(sum(CASE WHEN truth<>255 AND predicted<>255 THEN 1 ELSE 0 END) AS BIGINT) AS n_eval, avg(CASE WHEN truth<>255 AND predicted<>255 THEN CASE WHEN truth=predicted THEN 1.0 ELSE 0 END END) AS accuracy FROM al GROUP BY 1) SELECT g.tile, n, round(coverage,5) AS coverage, n_eval, round(accuracy,5) AS accuracy, round(miou,5) AS miou FROM g LEFT JOIN m ON g.tile IS NOT DISTINCT FROM m.tile")
def label_evaluation(spark, d):
    """Coverage, accuracy and mean IoU of point labels by tile and over all."""
    out = R.evaluated(_labels(spark, d), "tile")
    return out.select("tile", "n", F.round("coverage", 5).alias("coverage"), "n_eval", F.round("accuracy", 5).alias("accuracy"), F.round("miou", 5).alias("miou"))


@query(f"{LAB} SELECT conf//32 AS bin, count(*) AS n, round(avg(CASE WHEN truth=predicted THEN 1.0 ELSE 0 END),5) AS correct, count(*) FILTER (nret=2) AS ground, round(avg(CASE WHEN truth=predicted THEN 1.0 ELSE 0 END) FILTER (nret=2),5) AS ground_correct FROM ev WHERE truth<>255 AND predicted<>255 GROUP BY 1")
def label_calibration(spark, d):
    e = _labels(spark, d).where("truth <> 255 and predicted <> 255")
    hit, ground = F.when(F.col("truth") == F.col("predicted"), 1.0).otherwise(0.0), F.col("nret") == 2
    return e.groupBy(F.floor(F.col("conf") / 32).alias("bin")).agg(F.count("*").alias("n"), F.round(F.avg(hit), 5).alias("correct"), F.count_if(ground).alias("ground"), F.round(F.avg(F.when(ground, hit)), 5).alias("ground_correct"))


@query(f"{LAB} SELECT id//25 AS frame, count(*) AS n, count(*) FILTER (truth=0) AS full_0, count(*) FILTER (truth=1) AS full_1, count(*) FILTER (truth=0 AND nret=2) AS band_0, count(*) FILTER (truth=1 AND nret=2) AS band_1, round(1-count(*) FILTER (truth=255 AND nret=2)/nullif(count(*) FILTER (nret=2),0)::DOUBLE,5) AS labelled FROM ev GROUP BY 1")
def frame_statistics(spark, d):
    """Counts of labels of each frame, whole and in its band, and the labelled share of the band."""
    e = _labels(spark, d).withColumns({"frame": F.floor(F.col("id") / 25), "band": F.col("nret") == 2})
    t = F.col("truth")
    return e.groupBy("frame").agg(F.count("*").alias("n"), *[F.count_if(t == k).alias(f"full_{k}") for k in (0, 1)], *[F.count_if((t == k) & F.col("band")).alias(f"band_{k}") for k in (0, 1)], F.round(1 - F.try_divide(F.count_if((t == 255) & F.col("band")).cast("double"), F.count_if("band")), 5).alias("labelled"))


@query(f"{LAB}, md AS (SELECT truth, predicted, id%3 AS model FROM ev WHERE truth<>255 AND predicted<>255), k AS (SELECT model, c, count(*) FILTER (truth=c AND predicted=c)/count(*)::DOUBLE AS iou FROM (SELECT model, truth, predicted, unnest(CASE WHEN truth=predicted THEN [truth] ELSE [truth,predicted] END) AS c FROM md) GROUP BY 1,2) SELECT CAST(c AS INT) AS label, round(max(iou) FILTER (model=0),5) AS m0, round(max(iou) FILTER (model=1),5) AS m1, round(max(iou) FILTER (model=2),5) AS m2 FROM k GROUP BY 1")
def class_table(spark, d):
    """IoU by label and model, one column a model."""
    e = _labels(spark, d).where("truth <> 255 and predicted <> 255").withColumn("model", F.col("id") % 3)
    both = F.col("truth") == F.col("predicted")
    each = e.select("model", both.alias("hit"), F.explode(F.when(both, F.array("truth")).otherwise(F.array("truth", "predicted"))).alias("label"))
    per = each.groupBy("model", "label").agg(F.avg(F.when(F.col("hit"), 1.0).otherwise(0.0)).alias("iou"))
    wide = per.groupBy("label").pivot("model", [0, 1, 2]).agg(F.round(F.first("iou"), 5))
    return wide.select(F.col("label").cast("int").alias("label"), *[F.col(str(k)).alias(f"m{k}") for k in (0, 1, 2)])


@query("WITH t AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k, count(*) OVER (PARTITION BY user_id) AS n FROM events) SELECT user_id, round(quantile_cont(value,0.5) FILTER (k > 1 OR n = 1),4) AS seconds, CAST(floor(max(value)) AS BIGINT) AS peak FROM t GROUP BY 1")
def timing(spark, d):
    """Median of the runs without the first, and the largest."""
    w = Window.partitionBy("user_id")
    t = table(spark, d, "events").select("user_id", "value", F.row_number().over(w.orderBy("ts", "event_id")).alias("k"), F.count("*").over(w).alias("n"))
    return t.groupBy("user_id").agg(F.round(F.percentile(F.when((F.col("k") > 1) | (F.col("n") == 1), F.col("value")), F.lit(0.5)), 4).alias("seconds"), F.floor(F.max("value")).alias("peak"))


@query(f"{LAB}, k AS (SELECT tile, truth AS label, count(*) AS n FROM ev WHERE truth<>255 GROUP BY 1,2) SELECT tile, label, n, round(n/sum(n) OVER (PARTITION BY tile),5) AS share FROM k QUALIFY row_number() OVER (PARTITION BY tile ORDER BY n DESC, label) <= 4")
def top_labels(spark, d):
    """The four most frequent labels of each tile with their share."""
    k = _labels(spark, d).where("truth <> 255").groupBy("tile", F.col("truth").alias("label")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("tile")
    best = k.withColumns({"share": F.round(F.col("n") / F.sum("n").over(w), 5), "at": F.row_number().over(w.orderBy(F.desc("n"), "label"))})
    return best.where("at <= 4").drop("at")


@query(f"{LAB}, s AS (SELECT id//5 AS frame, avg(CASE WHEN truth=predicted THEN 1.0 ELSE 0 END) AS score FROM ev GROUP BY 1), b AS (SELECT frame FROM s QUALIFY row_number() OVER (ORDER BY round(score,6), frame) <= 6), o AS (SELECT frame, row_number() OVER (ORDER BY frame)-1 AS rk, count(*) OVER () AS n FROM s WHERE frame NOT IN (SELECT frame FROM b)), ks AS (SELECT DISTINCT CAST(round_even(k*(n-1)/5.0::DOUBLE,0) AS BIGINT) AS rk FROM (SELECT DISTINCT n FROM o), range(6) t(k)) SELECT frame, 'worst' AS reason FROM b UNION ALL SELECT frame, 'spread' FROM o WHERE rk IN (SELECT rk FROM ks)")
def picked_frames(spark, d):
    """The six worst frames and six others spread evenly."""
    from tidemark.operators.posetables import evenly_by_rank

    s = _labels(spark, d).groupBy(F.floor(F.col("id") / 5).alias("frame")).agg(F.round(F.avg(F.when(F.col("truth") == F.col("predicted"), 1.0).otherwise(0.0)), 6).alias("score"))
    worst = s.orderBy("score", "frame").limit(6).select("frame")
    spread = evenly_by_rank(s.select("frame").join(worst, "frame", "left_anti"), ["frame"], 6)
    return worst.withColumn("reason", F.lit("worst")).union(spread.withColumn("reason", F.lit("spread")))


@query(f"{LAB}, k AS (SELECT tile, truth, count(*) AS n FROM ev WHERE truth<>255 GROUP BY 1,2), b AS (SELECT truth, arg_min(tile, (-n, tile)) AS tile FROM k GROUP BY 1) SELECT tile, CAST(min(truth) AS INT) AS label, count(*) AS labels FROM b GROUP BY 1")
def picked_tiles(spark, d):
    """For each label the tile that has most of it; every tile once."""
    k = _labels(spark, d).where("truth <> 255").groupBy("tile", "truth").agg(F.count("*").alias("n"))
    best = k.groupBy("truth").agg(F.min_by("tile", F.struct((-F.col("n")).alias("minus"), "tile")).alias("tile"))
    return best.groupBy("tile").agg(F.min("truth").cast("int").alias("label"), F.count("*").alias("labels"))


@query(f"{LAB} SELECT id%3 AS model, CAST(count(DISTINCT predicted) AS BIGINT) AS n, string_agg(DISTINCT predicted, ',' ORDER BY predicted) AS labels FROM ev WHERE predicted<>255 GROUP BY 1")
def predictable_labels(spark, d):
    """Labels that each model ever gives."""
    g = _labels(spark, d).where("predicted <> 255").groupBy((F.col("id") % 3).alias("model")).agg(F.array_sort(F.collect_set("predicted")).alias("l"))
    return g.select("model", F.size("l").cast("long").alias("n"), F.array_join(F.transform("l", lambda x: x.cast("string")), ",").alias("labels"))


@query("""WITH n AS (SELECT least(greatest(CAST(floor(l_quantity*64/51) AS INT),0),63) AS a, least(greatest(CAST(floor(l_extendedprice*64/105000) AS INT),0),63) AS b FROM lineitem WHERE l_returnflag <> 'N'), j AS (SELECT a, b, count(*)::DOUBLE AS n FROM n GROUP BY 1,2), t AS (SELECT sum(n) AS s FROM j), hj AS (SELECT -sum(n/s*ln(n/s)) AS v FROM j, t), ha AS (SELECT -sum(n/s*ln(n/s)) AS v FROM (SELECT a, sum(n) AS n FROM j GROUP BY 1), t), hb AS (SELECT -sum(n/s*ln(n/s)) AS v FROM (SELECT b, sum(n) AS n FROM j GROUP BY 1), t) SELECT round((ha.v+hb.v)/hj.v,6) AS nmi FROM ha, hb, hj""")
def image_information(spark, d):
    """Normalised mutual information of two masked images in 64 by 64 bins."""
    li = table(spark, d, "lineitem").where("l_returnflag <> 'N'")
    j = li.groupBy(A.binned(F.col("l_quantity") * 64 / 51, 1.0, 64).alias("a"), A.binned(F.col("l_extendedprice") * 64 / 105000, 1.0, 64).alias("b")).agg(F.count("*").cast("double").alias("n"))
    a, b = F.col("a"), F.col("b")
    sets = j.groupingSets([[a, b], [a], [b]], a, b).agg(F.sum("n").alias("n"), F.grouping_id().alias("g"))
    h = sets.groupBy("g").agg((F.log(F.sum("n")) - F.sum(F.col("n") * F.log("n")) / F.sum("n")).alias("h"))
    return h.agg(F.round(F.sum(F.when(F.col("g") > 0, F.col("h"))) / F.max(F.when(F.col("g") == 0, F.col("h"))), 6).alias("nmi"))


# ---- product checks

@query(f"WITH {PTS}, a AS (SELECT tile, id, id%50 AS c FROM pt), b AS (SELECT tile, id, CASE WHEN id%401=0 THEN 99 ELSE id%50 END AS c FROM pt), t AS (SELECT a.tile, bool_and(a.c=b.c) AS ok, count(DISTINCT a.c) AS clusters FROM a JOIN b USING (tile,id) GROUP BY 1) SELECT tile, ok, clusters FROM t")
def cluster_id_check(spark, d):
    """Whether the cluster ids of two products of a tile are the same, point by point."""
    a = scan_points(spark, d).select("tile", "id", (F.col("id") % 50).alias("a"))
    b = scan_points(spark, d).select("tile", "id", F.when(F.col("id") % 401 == 0, 99).otherwise(F.col("id") % 50).alias("b"))
    return a.join(b, ["tile", "id"]).groupBy("tile").agg(F.bool_and(F.col("a") == F.col("b")).alias("ok"), F.countDistinct("a").alias("clusters"))


@query(f"WITH {PTS}, a AS (SELECT DISTINCT id%50 AS c FROM pt), b AS (SELECT DISTINCT CASE WHEN id%401=0 THEN 99 ELSE id%50+2 END AS c FROM pt) SELECT count(*) FILTER (a.c IS NOT NULL AND b.c IS NOT NULL) AS common, count(*) FILTER (b.c IS NULL) AS missing, count(*) FILTER (a.c IS NULL) AS extra, bool_and(a.c IS NOT NULL AND b.c IS NOT NULL) AS ok FROM a FULL JOIN b USING (c)")
def id_set_check(spark, d):
    p, i = scan_points(spark, d), F.col("id")
    return R.same_sets(p.select((i % 50).cast("long").alias("c")), p.select(F.when(i % 401 == 0, F.lit(99).cast("long")).otherwise(i % 50 + 2).alias("c")), "c")


@query(f"{LAB}, a AS (SELECT tile, truth, count(*) AS n FROM ev GROUP BY 1,2), b AS (SELECT tile, CASE WHEN id%97=0 THEN 3 ELSE truth END AS truth, count(*) AS n FROM ev GROUP BY 1,2) SELECT tile, bool_and(a.n IS NOT DISTINCT FROM b.n) AS ok, count(*) FILTER (a.n IS DISTINCT FROM b.n) AS differing FROM a FULL JOIN b USING (tile, truth) GROUP BY 1")
def histogram_check(spark, d):
    e = _labels(spark, d).select("tile", "id", "truth")
    return R.same_histograms(e, e.withColumn("truth", F.when(F.col("id") % 97 == 0, 3).otherwise(F.col("truth"))), "tile", "truth")


@query(f"WITH {PTS}, m AS (SELECT tile, quantile_cont(id%40+0.0,0.5) AS merged FROM pt GROUP BY 1), h AS (SELECT tile, CAST(floor((id%40)/0.05::DOUBLE) AS BIGINT) AS bin, count(*) AS n FROM pt GROUP BY 1,2), c AS (SELECT *, sum(n) OVER (PARTITION BY tile ORDER BY bin)/sum(n) OVER (PARTITION BY tile) AS cdf FROM h), q AS (SELECT tile, (min(bin) FILTER (cdf >= 0.5)+0.5)*0.05 AS binned FROM c GROUP BY 1) SELECT tile, round(merged,3) AS merged, round(binned,3) AS binned, abs(merged-binned) <= 0.55 AS ok FROM m JOIN q USING (tile)")
def median_check(spark, d):
    """Whether a product's median agrees with the median of its histogram."""
    p = scan_points(spark, d).select("tile", (F.col("id") % 40).cast("double").alias("v"))
    merged = p.groupBy("tile").agg(F.percentile("v", F.lit(0.5)).alias("merged"))
    hist = p.groupBy("tile", F.floor(F.col("v") / 0.05).alias("bin")).agg(F.count("*").alias("n"))
    both = merged.join(A.histogram_report(hist, "tile", "bin", "n", 0.05).select("tile", F.col("median").alias("binned")), "tile")
    return both.select("tile", F.round("merged", 3).alias("merged"), F.round("binned", 3).alias("binned"), (F.abs(F.col("merged") - F.col("binned")) <= 0.55).alias("ok"))


CHK = f"WITH {PTS}, v AS (SELECT tile, id%3 AS product, bool_and(id%211<>0) AS xyz_exact, bool_and(id%199<>0) AS class_exact, count(*) FILTER (id%307=0) AS n_moved FROM pt GROUP BY 1,2), s AS (SELECT tile, product, xyz_exact AND class_exact AND n_moved=0 AS ok FROM v)"


def _flags(spark, d):
    i = F.col("id")
    v = scan_points(spark, d).groupBy("tile", (i % 3).alias("product")).agg(F.bool_and(i % 211 != 0).alias("xyz_exact"), F.bool_and(i % 199 != 0).alias("class_exact"), F.count_if(i % 307 == 0).alias("n_moved"))
    return v.withColumn("ok", F.col("xyz_exact") & F.col("class_exact") & (F.col("n_moved") == 0))


@query(f"{CHK} SELECT tile, bool_and(ok) AS ok, count(*) AS products, count(*) FILTER (NOT ok) AS failed FROM s GROUP BY 1")
def verify_flags(spark, d):
    return _flags(spark, d).groupBy("tile").agg(F.bool_and("ok").alias("ok"), F.count("*").alias("products"), F.count_if(~F.col("ok")).alias("failed"))


@query(f"{CHK}, k AS (SELECT CASE WHEN tile%5=0 THEN NULL ELSE ok END AS ok FROM s) SELECT count(*) FILTER (ok) AS n_ok, count(*) FILTER (NOT ok) AS n_fail, count(*) FILTER (ok IS NULL) AS n_skip FROM k")
def check_summary(spark, d):
    """How many checks passed, failed and could not be made."""
    k = _flags(spark, d).select(F.when(F.col("tile") % 5 != 0, F.col("ok")).alias("ok"))
    return k.agg(F.count_if("ok").alias("n_ok"), F.count_if(~F.col("ok")).alias("n_fail"), F.count_if(F.col("ok").isNull()).alias("n_skip"))


@query(f"WITH {PTS}, a AS (SELECT count(*) AS n, min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1 FROM pt), b AS (SELECT count(*) AS n, min(x+0.2) AS x0, min(y-0.1) AS y0, max(x+0.2) AS x1, max(y-0.1) AS y1 FROM pt), s AS (SELECT a.n=b.n AS same_points, greatest(abs(a.x0-b.x0),abs(a.y0-b.y0),abs(a.x1-b.x1),abs(a.y1-b.y1)) AS shift, 0.2+radians(0.5)*1000+0.01 AS bound FROM a, b) SELECT same_points, round(shift,4) AS shift, round(bound,4) AS bound, shift > 0 AND shift <= bound AS ok FROM s")
def extent_check(spark, d):
    """Whether a registered product has all points, and moved by no more than its transforms allow."""
    p = scan_points(spark, d)
    box = lambda dx, dy, t: p.agg(F.count("*").alias("n" + t), F.min(F.col("x") + dx).alias("x0" + t), F.min(F.col("y") + dy).alias("y0" + t), F.max(F.col("x") + dx).alias("x1" + t), F.max(F.col("y") + dy).alias("y1" + t))
    both = box(0.0, 0.0, "a").join(F.broadcast(box(0.2, -0.1, "b")))
    moves = spark.createDataFrame([(0.2, -0.1, 0.05, 0.5), (0.1, 0.0, 0.0, -0.2)], "dx double, dy double, dz double, yaw double")
    bound = moves.agg((F.max(F.greatest(F.abs("dx"), F.abs("dy"), F.abs("dz"))) + F.radians(F.max(F.abs("yaw"))) * 1000.0 + 0.01).alias("bound"))
    shift = F.greatest(*[F.abs(F.col(c + "a") - F.col(c + "b")) for c in ("x0", "y0", "x1", "y1")])
    s = both.join(F.broadcast(bound)).withColumn("shift", shift)
    return s.select((F.col("na") == F.col("nb")).alias("same_points"), F.round("shift", 4).alias("shift"), F.round("bound", 4).alias("bound"), ((F.col("shift") > 0) & (F.col("shift") <= F.col("bound"))).alias("ok"))


@query(f"{CLASSED}, a AS (SELECT frame FROM cl WHERE cls='clean'), b AS (SELECT frame FROM cl WHERE cls='clean' AND frame%9<>0 OR cls='unverified' AND frame%4=0) SELECT (SELECT count(*) FROM a) AS before, (SELECT count(*) FROM b) AS after, (SELECT count(*) FROM b WHERE frame NOT IN (SELECT frame FROM a)) AS added, (SELECT count(*) FROM a WHERE frame NOT IN (SELECT frame FROM b)) AS removed")
def promoted_difference(spark, d):
    """What a new list of clean frames adds to the old one and takes from it."""
    c = _classed(spark, d).select("frame", "cls")
    a = c.where("cls = 'clean'").select("frame")
    b = c.where("cls = 'clean' and frame % 9 <> 0 or cls = 'unverified' and frame % 4 = 0").select("frame")
    n = R.same_sets(a, b, "frame")
    return n.select((F.col("common") + F.col("missing")).alias("before"), (F.col("common") + F.col("extra")).alias("after"), F.col("extra").alias("added"), F.col("missing").alias("removed"))


@query("WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders), b AS (SELECT c_custkey AS k FROM customer) SELECT (SELECT count(*) FROM orders) AS rows, (SELECT round(min(o_totalprice),2) FROM orders) AS low, (SELECT round(max(o_totalprice),2) FROM orders) AS high, (SELECT round(avg(o_totalprice),2) FROM orders) AS mean, (SELECT count(*) FROM a WHERE k NOT IN (SELECT k FROM b)) AS unknown, (SELECT count(*) FROM b WHERE k NOT IN (SELECT k FROM a)) AS unused")
def data_profile(spark, d):
    """Row count, range and mean of a table, and the keys that only one of two tables has."""
    o, c = table(spark, d, "orders"), table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"))
    shape = o.agg(F.count("*").alias("rows"), F.round(F.min("o_totalprice"), 2).alias("low"), F.round(F.max("o_totalprice"), 2).alias("high"), F.round(F.avg("o_totalprice"), 2).alias("mean"))
    sets = R.same_sets(o, c, "o_custkey").select(F.col("missing").alias("unknown"), F.col("extra").alias("unused"))
    return shape.join(F.broadcast(sets))


@query(f"WITH {PTS}, f AS (SELECT id AS frame, x AS e, y AS n FROM pt WHERE id%25=0), d AS (SELECT pt.id, cls, min(sqrt((x-e)*(x-e)+(y-n)*(y-n))) AS d FROM pt, f GROUP BY 1,2) SELECT cls, count(*) AS n, count(*) FILTER (d <= 6) AS covered, round(count(*) FILTER (d <= 6)/count(*)::DOUBLE,5) AS share FROM d GROUP BY 1")
def class_coverage(spark, d):
    """Share of each class's points with a frame within 6 m."""
    from tidemark.operators.joins import nearest_within

    p = scan_points(spark, d).select("id", "cls", "x", "y")
    f = p.where("id % 25 = 0").select(F.col("id").alias("frame"), F.col("x").alias("cx"), F.col("y").alias("cy"))
    near = nearest_within(p, f, 6.0, "id", "frame").select("id", F.lit(1).alias("hit"))
    g = p.join(near, "id", "left").groupBy("cls").agg(F.count("*").alias("n"), F.count("hit").alias("covered"))
    return g.withColumn("share", F.round(F.col("covered") / F.col("n"), 5))


@query("WITH s AS (SELECT p_partkey, md5(p_partkey || ':3') AS h FROM part), k AS (SELECT p_partkey, row_number() OVER (ORDER BY h, p_partkey) AS k FROM s) SELECT p_partkey FROM k WHERE k <= 12")
def random_frames(spark, d):
    """Twelve rows by a seeded shuffle: the twelve least hashes."""
    s = table(spark, d, "part").select("p_partkey", sampling.shuffled("p_partkey", 3).alias("h"))
    return s.orderBy("h", "p_partkey").limit(12).select("p_partkey")
