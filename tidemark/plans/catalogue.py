"""All registered queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import aggregates as A
from tidemark.operators import graph as G
from tidemark.operators import joins as J
from tidemark.operators import ordered as O  # noqa: E741
from tidemark.operators import raster as R
from tidemark.operators import sampling
from tidemark.plans.registry import EV, ORACLES, PT, QUERIES, W, as_sql, query, r
from tidemark.sources.tables import spatial_points, table, timed_events

# ---- ordered sequences


@query(f"WITH {EV}, f AS (SELECT event_id, user_id, t, CASE WHEN t - lag(t) {W} > 7200 THEN 1 ELSE 0 END AS new FROM e) SELECT event_id, user_id, CAST(sum(new) {W} AS BIGINT) AS session FROM f")
def gap_sessions(spark, d):
    return O.sessions(timed_events(spark, d), "user_id", ["t", "event_id"], "t", 7200.0).select("event_id", "user_id", "session")


@query(f"WITH {EV}, f AS (SELECT event_id, user_id, t, CASE WHEN t - lag(t) {W} > 7200 OR abs(value - lag(value) {W}) > 80 THEN 1 ELSE 0 END AS new FROM e), s AS (SELECT *, sum(new) {W} AS session FROM f) SELECT user_id, CAST(session AS BIGINT) AS session, count(*) AS n, round(max(t)-min(t),3)+0.0 AS length FROM s GROUP BY 1,2")
def jump_sessions(spark, d):
    s = O.sessions(timed_events(spark, d), "user_id", ["t", "event_id"], "t", 7200.0, "value", 80.0)
    return s.groupBy("user_id", "session").agg(F.count("*").alias("n"), r(F.max("t") - F.min("t"), 3).alias("length"))


@query(f"""WITH {EV}, f AS (SELECT event_id, t - lag(t) {W} AS a, lead(t) {W} - t AS b, value - lag(value) {W} AS da, lead(value) {W} - value AS db FROM e)
SELECT event_id, round(CASE WHEN a IS NULL AND b IS NULL THEN 0.0 WHEN a IS NULL THEN db/nullif(b,0) WHEN b IS NULL THEN da/nullif(a,0) ELSE (da/nullif(a,0)*b + db/nullif(b,0)*a)/nullif(a+b,0) END, 4)+0.0 AS rate FROM f""")
def central_difference(spark, d):
    return O.central_difference(timed_events(spark, d), "user_id", ["t", "event_id"], "t", "value").select("event_id", r("rate").alias("rate"))


@query(f"""WITH {EV}, f AS (SELECT event_id, coalesce(lag(value) {W}, value) AS v0, coalesce(lead(value) {W}, value) AS v1, coalesce(lag(t) {W}, t) AS t0, coalesce(lead(t) {W}, t) AS t1 FROM e),
g AS (SELECT *, v1 - v0 + 180.0 AS q FROM f) SELECT event_id, round(abs((q - floor(q/360.0)*360.0 - 180.0)/nullif(t1-t0,0)), 4)+0.0 AS rate FROM g""")
def wrapped_rate(spark, d):
    return O.angle_rate(timed_events(spark, d), "user_id", ["t", "event_id"], "t", "value").select("event_id", r("rate").alias("rate"))


@query(f"WITH {EV} SELECT event_id, round(lead(value) {W} - 2*value + lag(value) {W}, 4)+0.0 AS second FROM e")
def second_difference(spark, d):
    return O.second_difference(timed_events(spark, d), "user_id", ["t", "event_id"], "value").select("event_id", r("second").alias("second"))


@query(f"WITH {EV}, f AS (SELECT event_id, t, lag(value) {W} AS x0, lead(value) {W} AS x1, lag(t) {W} AS t0, lead(t) {W} AS t1 FROM e) SELECT event_id, round(x0 + (x1-x0)*((t-t0)/nullif(t1-t0,0)), 4)+0.0 AS predicted FROM f")
def leave_one_out(spark, d):
    return O.leave_one_out(timed_events(spark, d), "user_id", ["t", "event_id"], "t", "value").select("event_id", r("predicted").alias("predicted"))


NEAR = f"""WITH {EV}, fr AS (SELECT user_id, t, min(event_id) AS id FROM e WHERE event_type='view' GROUP BY 1,2), c AS (SELECT * FROM e WHERE event_type='click'),
b AS (SELECT c.event_id, c.user_id, c.t, c.value, f.t AS bt, f.id AS bid FROM c ASOF LEFT JOIN fr f ON c.user_id=f.user_id AND c.t >= f.t),
n AS (SELECT b.*, f.t AS nt, f.id AS aid FROM b ASOF LEFT JOIN fr f ON b.user_id=f.user_id AND b.t <= f.t)"""


def _views_and_clicks(spark, d):
    e = timed_events(spark, d)
    return e.where("event_type = 'click'").select("event_id", "user_id", "t", "value"), e.where("event_type = 'view'").select("user_id", "t", F.col("event_id").alias("id"))


@query(f"{NEAR} SELECT event_id, CASE WHEN bid IS NOT NULL AND (aid IS NULL OR t-bt <= nt-t) THEN bid ELSE aid END AS nearest FROM n")
def nearest_frame_asof(spark, d):
    clicks, views = _views_and_clicks(spark, d)
    return O.nearest(clicks, views, "user_id", "t", 86_400.0).select("event_id", "nearest")


@query(f"{NEAR} SELECT event_id, round(nt - bt, 3)+0.0 AS gap, bid AS before_id, aid AS after_id FROM n")
def frames_around(spark, d):
    clicks, views = _views_and_clicks(spark, d)
    return O.around(clicks, views, "user_id", "t", 86_400.0).select("event_id", r(F.col("after.t") - F.col("before.t"), 3).alias("gap"), F.col("before.id").alias("before_id"), F.col("after.id").alias("after_id"))


@query(f"""WITH {EV}, fr AS (SELECT user_id, t, min(value) AS x FROM e WHERE event_type='view' GROUP BY 1,2), fy AS (SELECT *, 3*x+180.0-360.0*floor((3*x+180.0)/360.0)-180.0 AS y FROM fr), s AS (SELECT user_id, t AS t0, x AS x0, y AS y0, lead(t) OVER w AS t1, lead(x) OVER w AS x1, lead(y) OVER w AS y1, lag(t) OVER w AS p FROM fy WINDOW w AS (PARTITION BY user_id ORDER BY t)),
g AS (SELECT * FROM s WHERE t1 IS NOT NULL OR p IS NULL), f AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY t0)=1), c AS (SELECT event_id, user_id, t FROM e WHERE event_type='click'), b AS (SELECT c.event_id, c.user_id, c.t, g.t0, g.x0, g.y0, g.t1, g.x1, g.y1 FROM c ASOF LEFT JOIN g ON c.user_id=g.user_id AND c.t >= g.t0),
m AS (SELECT b.event_id, b.t, coalesce(b.t0,f.t0) AS t0, coalesce(b.x0,f.x0) AS x0, coalesce(b.y0,f.y0) AS y0, coalesce(b.t1, CASE WHEN b.t0 IS NULL THEN f.t1 END) AS t1, coalesce(b.x1, CASE WHEN b.t0 IS NULL THEN f.x1 END) AS x1, coalesce(b.y1, CASE WHEN b.t0 IS NULL THEN f.y1 END) AS y1 FROM b LEFT JOIN f USING (user_id)),
q AS (SELECT event_id, CASE WHEN t1 IS NULL THEN 0.0 ELSE (t-t0)/(t1-t0) END AS a, x0, coalesce(x1-x0,0) AS dx, y0, coalesce(y1-y0,0)+180.0 AS dy FROM m), r AS (SELECT event_id, x0+dx*a AS x, y0+(dy-360.0*floor(dy/360.0)-180.0)*a+180.0 AS y FROM q) SELECT event_id, round(x,3)+0.0 AS value, round(y-360.0*floor(y/360.0)-180.0,3)+0.0 AS yaw FROM r""")
def linear_interpolation(spark, d):
    clicks, _ = _views_and_clicks(spark, d)
    views = timed_events(spark, d).where("event_type = 'view'").select("user_id", "t", "value", O.wrapped(3 * F.col("value")).alias("yaw"))
    at = O.interpolated(clicks.select("event_id", "user_id", "t"), views, "user_id", "t", ["value"], ["yaw"], 86_400.0, filled=True)
    return at.select("event_id", as_sql("value", 3).alias("value"), as_sql("yaw", 3).alias("yaw"))


@query(f"""WITH {EV}, g AS (SELECT floor(t/86400)::BIGINT AS pass, min(t) AS lo, max(t) AS hi FROM e WHERE event_type='signup' GROUP BY 1), b AS (SELECT pass, (hi + lead(lo) OVER (ORDER BY lo))/2 AS hi, (lag(hi) OVER (ORDER BY lo) + lo)/2 AS lo FROM g)
SELECT event_id, pass FROM e JOIN b ON (b.lo IS NULL OR t > b.lo) AND (b.hi IS NULL OR t <= b.hi) WHERE event_type='error'""")
def pass_of_time(spark, d):
    e = timed_events(spark, d)
    days = e.where("event_type = 'signup'").select("t", F.floor(F.col("t") / 86_400).alias("pass"))
    return O.group_at(e.where("event_type = 'error'").select("event_id", "t"), days, "pass", "t", 86_400.0).select("event_id", "pass")


@query(f"""WITH {EV}, s AS (SELECT user_id, t AS t0, lead(t) {W} AS t1, value AS x0, lead(value) {W} AS x1 FROM e), g AS (SELECT *, ceil(t0/3600) AS k0, ceil(t1/3600)-1 AS k1 FROM s WHERE t1 > t0 AND t1-t0 <= 86400), k AS (SELECT *, unnest(range(k0::BIGINT, k1::BIGINT+1)) AS k FROM g)
SELECT user_id, k, round(x0+(x1-x0)*(k*3600.0-t0)/(t1-t0), 4)+0.0 AS value FROM k""")
def resample_grid(spark, d):
    return O.resampled(timed_events(spark, d), "user_id", ["t", "event_id"], "t", "value", 3600.0, 86_400.0).select("user_id", "k", r("value").alias("value"))


@query(f"""WITH {EV}, v AS (SELECT user_id, t, lead(t) OVER (PARTITION BY user_id ORDER BY t) AS t1 FROM (SELECT DISTINCT user_id, t FROM e WHERE event_type='signup')), i AS (SELECT user_id AS owner, t AS lo, least(t1, t+3600) AS hi FROM v WHERE t1 IS NOT NULL)
SELECT event_id, owner FROM e JOIN i ON t > lo AND t <= hi WHERE event_type='error'""")
def interval_of_time(spark, d):
    e = timed_events(spark, d)
    from pyspark.sql.window import Window

    v = e.where("event_type = 'signup'").select("user_id", "t").distinct().withColumn("t1", F.lead("t").over(Window.partitionBy("user_id").orderBy("t"))).where("t1 is not null")
    i = v.select(F.col("user_id").alias("owner"), F.col("t").alias("lo"), F.least(F.col("t1"), F.col("t") + 3600).alias("hi"))
    return J.interval_join(e.where("event_type = 'error'").select("event_id", "t"), i, "t", 3600.0).select("event_id", "owner")


@query(f"""WITH {EV}, m AS (SELECT event_id, user_id, value, quantile_cont(value, 0.5) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS med FROM e) SELECT event_id, round(med, 4)+0.0 AS med, abs(value-med) > 100 AS outlier FROM m""")
def rolling_median(spark, d):
    from pyspark.sql.window import Window

    w = Window.partitionBy("user_id").orderBy("t", "event_id").rowsBetween(-5, 5)
    s = F.array_sort(F.collect_list("value").over(w))
    m = timed_events(spark, d).select("event_id", "value", s.alias("s")).withColumn("n", F.size("s"))
    med = (F.get("s", F.floor((F.col("n") - 1) / 2).cast("int")) + F.get("s", F.floor(F.col("n") / 2).cast("int"))) / 2
    return m.select("event_id", r(med).alias("med"), (F.abs(F.col("value") - med) > 100).alias("outlier"))


# ---- range and nearest joins


@query(f"WITH {PT} SELECT vec_id FROM p WHERE x*x + (y-1)*(y-1) <= 100")
def disc_query(spark, d):
    return spatial_points(spark, d).where(F.col("x") * F.col("x") + (F.col("y") - 1) * (F.col("y") - 1) <= 100).select("vec_id")


@query("SELECT event_id, user_id FROM events WHERE epoch_us(ts) BETWEEN (SELECT min(epoch_us(ts)) + 3600000000 FROM events) AND (SELECT min(epoch_us(ts)) + 86400000000 FROM events)")
def time_query(spark, d):
    """The bounds are a scalar subquery: nothing runs while the plan is made."""
    e = table(spark, d, "events")
    first = e.agg(F.min("ts")).scalar()
    return e.where(F.col("ts").between(first + F.expr("INTERVAL 1 HOUR"), first + F.expr("INTERVAL 1 DAY"))).select("event_id", "user_id")


RANGE = f"WITH {PT}, c AS (SELECT vec_id AS centre, x AS cx, y AS cy FROM p WHERE label=3)"


def _centres(p):
    return p.where("label = 3").select(F.col("vec_id").alias("centre"), F.col("x").alias("cx"), F.col("y").alias("cy"))


@query(f"{RANGE} SELECT vec_id, centre, round((x-cx)*(x-cx)+(y-cy)*(y-cy), 4)+0.0 AS d2 FROM p, c WHERE label<>3 AND (x-cx)*(x-cx)+(y-cy)*(y-cy) <= 4")
def grid_range_join(spark, d):
    p = spatial_points(spark, d)
    return J.range_join(p.where("label <> 3"), _centres(p), 2.0).select("vec_id", "centre", r("d2").alias("d2"))


@query(f"{RANGE} SELECT vec_id, arg_min(centre, ((x-cx)*(x-cx)+(y-cy)*(y-cy), centre)) AS centre FROM p, c WHERE label<>3 AND (x-cx)*(x-cx)+(y-cy)*(y-cy) <= 25 GROUP BY 1")
def nearest_neighbour(spark, d):
    p = spatial_points(spark, d)
    return J.nearest_within(p.where("label <> 3"), _centres(p), 5.0, "vec_id", "centre").select("vec_id", "centre")


@query(f"WITH {PT} SELECT a.label AS a, b.label AS b, count(*) AS n FROM p a, p b WHERE a.label<b.label AND (a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y) <= 1 GROUP BY 1,2")
def overlap_pairs(spark, d):
    p = spatial_points(spark, d)
    other = p.select(F.col("label").alias("b"), F.col("x").alias("cx"), F.col("y").alias("cy"))
    return J.range_join(p.withColumnRenamed("label", "a"), other, 1.0).where("a < b").groupBy("a", "b").agg(F.count("*").alias("n"))


@query(f"{EV.replace('e AS', 'WITH e AS')}, c AS (SELECT * FROM e WHERE event_type='click'), v AS (SELECT user_id AS vu, t AS vt FROM e WHERE event_type='purchase') SELECT event_id, count(vt) AS n FROM c LEFT JOIN v ON vu=user_id AND abs(vt-t) <= 3600 GROUP BY 1")
def time_window_gather(spark, d):
    e = timed_events(spark, d)
    c = e.where("event_type = 'click'").select("event_id", "user_id", "t")
    cut = e.where("event_type = 'purchase'").select("user_id", F.col("t").alias("vt"), F.explode(F.sequence(F.floor((F.col("t") - 3600) / 3600), F.floor((F.col("t") + 3600) / 3600))).alias("b"))
    near = c.withColumn("b", F.floor(F.col("t") / 3600)).join(cut, ["user_id", "b"]).where(F.abs(F.col("vt") - F.col("t")) <= 3600).groupBy("event_id").agg(F.count("*").alias("n"))
    return c.select("event_id").join(near, "event_id", "left").fillna(0, ["n"])


@query("SELECT l_orderkey, l_linenumber, coalesce(o_totalprice, -1.0) AS price, coalesce(p_size, -1) AS size FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus='F') ON l_orderkey=o_orderkey LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON l_partkey=p_partkey")
def row_identity_merge(spark, d):
    li, o, p = table(spark, d, "lineitem"), table(spark, d, "orders").where("o_orderstatus = 'F'"), table(spark, d, "part").where("p_size > 10")
    full = li.join(o, li.l_orderkey == o.o_orderkey, "left").join(p, li.l_partkey == p.p_partkey, "left")
    return full.select("l_orderkey", "l_linenumber", F.coalesce("o_totalprice", F.lit(-1.0)).alias("price"), F.coalesce("p_size", F.lit(-1)).alias("size"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def missing_anti(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").select("c_custkey").join(o, "c_custkey", "left_anti")


@query("SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON s_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey")
def lookup_map(spark, d):
    n, g = table(spark, d, "nation"), table(spark, d, "region")
    return table(spark, d, "supplier").join(n, F.col("s_nationkey") == n.n_nationkey).join(g, n.n_regionkey == g.r_regionkey).select("s_suppkey", "n_name", "r_name")


@query("SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS row_offset FROM part")
def global_offsets(spark, d):
    """Offset of every row, by ranked ranges: no task sorts the whole table."""
    return _offsets(table(spark, d, "part"))


def _offsets(part):
    return sampling.ranked(part.select("p_partkey"), ["p_partkey"]).select("p_partkey", F.col("rank").cast("bigint").alias("row_offset"))


# ---- aggregates


@query("SELECT l_partkey, l_orderkey, l_linenumber, CAST(k AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_discount DESC, l_orderkey, l_linenumber) AS k FROM lineitem) WHERE k <= 5")
def top_k_samples(spark, d):
    return A.top_k(table(spark, d, "lineitem"), "l_partkey", "l_discount", ["l_orderkey", "l_linenumber"], 5).select("l_partkey", "l_orderkey", "l_linenumber", "rank")


@query("""WITH s AS (SELECT l_partkey AS k, l_quantity/50.0 AS r, l_discount*10 AS g, l_tax*12 AS b, l_orderkey, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS pos FROM lineitem), t AS (SELECT * FROM s WHERE pos <= 5),
m AS (SELECT k, quantile_cont(r,0.5) AS mr, quantile_cont(g,0.5) AS mg, quantile_cont(b,0.5) AS mb, count(*) AS views FROM t GROUP BY 1), w AS (SELECT t.*, mr, mg, mb, views, sqrt((r-mr)*(r-mr)+(g-mg)*(g-mg)+(b-mb)*(b-mb)) AS away FROM t JOIN m USING (k)), a AS (SELECT k, quantile_cont(away,0.5) AS mad FROM w GROUP BY 1),
x AS (SELECT k, quantile_cont(r,0.5) AS r, quantile_cont(g,0.5) AS g, quantile_cont(b,0.5) AS b, count(*) AS kept FROM w JOIN a USING (k) WHERE round(away,9) <= round(2.5*mad+0.001,9) GROUP BY 1), y AS (SELECT k, any_value(mr) AS mr, any_value(mg) AS mg, any_value(mb) AS mb, any_value(views) AS views, any_value(mad) AS mad, arg_min(l_orderkey, pos) AS frame FROM w JOIN a USING (k) GROUP BY 1)
SELECT k AS l_partkey, round(coalesce(r,mr),5)+0.0 AS r, round(coalesce(g,mg),5)+0.0 AS g, round(coalesce(b,mb),5)+0.0 AS b, CAST(views AS INT) AS views, CAST(coalesce(kept,0) AS INT) AS kept, round(mad,5)+0.0 AS mad, CAST(floor(least(greatest(round(255.0*(1.0-(CASE WHEN views>=2 THEN mad ELSE 0.15 END)/0.15),6),0),255)) AS INT) AS conf, frame FROM y LEFT JOIN x USING (k)""")
def robust_median(spark, d):
    """The five best samples of each key, fused without their outliers."""
    li = table(spark, d, "lineitem").withColumns({"r": F.col("l_quantity") / 50.0, "g": F.col("l_discount") * 10, "b": F.col("l_tax") * 12})
    fused = A.robust_colour(li, "l_partkey", ["r", "g", "b"], "l_extendedprice", ["l_orderkey", "l_linenumber"])
    return fused.select("l_partkey", *[r(c, 5).alias(c) for c in "rgb"], "views", "kept", r("mad", 5).alias("mad"), "conf", F.col("best_l_orderkey").alias("frame"))


@query("""WITH s AS (SELECT l_partkey, l_suppkey%7 AS c, sum(l_discount) AS w, count(*) AS n FROM lineitem GROUP BY 1,2), t AS (SELECT l_partkey, arg_min(c, (-round(w,6), c)) AS winner, max(round(w,6)) AS top, sum(w) AS total, sum(n) AS views FROM s GROUP BY 1),
b AS (SELECT l_partkey, arg_min(l_orderkey, (-l_discount, l_orderkey, l_linenumber)) AS frame FROM lineitem WHERE l_discount > 0 GROUP BY 1)
SELECT l_partkey, CASE WHEN total > 0 THEN winner ELSE 255 END AS winner, CAST(CASE WHEN total > 0 THEN round_even(round(255*top/total, 6), 0) ELSE 0 END AS INT) AS conf, CAST(least(views,255) AS BIGINT) AS views, frame FROM t LEFT JOIN b USING (l_partkey)""")
def weighted_vote(spark, d):
    li = table(spark, d, "lineitem").withColumn("c", F.col("l_suppkey") % 7)
    return A.vote(li, "l_partkey", "c", "l_discount", ["l_orderkey", "l_linenumber"]).select("l_partkey", "winner", "conf", "views", F.col("best_l_orderkey").alias("frame"))


@query("SELECT l_suppkey, arg_max(l_extendedprice, (l_shipdate, l_orderkey, l_linenumber)) AS l_extendedprice FROM lineitem GROUP BY 1")
def last_write_wins(spark, d):
    return A.last_write(table(spark, d, "lineitem"), "l_suppkey", ["l_shipdate", "l_orderkey", "l_linenumber"], "l_extendedprice")


@query("""WITH b AS (SELECT l_returnflag, l_linestatus, least(greatest(CAST(floor(l_extendedprice/500) AS INT),0),199) AS bin FROM lineitem) SELECT l_returnflag, l_linestatus, bin, count(*) AS n FROM b GROUP BY GROUPING SETS ((l_returnflag,bin),(l_linestatus,bin),(bin))""")
def strata_histograms(spark, d):
    b = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", A.binned("l_extendedprice", 500.0, 200).alias("bin"))
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return b.groupingSets([[flag, F.col("bin")], [status, F.col("bin")], [F.col("bin")]], flag, status, F.col("bin")).agg(F.count("*").alias("n"))


HIST = "h AS (SELECT l_returnflag AS k, least(greatest(CAST(floor(l_extendedprice/1200/0.05) AS INT),0),1999) AS bin, count(*) AS c FROM lineitem GROUP BY 1,2)"


@query(f"""WITH {HIST}, w AS (SELECT *, (bin+0.5)*0.05 AS x, sum(c) OVER (PARTITION BY k) AS n, sum(c) OVER (PARTITION BY k ORDER BY bin)/sum(c) OVER (PARTITION BY k) AS cdf FROM h), m AS (SELECT k, min(x) FILTER (cdf >= 0.5) AS median FROM w GROUP BY 1), v AS (SELECT k, abs(x-median) AS dev, c, n FROM w JOIN m USING (k)), u AS (SELECT k, dev, sum(c) OVER (PARTITION BY k ORDER BY dev)/n AS cdf FROM v), a AS (SELECT k, min(dev) FILTER (cdf >= 0.5) AS mad FROM u GROUP BY 1)
SELECT k AS l_returnflag, CAST(any_value(n) AS BIGINT) AS n, round(sum(c*x)/any_value(n),4) AS mean, round(any_value(median),4) AS median, round(any_value(mad),4) AS mad, round(min(x) FILTER (cdf>=0.25),4) AS p25, round(min(x) FILTER (cdf>=0.75),4) AS p75, round(min(x) FILTER (cdf>=0.9),4) AS p90, round(min(x) FILTER (cdf>=0.95),4) AS p95, round(min(x) FILTER (cdf>=0.99),4) AS p99, round(100.0*coalesce(sum(c) FILTER (x>20),0)/any_value(n),4) AS pct_above, round(100.0*coalesce(sum(c) FILTER (x<5),0)/any_value(n),4) AS pct_below FROM w JOIN m USING (k) JOIN a USING (k) GROUP BY 1""")
def histogram_quantile(spark, d):
    binned = table(spark, d, "lineitem").select("l_returnflag", A.binned(F.col("l_extendedprice") / 1200, 0.05, 2000).alias("bin"))
    found = A.histogram_report(binned.groupBy("l_returnflag", "bin").agg(F.count("*").alias("c")), "l_returnflag", "bin", "c", 0.05)
    return found.select("l_returnflag", "n", *[F.round(c, 4).alias(c) for c in found.columns[2:]])


@query("SELECT quality AS truth, toxic AS predicted, count(*) AS n FROM labels GROUP BY 1,2")
def confusion_matrix(spark, d):
    return A.confusion(table(spark, d, "labels"), "quality", "toxic")


@query("""WITH m AS (SELECT quality AS t, toxic AS p, count(*) AS n FROM labels GROUP BY 1,2), k AS (SELECT t AS label FROM m UNION SELECT p FROM m), x AS (SELECT label, coalesce((SELECT sum(n) FROM m WHERE t=label),0) AS r, coalesce((SELECT sum(n) FROM m WHERE p=label),0) AS c, coalesce((SELECT sum(n) FROM m WHERE t=label AND p=label),0) AS tp FROM k) SELECT label, CAST(tp AS DOUBLE)/nullif(r+c-tp,0) AS iou FROM x""")
def intersection_over_union(spark, d):
    return A.iou(A.confusion(table(spark, d, "labels"), "quality", "toxic"))


@query("SELECT CAST(floor(l_discount*100/2) AS BIGINT) AS bin, count(*) AS n, round(avg(CASE WHEN l_returnflag='R' THEN 1.0 ELSE 0.0 END),6) AS share FROM lineitem GROUP BY 1")
def calibration_curve(spark, d):
    return table(spark, d, "lineitem").groupBy(F.floor(F.col("l_discount") * 100 / 2).alias("bin")).agg(F.count("*").alias("n"), F.round(F.avg(F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)), 6).alias("share"))


@query("SELECT user_id, CAST(count(*) FILTER (WHERE event_type='click') AS BIGINT) AS click, CAST(count(*) FILTER (WHERE event_type='error') AS BIGINT) AS error, CAST(count(*) FILTER (WHERE event_type='view') AS BIGINT) AS view FROM events GROUP BY 1")
def crosstab(spark, d):
    return table(spark, d, "events").groupBy("user_id").pivot("event_type", ["click", "error", "view"]).agg(F.count(F.lit(1))).fillna(0)


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(quantile_cont(l_quantity,0.5),4)+0.0 AS median FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def group_rollup(spark, d):
    return table(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), r(F.percentile("l_quantity", F.lit(0.5))).alias("median"))


CELLS = f"WITH {PT}, c AS (SELECT CAST(floor(x/2) AS BIGINT) AS i, CAST(floor(y/2) AS BIGINT) AS j, min(z) AS value FROM p GROUP BY 1,2)"


def _cells(spark, d):
    return spatial_points(spark, d).groupBy(F.floor(F.col("x") / 2).alias("i"), F.floor(F.col("y") / 2).alias("j")).agg(F.min("z").alias("value"))


@query(f"WITH {PT} SELECT CAST(floor(x/2) AS BIGINT) AS i, CAST(floor(y/2) AS BIGINT) AS j, arg_min(vec_id, (z, vec_id)) AS id, round(min(z),4)+0.0 AS depth FROM p GROUP BY 1,2")
def scatter_min_argmin(spark, d):
    return spatial_points(spark, d).groupBy(F.floor(F.col("x") / 2).alias("i"), F.floor(F.col("y") / 2).alias("j")).agg(F.min_by("vec_id", F.struct("z", "vec_id")).alias("id"), r(F.min("z")).alias("depth"))


@query(f"WITH {PT} SELECT CAST(floor(x/5) AS BIGINT) AS i, CAST(floor(y/5) AS BIGINT) AS j, count(*) AS n, round(covar_pop(x,y),4)+0.0 AS cxy, round(var_pop(z),4)+0.0 AS vz FROM p GROUP BY 1,2")
def voxel_covariance(spark, d):
    return spatial_points(spark, d).groupBy(F.floor(F.col("x") / 5).alias("i"), F.floor(F.col("y") / 5).alias("j")).agg(F.count("*").alias("n"), r(F.covar_pop("x", "y")).alias("cxy"), r(F.var_pop("z")).alias("vz"))


@query(f"WITH {PT} SELECT label, count(DISTINCT (floor(x/2), floor(y/2)))*4.0 AS area FROM p GROUP BY 1")
def footprint_area(spark, d):
    return spatial_points(spark, d).groupBy("label").agg((F.countDistinct(F.floor(F.col("x") / 2), F.floor(F.col("y") / 2)) * 4.0).alias("area"))


@query(f"WITH {PT} SELECT CAST(floor(x/10) AS BIGINT) AS bx, CAST(floor(y/10) AS BIGINT) AS byy, count(*) AS n, round(quantile_cont(z,0.5),4)+0.0 AS median FROM p GROUP BY 1,2")
def binned_median(spark, d):
    return spatial_points(spark, d).groupBy(F.floor(F.col("x") / 10).alias("bx"), F.floor(F.col("y") / 10).alias("byy")).agg(F.count("*").alias("n"), r(F.percentile("z", F.lit(0.5))).alias("median"))


@query("""WITH j AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*)::DOUBLE AS n FROM lineitem GROUP BY 1,2), t AS (SELECT sum(n) AS s FROM j), h AS (SELECT -sum(n/s*ln(n/s)) AS hj FROM j,t), ha AS (SELECT -sum(n/s*ln(n/s)) AS v FROM (SELECT a, sum(n) AS n FROM j GROUP BY 1), t), hb AS (SELECT -sum(n/s*ln(n/s)) AS v FROM (SELECT b, sum(n) AS n FROM j GROUP BY 1), t) SELECT round((ha.v+hb.v)/hj, 6) AS nmi FROM h, ha, hb""")
def mutual_information(spark, d):
    j = table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").cast("double").alias("n"))
    sets = j.groupingSets([[F.col("l_returnflag"), F.col("l_linestatus")], [F.col("l_returnflag")], [F.col("l_linestatus")]], F.col("l_returnflag"), F.col("l_linestatus")).agg(F.sum("n").alias("n"), F.grouping_id().alias("g"))
    s = F.sum("n") / 3
    h = sets.groupBy("g").agg(F.sum("n").alias("s"), F.sum(F.col("n") * F.log("n")).alias("k")).withColumn("h", F.log("s") - F.col("k") / F.col("s"))
    return h.agg(F.round(F.sum(F.when(F.col("g") > 0, F.col("h"))) / F.max(F.when(F.col("g") == 0, F.col("h"))), 6).alias("nmi"))


@query("WITH f AS (SELECT * FROM (SELECT user_id, value, event_id, ntile(5) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS block FROM events)) SELECT user_id, CAST(block AS INT) AS block, count(*) AS n, min(event_id) AS first_id FROM f GROUP BY 1,2")
def block_strata(spark, d):
    from pyspark.sql.window import Window

    f = table(spark, d, "events").withColumn("block", F.ntile(5).over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    return f.groupBy("user_id", "block").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


# ---- rules and scalars


@query("""SELECT p_partkey, CASE WHEN p_size <= 5 THEN 0 WHEN p_type LIKE '%BRASS' THEN 255 WHEN p_retailprice > 1500 THEN 2 WHEN p_size > 40 THEN 3 ELSE 255 END AS label FROM part""")
def first_match_rules(spark, d):
    return table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") <= 5, 0).when(F.col("p_type").endswith("BRASS"), 255).when(F.col("p_retailprice") > 1500, 2).when(F.col("p_size") > 40, 3).otherwise(255).alias("label"))


@query("""WITH q AS (SELECT c_custkey, c_acctbal >= 0 AS a, c_mktsegment <> 'MACHINERY' AS b, c_nationkey < 20 AS c FROM customer) SELECT c_custkey, CASE WHEN a AND b AND c THEN 'clean' WHEN a AND b THEN 'unverified' WHEN a THEN 'usable' ELSE 'reject' END AS cls, concat_ws(',', CASE WHEN NOT a THEN 'balance' END, CASE WHEN NOT b THEN 'segment' END, CASE WHEN NOT c THEN 'nation' END) AS reasons FROM q""")
def quality_class(spark, d):
    q = table(spark, d, "customer").select("c_custkey", (F.col("c_acctbal") >= 0).alias("a"), (F.col("c_mktsegment") != "MACHINERY").alias("b"), (F.col("c_nationkey") < 20).alias("c"))
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    return q.select("c_custkey", F.when(a & b & c, "clean").when(a & b, "unverified").when(a, "usable").otherwise("reject").alias("cls"), F.concat_ws(",", F.when(~a, "balance"), F.when(~b, "segment"), F.when(~c, "nation")).alias("reasons"))


@query(f"""WITH {PT}, a AS (SELECT vec_id, 180.0 - degrees(atan2(y,x)) AS q, degrees(atan2(z, sqrt(x*x+y*y))) AS el, sqrt(x*x+y*y+z*z) AS r FROM p) SELECT vec_id, round((q-floor(q/360.0)*360.0)/360.0*8000,4)+0.0 AS u, round((90.0-el)/180.0*4000,4)+0.0 AS v, round(r,4)+0.0 AS r FROM a""")
def pano_projection(spark, d):
    p = S.panorama(F.col("x"), F.col("y"), F.col("z"))
    return spatial_points(spark, d).select("vec_id", r(p["u"]).alias("u"), r(p["v"]).alias("v"), r(p["r"]).alias("r"))


@query(f"WITH {PT} SELECT vec_id, round(x/sqrt(x*x+y*y+z*z),4)+0.0 AS x, round(y/sqrt(x*x+y*y+z*z),4)+0.0 AS y, round(z/sqrt(x*x+y*y+z*z),4)+0.0 AS z FROM p")
def pano_rays(spark, d):
    p = S.panorama(F.col("x"), F.col("y"), F.col("z"))
    q = spatial_points(spark, d).select("vec_id", p["u"].alias("u"), p["v"].alias("v"))
    return q.select("vec_id", *[r(c).alias(k) for k, c in S.ray(F.col("u"), F.col("v")).items()])


LAB = """c AS (SELECT p_partkey, (p_size*5)%256 AS r, (p_size*11)%256 AS g, (p_partkey%256)::INT AS b FROM part), l AS (SELECT *, CASE WHEN r/255.0<=0.04045 THEN r/255.0/12.92 ELSE pow((r/255.0+0.055)/1.055,2.4) END AS lr, CASE WHEN g/255.0<=0.04045 THEN g/255.0/12.92 ELSE pow((g/255.0+0.055)/1.055,2.4) END AS lg, CASE WHEN b/255.0<=0.04045 THEN b/255.0/12.92 ELSE pow((b/255.0+0.055)/1.055,2.4) END AS lb FROM c)"""


@query(f"WITH {LAB} SELECT p_partkey, round(lr,6)+0.0 AS lr, round(lg,6)+0.0 AS lg, round(lb,6)+0.0 AS lb FROM l")
def srgb_linear(spark, d):
    c = table(spark, d, "part").select("p_partkey", (F.col("p_size") * 5 % 256).alias("r"), (F.col("p_size") * 11 % 256).alias("g"), (F.col("p_partkey") % 256).alias("b"))
    return c.select("p_partkey", *[r(S.to_linear(F.col(k)), 6).alias("l" + k) for k in "rgb"])


@query(f"""WITH {LAB}, x AS (SELECT p_partkey, (0.4124564*lr+0.3575761*lg+0.1804375*lb)/0.95047 AS x, 0.2126729*lr+0.7151522*lg+0.0721750*lb AS y, (0.0193339*lr+0.1191920*lg+0.9503041*lb)/1.08883 AS z FROM l), f AS (SELECT p_partkey, CASE WHEN x>216.0/24389.0 THEN pow(x,1.0/3.0) ELSE (24389.0/27.0*x+16.0)/116.0 END AS fx, CASE WHEN y>216.0/24389.0 THEN pow(y,1.0/3.0) ELSE (24389.0/27.0*y+16.0)/116.0 END AS fy, CASE WHEN z>216.0/24389.0 THEN pow(z,1.0/3.0) ELSE (24389.0/27.0*z+16.0)/116.0 END AS fz FROM x)
SELECT p_partkey, round(sqrt(pow(116.0*fy-16.0-50.0,2)+pow(500.0*(fx-fy),2)+pow(200.0*(fy-fz),2)),3)+0.0 AS de FROM f""")
def cie76(spark, d):
    c = table(spark, d, "part").select("p_partkey", (F.col("p_size") * 5 % 256).alias("r"), (F.col("p_size") * 11 % 256).alias("g"), (F.col("p_partkey") % 256).alias("b"))
    return c.select("p_partkey", r(S.cie76(S.lab(F.col("r"), F.col("g"), F.col("b")), (F.lit(50.0), F.lit(0.0), F.lit(0.0))), 3).alias("de"))


@query("WITH q AS (SELECT event_id, value - 300.0 + 180.0 AS q FROM events) SELECT event_id, round(abs(q - floor(q/360.0)*360.0 - 180.0),4)+0.0 AS diff FROM q")
def circular_residual(spark, d):
    return table(spark, d, "events").select("event_id", r(S.circular(F.col("value"), F.lit(300.0))).alias("diff"))


@query(f"WITH {PT} SELECT vec_id, CAST(least(greatest(round_even(abs(z)*1000,0),1),65535) AS INT) AS mm, round(1/(1+(abs(z)/8.0)*(abs(z)/8.0)),6) AS score FROM p")
def depth_encoding(spark, d):
    return spatial_points(spark, d).select("vec_id", S.depth_mm(F.abs("z")).alias("mm"), F.round(S.distance_score(F.abs("z")), 6).alias("score"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_field(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


# ---- raster neighbourhood

AROUND = "SELECT a.i, a.j, {f} AS value FROM c a JOIN c b ON abs(a.i-b.i)<=1 AND abs(a.j-b.j)<=1 GROUP BY 1,2"


ZW, ZH = 72, 36
ZB = f"""WITH {PT}, az AS (SELECT vec_id, z, 180.0-degrees(atan2(y,x)) AS q, degrees(atan2(z,sqrt(x*x+y*y))) AS el, sqrt(x*x+y*y+z*z) AS r FROM p), uv AS (SELECT vec_id, r, CAST(trunc((q-360.0*floor(q/360.0))/360.0*{ZW}) AS BIGINT)%{ZW} AS j, least(greatest(CAST(trunc((90.0-el)/180.0*{ZH}) AS BIGINT),0),{ZH - 1}) AS i FROM az), c AS (SELECT i, j, min(r) AS value FROM uv GROUP BY 1,2),
g AS (SELECT a AS i, b AS j FROM range({ZH}) t(a), range({ZW}) s(b)), d3 AS (SELECT a AS di, b AS dj FROM (VALUES (-1),(0),(1)) t(a), (VALUES (-1),(0),(1)) s(b)),
nb AS (SELECT g.i, g.j, coalesce(c.value,1e6) AS value FROM g, d3 LEFT JOIN c ON c.i=g.i+di AND c.j=(g.j+dj+{ZW})%{ZW} WHERE g.i+di BETWEEN 0 AND {ZH - 1}), ero AS (SELECT i, j, min(value) AS value FROM nb GROUP BY 1,2), dil AS (SELECT g.i, g.j, max(e.value) AS value FROM g, d3 JOIN ero e ON e.i=g.i+di AND e.j=(g.j+dj+{ZW})%{ZW} GROUP BY 1,2),
cl AS (SELECT dil.i, dil.j, least(dil.value, coalesce(c.value,1e6)) AS value FROM dil LEFT JOIN c USING (i,j)), cd AS (SELECT * FROM cl WHERE value < 1e6), sp AS (SELECT g.i, g.j, max(cd.value)-min(cd.value) AS spread FROM g, d3 JOIN cd ON cd.i=g.i+di AND cd.j=(g.j+dj+{ZW})%{ZW} GROUP BY 1,2)"""


def _seen(spark, d):
    """Points with range and cell of a small panorama."""
    p = spatial_points(spark, d)
    at = S.panorama(F.col("x"), F.col("y"), F.col("z"), ZW, ZH)
    row, column = S.cell_of(at["u"], at["v"], ZW, ZH)
    return p.select("vec_id", at["r"].alias("r"), row.alias("i"), column.alias("j"))


def _depth(spark, d):
    return _seen(spark, d).groupBy("i", "j").agg(F.min("r").alias("value"))


@query(f"{ZB} SELECT i, j, round(value,4)+0.0 AS value FROM cd")
def closed_depth(spark, d):
    return R.closed_depth(_depth(spark, d), ZW, ZH).select("i", "j", r("value").alias("value"))


@query(f"{ZB} SELECT i, j, round(spread,4)+0.0 AS value FROM sp")
def range_spread(spark, d):
    return R.range_spread(R.closed_depth(_depth(spark, d), ZW, ZH), ZW, ZH).select("i", "j", r("value").alias("value"))


@query(f"{ZB}, s AS (SELECT i, j, value, unnest(range(-2,3)) AS di FROM c), q AS (SELECT *, unnest(range(-2,3)) AS dj FROM s) SELECT i+di AS i, (j+dj+{ZW})%{ZW} AS j, round(arg_min(value, (di*di+dj*dj, -di, -dj)),4)+0.0 AS value FROM q WHERE di*di+dj*dj <= 4 AND i+di BETWEEN 0 AND {ZH - 1} GROUP BY 1,2")
def hole_fill(spark, d):
    return R.filled(_depth(spark, d), 2, ZW, ZH).select("i", "j", r("value").alias("value"))


@query(f"{CELLS} SELECT a.i, a.j, round(max(abs(a.value-b.value)),4)+0.0 AS value FROM c a JOIN c b ON abs(a.i-b.i)+abs(a.j-b.j)=1 GROUP BY 1,2")
def curb_jump(spark, d):
    return R.largest_jump(_cells(spark, d)).select("i", "j", r("value").alias("value"))


@query(f"{ZB}, el AS (SELECT vec_id, r, i, j, abs(radians(90.0-(i+0.5)/{ZH}*180.0)) AS el FROM uv) SELECT vec_id, value IS NOT NULL AND r <= value + greatest(0.15, 0.03*r, least(coalesce(spread,0),2.0), least(0.12/greatest(sin(el),0.05),2.0)) AS visible FROM el LEFT JOIN cd USING (i,j) LEFT JOIN sp USING (i,j)")
def visibility_join(spark, d):
    """Which points the closed depth of their cell does not hide."""
    closed = R.closed_depth(_depth(spark, d), ZW, ZH)
    around = closed.join(R.range_spread(closed, ZW, ZH).withColumnRenamed("value", "spread"), ["i", "j"], "left")
    seen = _seen(spark, d).join(around, ["i", "j"], "left")
    return seen.select("vec_id", S.visible(F.col("r"), F.col("value"), F.col("spread"), F.col("i"), ZH).alias("visible"))


# ---- graph and clustering

VOX = f"""WITH RECURSIVE {PT}, q AS (SELECT vec_id, CAST(floor(x/4) AS BIGINT) AS i, CAST(floor(y/4) AS BIGINT) AS j, CAST(floor(z/4) AS BIGINT) AS k FROM p), n AS (SELECT i,j,k,min(vec_id) AS node FROM q GROUP BY 1,2,3), ed AS (SELECT a.node AS a, b.node AS b FROM n a JOIN n b ON (a.i-b.i)*(a.i-b.i)+(a.j-b.j)*(a.j-b.j)+(a.k-b.k)*(a.k-b.k) <= 2),
w AS (SELECT node AS node, node AS c FROM n UNION SELECT ed.b, w.c FROM w JOIN ed ON ed.a=w.node), l AS (SELECT node, min(c) AS cluster FROM w GROUP BY 1), v AS (SELECT vec_id, cluster FROM q JOIN n USING (i,j,k) JOIN l USING (node))"""


@query(f"{VOX} SELECT vec_id, cluster FROM v")
def voxel_components(spark, d):
    return G.voxel_clusters(spatial_points(spark, d), "vec_id", 4.0, 6.0)


@query(f"{VOX}, s AS (SELECT cluster, count(*) AS n FROM v GROUP BY 1 HAVING count(*) >= 3) SELECT cluster, n, row_number() OVER (ORDER BY n DESC, cluster) - 1 AS rank FROM s")
def cluster_size_rank(spark, d):
    sizes = G.voxel_clusters(spatial_points(spark, d), "vec_id", 4.0, 6.0).groupBy("cluster").agg(F.count("*").alias("n")).where("n >= 3")
    ranked = sampling.ranked(sizes.withColumn("minus", -F.col("n")), ["minus", "cluster"])
    return ranked.select("cluster", "n", F.col("rank").cast("bigint").alias("rank"))


# ---- estimators


@query(f"WITH {PT} SELECT label, round(regr_slope(y, x),6)+0.0 AS slope, round(regr_intercept(y, x),6)+0.0 AS intercept, round(regr_r2(y, x),6)+0.0 AS r2 FROM p GROUP BY 1")
def linear_fit(spark, d):
    return spatial_points(spark, d).groupBy("label").agg(r(F.regr_slope("y", "x"), 6).alias("slope"), r(F.regr_intercept("y", "x"), 6).alias("intercept"), r(F.regr_r2("y", "x"), 6).alias("r2"))


@query(f"""WITH {PT}, g AS (SELECT unnest(range(-5,6)) AS o), s AS (SELECT label, o, quantile_cont(abs(x+o*0.5),0.5) AS m FROM p, g GROUP BY 1,2) SELECT label, arg_min(o, (round(m,6), o)) AS o FROM s GROUP BY 1""")
def offset_grid_search(spark, d):
    g = spatial_points(spark, d).select("label", "x", F.explode(F.sequence(F.lit(-5).cast("bigint"), F.lit(5).cast("bigint"))).alias("o"))
    s = g.groupBy("label", "o").agg(F.percentile(F.abs(F.col("x") + F.col("o") * 0.5), F.lit(0.5)).alias("m"))
    return s.groupBy("label").agg(F.min_by("o", F.struct(F.round("m", 6), "o")).alias("o"))


# ---- incremental


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def resume_antijoin(spark, d):
    done = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, d, "orders").select("o_orderkey").join(done, "o_orderkey", "left_anti")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_frame_asof(spark, sf_dir)


def _load() -> None:
    """Imports the modules that register further queries."""
    from tidemark.plans import cluster_queries, frame_queries, geometry_queries, merge_queries, pose_queries, report_queries, source_queries, store_queries, survey_queries  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLES)
