"""Queries that merge products row by row and check what was written, with oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import merging as M
from tidemark.plans.registry import PTS, query, r
from tidemark.sources.tables import scan_points

ALL = f"""WITH {PTS}, col AS (SELECT id, (id*41)%256 AS fr, (id*43)%256 AS fg, (id*47)%256 AS fb, id%4 AS views, (id*5)%256 AS conf, (id%50)*0.1::DOUBLE AS de FROM pt WHERE tile%2=0), lab AS (SELECT id, CASE WHEN id%5=0 THEN 255 ELSE cls END AS label, (id*11)%256 AS lconf FROM pt), clu AS (SELECT id, id%6-1 AS cluster, (id%100)*0.1::DOUBLE AS hag, id%4 AS obj FROM pt WHERE tile%3<>0)"""
ROW = "CASE WHEN coalesce(views,0)=0 THEN pt.r ELSE fr END AS red, CASE WHEN coalesce(views,0)=0 THEN pt.g ELSE fg END AS green, coalesce(views,0) AS views, coalesce(conf,0) AS conf, de, label, lconf, coalesce(cluster,-1) AS cluster, coalesce(obj,0) AS obj, coalesce(hag,0.0) AS hag"


def _inputs(spark, d):
    p, i = scan_points(spark, d), F.col("id")
    colours = p.where("tile % 2 = 0").select("id", (i * 41 % 256).alias("fr"), (i * 43 % 256).alias("fg"), (i * 47 % 256).alias("fb"), (i % 4).alias("views"), (i * 5 % 256).alias("conf"), (i % 50 * 0.1).alias("de"))
    labels = p.select("id", F.when(i % 5 == 0, 255).otherwise(F.col("cls")).alias("label"), (i * 11 % 256).alias("lconf"))
    objects = p.where("tile % 3 <> 0").select("id", (i % 6 - 1).alias("cluster"), (i % 100 * 0.1).alias("hag"), (i % 4).alias("obj"))
    return p, colours, labels, objects


def _merged(spark, d):
    p, colours, labels, objects = _inputs(spark, d)
    return M.consolidated(p, colours, labels, objects)


@query(f"{ALL} SELECT pt.id, pt.tile, {ROW} FROM pt LEFT JOIN col USING (id) JOIN lab USING (id) LEFT JOIN clu USING (id)")
def consolidated_points(spark, d):
    """One product of colours, labels and objects; each input has its own rule for rows it lacks."""
    return _merged(spark, d).select("id", "tile", F.col("r").alias("red"), F.col("g").alias("green"), "views", "conf", "de", "label", "lconf", "cluster", "obj", "hag")


@query(f"{ALL}, m AS (SELECT pt.tile, {ROW} FROM pt LEFT JOIN col USING (id) JOIN lab USING (id) LEFT JOIN clu USING (id)) SELECT tile, count(*) AS n, count(*) FILTER (label=255) AS unlabelled, count(*) FILTER (cluster >= 0) AS clustered, count(DISTINCT cluster) FILTER (cluster >= 0) AS clusters, round(quantile_cont(CASE WHEN views > 0 THEN de END,0.5),4) AS de_median FROM m GROUP BY 1")
def consolidated_summary(spark, d):
    m = _merged(spark, d)
    own = F.when(F.col("cluster") >= 0, F.col("cluster"))
    return m.groupBy("tile").agg(F.count("*").alias("n"), F.count_if(F.col("label") == 255).alias("unlabelled"), F.count(own).alias("clustered"), F.countDistinct(own).alias("clusters"), F.round(F.percentile(F.when(F.col("views") > 0, F.col("de")), F.lit(0.5)), 4).alias("de_median"))


@query(f"{ALL}, o AS (SELECT id, x+0.002*(id%3) AS ox, y AS oy, z-0.001 AS oz, CASE WHEN id%250=0 THEN 9 ELSE cls END AS oc, pt.* EXCLUDE (id) FROM pt) SELECT tile, count(*) AS n, bool_and(ox=x AND oy=y AND oz=z) AS xyz_exact, bool_and(oc=cls) AS class_exact, round(quantile_cont(1000*sqrt(pow(ox-x,2)+pow(oy-y,2)+pow(oz-z,2)),0.5),3) AS shift_median_mm, round(max(1000*sqrt(pow(ox-x,2)+pow(oy-y,2)+pow(oz-z,2))),3) AS shift_max_mm, count(*) FILTER (1000*sqrt(pow(ox-x,2)+pow(oy-y,2)+pow(oz-z,2)) > 3) AS moved FROM o GROUP BY 1")
def written_check(spark, d):
    """What was written against its source by point: exact places and classes, and how far places moved."""
    p = scan_points(spark, d)
    out = p.select("tile", "id", (F.col("x") + 0.002 * (F.col("id") % 3)).alias("x"), "y", (F.col("z") - 0.001).alias("z"), F.when(F.col("id") % 250 == 0, 9).otherwise(F.col("cls")).alias("cls"))
    v = M.verified(p, out, ["tile", "id"], "tile", 3.0)
    return v.select("tile", "n", "xyz_exact", "class_exact", F.round("shift_median_mm", 3).alias("shift_median_mm"), F.round("shift_max_mm", 3).alias("shift_max_mm"), "moved")


@query(f"WITH {PTS}, o AS (SELECT id+CASE WHEN id%100=0 THEN 1000000 ELSE 0 END AS id, tile, x+CASE WHEN id%60=0 THEN 0.5 ELSE 0 END AS x FROM pt) SELECT pt.tile, count(*) AS n, count(*) FILTER (o.id IS NULL) AS missing, count(*) FILTER (o.id IS NOT NULL AND o.x<>pt.x) AS differing FROM pt LEFT JOIN o USING (tile, id) GROUP BY 1")
def identity_check(spark, d):
    """Rows of a product that the store has and the product lacks or has elsewhere."""
    p, i = scan_points(spark, d).select("tile", "id", "x"), F.col("id")
    other = p.select("tile", (i + F.when(i % 100 == 0, 1_000_000).otherwise(0)).alias("id"), (F.col("x") + F.when(i % 60 == 0, 0.5).otherwise(0.0)).alias("x"))
    return M.identity(p, other, ["tile", "id"], ["x"], "tile")


@query(f"WITH {PTS}, s AS (SELECT tile, id, row_number() OVER (PARTITION BY tile ORDER BY id DESC)-1 AS source_index, cls FROM pt) SELECT tile, id, source_index, cls FROM s")
def source_order(spark, d):
    """Values of a file in its own order, carried to the store's rows by source index."""
    from pyspark.sql.window import Window

    w = Window.partitionBy("tile").orderBy(F.desc("id"))
    p = scan_points(spark, d).withColumn("source_index", (F.row_number().over(w) - 1).cast("long"))
    values = p.select("tile", "source_index", F.col("cls").alias("value"))
    return p.select("tile", "id", "source_index").join(values, ["tile", "source_index"]).select("tile", "id", "source_index", F.col("value").alias("cls"))


@query(f"WITH {PTS} SELECT id, r*256 AS red, g*256 AS green, b*256 AS blue, round(x+0.1,4)+0.0 AS x FROM pt")
def vendor_colours(spark, d):
    """The source's own colours as 16-bit values at registered places."""
    p = scan_points(spark, d)
    return p.select("id", *[(F.col(c) * 256).alias(n) for c, n in (("r", "red"), ("g", "green"), ("b", "blue"))], r(F.col("x") + 0.1).alias("x"))
