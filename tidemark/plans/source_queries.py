"""Queries that write and read back artifacts, files and stages, and fits with a known result, with oracle SQL."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.operators import areas, fits
from tidemark.operators import frames as P
from tidemark.operators.graph import folder
from tidemark.plans import cluster_queries, frame_queries, pose_queries, report_queries
from tidemark.plans.registry import EV, PTS, query, r
from tidemark.sources import artifacts, stages
from tidemark.sources.tables import frames, scan_points, table


@query(f"{frame_queries.PRODUCT} SELECT frame, i, j, depth_mm, point FROM prod")
def stored_products(spark, d):
    """Frame products written under their pose table's hash and read back with the guard."""
    f = frames(spark, d)
    meta = {"poses_hash": artifacts.pose_hash(f), "rig_hash": artifacts.rig_hash((0.0, 0.0, 0.0), (0.0, 0.0, 0.0), 0.0)}
    path = artifacts.folder(folder(spark), "frames", "corrected", meta["poses_hash"])
    artifacts.save(P.products(scan_points(spark, d), f, frame_queries.ZW, frame_queries.ZH, frame_queries.SPACING), path, meta, "frame")
    return artifacts.load(spark, path, meta).select(F.col("frame").cast("long").alias("frame"), "i", "j", "depth_mm", "point")


@query(f"WITH {pose_queries.EP} SELECT frame, round(t,6) AS t, round(e,6)+0.0 AS e, round(yaw,6)+0.0 AS yaw, pass_id FROM ep")
def stored_poses(spark, d):
    """A pose table written as CSV with its provenance and read back by column names."""
    p, path = pose_queries._poses(spark, d).drop("user_id", "event_id"), folder(spark)
    name = artifacts.write_pose_table(p, path, {"stage": "events"})
    back, provenance = artifacts.read_pose_table(spark, path, "frame long, t double, e double, n double, h double, yaw double, roll double, pitch double, pass_id long")
    if provenance["poses_hash"] != name:
        raise artifacts.StaleArtifact(path)
    return back.select("frame", F.round("t", 6).alias("t"), r("e", 6).alias("e"), r("yaw", 6).alias("yaw"), "pass_id")


@query(f"{report_queries.STR} SELECT family, bin, 2*count(*) AS n FROM (SELECT 'class' AS family, bin FROM si WHERE ok UNION ALL SELECT 'psid', bin FROM si WHERE ok) GROUP BY 1,2")
def merged_runs(spark, d):
    """Histograms of two runs added up over their strata."""
    counts = report_queries.eight_strata(spark, d).where("family in ('class', 'psid')")
    root = folder(spark)
    for k in (0, 1):
        artifacts.save(counts, f"{root}/run{k}", {"run": k})
    return artifacts.merged_histograms(spark, [f"{root}/run{k}" for k in (0, 1)], ["family", "bin"])


@query(f"WITH {cluster_queries.FACE} SELECT face, 400.0 AS area, x0, y0 FROM fc")
def stored_faces(spark, d):
    """Faces as lines of GeoJSON and back."""
    path = folder(spark)
    artifacts.write_features(cluster_queries._faces(spark), path, properties=("face",))
    back = artifacts.read_features(spark, path, "face: bigint")
    return back.select("face", areas.area(F.col("ring")).alias("area"), F.array_min(F.transform("ring", lambda v: v["x"])).alias("x0"), F.array_min(F.transform("ring", lambda v: v["y"])).alias("y0"))


@query(f"{report_queries.CLASSED} SELECT frame, cls, round(du,3)+0.0 AS du, round(speed,3)+0.0 AS speed FROM cl")
def stored_quality(spark, d):
    """A quality file with missing numbers as text, read back with nulls."""
    path = folder(spark)
    q = report_queries._classed(spark, d)
    q.select("frame", "cls", F.coalesce(F.col("du").cast("string"), F.lit("nan")).alias("du"), "speed").write.csv(path, header=True)
    return artifacts.read_quality(spark, path).select("frame", "cls", r("du", 3).alias("du"), r("speed", 3).alias("speed"))


SPEC = "s AS (SELECT o_orderkey AS frame, o_orderkey%4=0 AS clean, o_orderkey%6=0 AS done FROM orders)"


@query(f"WITH {SPEC} SELECT 'clean' AS spec, frame FROM s WHERE clean UNION ALL SELECT 'missing:clean', frame FROM s WHERE clean AND NOT done UNION ALL SELECT '3,7,2000000000', frame FROM s WHERE frame IN (3,7)")
def frame_specs(spark, d):
    """Frames named by expressions."""
    s = table(spark, d, "orders").select(F.col("o_orderkey").alias("frame"))
    clean, done, out = s.where("frame % 4 = 0"), s.where("frame % 6 = 0"), None
    for spec in ("clean", "missing:clean", "3,7,2000000000"):
        part = artifacts.frames_of(spec, clean, s, done).select(F.lit(spec).alias("spec"), "frame")
        out = part if out is None else out.union(part)
    return out


@query("SELECT o_orderkey, CAST(CASE WHEN o_orderkey%3=0 THEN NULL ELSE o_orderkey%2=0 END AS INT) AS bad FROM orders")
def three_valued_flags(spark, d):
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select("o_orderkey", artifacts.flag(F.when(k % 3 != 0, (k % 2 == 0).cast("int"))).cast("int").alias("bad"))


@query("SELECT * FROM (VALUES ('first', true, 25::BIGINT), ('again', false, 25), ('changed', true, 25)) t(run, made, n)")
def resumed_stages(spark, d):
    """A stage is made once for the same inputs, and again when they change."""
    root, out = folder(spark), []
    make = lambda: table(spark, d, "nation")
    for run, inputs in (("first", {"a": 1}), ("again", {"a": 1}), ("changed", {"a": 2})):
        rows, made = stages.run_stage(spark, root, "nations", inputs, make)
        out.append((run, made, rows.count()))
    return spark.createDataFrame(out, "run string, made boolean, n long")


@query(f"WITH {PTS} SELECT -1.0::DOUBLE AS yaw, count(*) AS pairs, true AS placed FROM pt")
def alignment(spark, d):
    """Turn and shift that lay a moved copy of the points on them again: the known ones come back."""
    p = scan_points(spark, d).select("id", "x", "y", "z")
    c, s = F.cos(F.radians(F.lit(1.0))), F.sin(F.radians(F.lit(1.0)))
    moved = p.select("id", (c * F.col("x") - s * F.col("y") + 0.03).alias("x"), (s * F.col("x") + c * F.col("y") - 0.02).alias("y"), (F.col("z") + 0.1).alias("z"))
    found = fits.aligned(moved, p.select(F.col("id").alias("rid"), F.col("x").alias("cx"), F.col("y").alias("cy"), F.col("z").alias("cz")), 3.0, rounds=40)
    placed = abs(found["dz"] + 0.1) < 1e-3 and abs(found["dx"]) < 0.05 and abs(found["dy"]) < 0.05
    return spark.createDataFrame([(round(found["yaw"], 3), found["pairs"], placed)], "yaw double, pairs long, placed boolean")


@query("SELECT o_custkey AS pass_id, round(0.01*(o_custkey%50),6)+0.0 AS shift FROM orders GROUP BY 1,2")
def pass_graph(spark, d):
    """Shifts of all passes from differences of pairs and one fixed pass, by least squares over a chain and its shortcuts."""
    from pyspark.sql.window import Window

    k = table(spark, d, "orders").select(F.col("o_custkey").alias("a")).distinct()
    w = Window.orderBy("a")
    shift = lambda c: F.col(c) % 50 * 0.01
    chain = k.select("a", *[F.lead("a", step).over(w).alias(f"b{step}") for step in (1, 3)])
    pairs = chain.select("a", F.explode(F.array("b1", "b3")).alias("b")).where("b is not null").select("a", "b", (shift("b") - shift("a")).alias("d"), F.lit(1.0).alias("w"))
    first = k.agg(F.min("a").alias("a")).select("a", shift("a").alias("d"), F.lit(1.0).alias("w"))
    found = fits.solved_graph(pairs, first)
    return spark.createDataFrame(pa.table({"pass_id": pa.array(list(found), pa.int64()), "shift": pa.array([round(v, 6) + 0.0 for v in found.values()], pa.float64())}))


@query(f"WITH {EV} SELECT event_type, count(*) AS n, 0.0 AS c0, 0.0 AS c1, 0.0 AS s1, 0.0 AS c2, 0.0 AS s2 FROM e GROUP BY 1")
def fourier_fit(spark, d):
    """A harmonic fit by its defining property: what it leaves is orthogonal to each of its five waves."""
    e = table(spark, d, "events").select("event_type", "value", (F.hour(F.col("ts").cast("timestamp")) * 15.0).alias("angle"))
    f = fits.fourier(e, "angle", "value", ["event_type"]).select("event_type", "coefficients")
    waves = {"c0": F.lit(1.0), **{f"{n}{k}": g(F.radians(F.col("angle") * k)) for k in (1, 2) for n, g in (("c", F.cos), ("s", F.sin))}}
    both = e.join(F.broadcast(f), "event_type").withColumns(waves)
    left = F.col("value") - sum((F.col("coefficients")[i] * F.col(c) for i, c in enumerate(waves)), F.lit(0.0))
    rest = both.withColumn("rest", left).groupBy("event_type").agg(F.count("*").alias("n"), *[(F.sum(F.col("rest") * F.col(c)) / F.count("*")).alias(c) for c in waves])
    return rest.select("event_type", "n", *[r(c, 5).alias(c) for c in waves])
