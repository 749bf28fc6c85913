"""Times the headline queries, and some of them on ten copies of their tables; prints one JSON line."""

from __future__ import annotations

import json
import os
import shutil
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import catalogue

HEADLINE = [
    "gap_sessions", "nearest_frame_asof", "linear_interpolation", "grid_range_join", "overlap_pairs", "row_identity_merge", "top_k_samples", "robust_median", "weighted_vote",
    "strata_histograms", "histogram_quantile", "closed_depth", "visibility_join", "voxel_components", "offset_grid_search", "frame_products", "consolidated_points",
]
#: Queries over line items whose cost should grow with the rows, and the copies they run on.
GROWING, COPIES = ["row_identity_merge", "robust_median", "weighted_vote", "strata_histograms"], 10
KEYS = {"lineitem": ["l_orderkey", "l_partkey"], "orders": ["o_orderkey"], "part": ["p_partkey"]}


def copied(spark: SparkSession, sf_dir: str, target: str) -> int:
    """Writes the tables of ``GROWING`` with every key in ``COPIES`` versions; returns the line items."""
    for name, keys in KEYS.items():
        df: DataFrame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        each = df.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
        each.withColumns({k: F.col(k) * COPIES + F.col("_k") for k in keys}).drop("_k").write.parquet(f"{target}/{name}.parquet")
    return spark.read.parquet(f"{target}/lineitem.parquet").count()


def timed(run) -> float:
    began = time.time()
    run().write.format("noop").mode("overwrite").save()
    return round(time.time() - began, 3)


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalogue.queries()
    timed(lambda: queries[HEADLINE[0]](spark, sf_dir))  # compiles and warms up
    took = {n: timed(lambda n=n: queries[n](spark, sf_dir)) for n in HEADLINE}
    target = tempfile.mkdtemp(prefix="bench-")
    try:
        rows = copied(spark, sf_dir, target)
        large = {n: timed(lambda n=n: queries[n](spark, target)) for n in GROWING}
    finally:
        shutil.rmtree(target, ignore_errors=True)
    line = {
        "metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "copies": {"rows": rows, "queries": large, "rows_per_second": {n: round(rows / s) for n, s in large.items()}},
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
