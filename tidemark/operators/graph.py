"""Connected components and voxel clustering."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_temporary: str | None = None


def folder(spark: SparkSession) -> str:
    """A new folder's name in the session's ``spark.checkpoint.dir``; in local mode in a temporary folder where that is unset."""
    global _temporary
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        named = _temporary = _temporary or tempfile.mkdtemp(prefix="tidemark-")
    return f"{named}/tidemark-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to a folder that all machines share, and read again."""
    path = folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component): the least node that each reaches over ``edges`` (a, b).

    A round sends nodes to their least neighbour and contracts the edges.
    """
    left, steps = cut(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()), []
    while not left.isEmpty():
        both = left.select(F.col("a").alias("node"), F.col("b").alias("other")).union(left.select("b", "a"))
        step = cut(both.groupBy("node").agg(F.least("node", F.min("other")).alias("to")))
        steps.append(step)
        u, v = step.select(F.col("node").alias("a"), F.col("to").alias("u")), step.select(F.col("node").alias("b"), F.col("to").alias("v"))
        left = cut(left.join(u, "a").join(v, "b").where("u <> v").select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct())
    out = nodes.select("node").distinct().withColumn("component", F.col("node"))
    for step in steps:
        out = out.join(step.withColumnRenamed("node", "component"), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return out


def voxel_clusters(points: DataFrame, id_: str, voxel: float, eps: float) -> DataFrame:
    """(id, cluster): components of occupied voxels whose centres lie within ``eps``; a cluster's name is its least id."""
    cell = {k: F.floor(F.col(c) / voxel) for k, c in (("i", "x"), ("j", "y"), ("k", "z"))}
    placed = points.select(id_, *[v.alias(k) for k, v in cell.items()])
    cells = cut(placed.groupBy("i", "j", "k").agg(F.min(id_).alias("node")))
    reach = int(eps / voxel)
    span = range(-reach, reach + 1)
    ball = [(a, b, c) for a in span for b in span for c in span if (a, b, c) > (0, 0, 0) and a * a + b * b + c * c <= (eps / voxel) ** 2]
    shifts = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(c).alias("c")) for a, b, c in ball])
    moved = cells.select("*", F.explode(shifts).alias("s")).select((F.col("i") + F.col("s.a")).alias("i"), (F.col("j") + F.col("s.b")).alias("j"), (F.col("k") + F.col("s.c")).alias("k"), F.col("node").alias("a"))
    edges = moved.join(cells.withColumnRenamed("node", "b"), ["i", "j", "k"]).select("a", "b")
    named = cells.join(components(cells, edges), "node")
    return placed.join(named, ["i", "j", "k"]).select(id_, F.col("component").alias("cluster"))
