"""Deterministic selections: global ranks, evenly spaced rows, strata, proportional shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.graph import cut


def ranked(df: DataFrame, order: list[str]) -> DataFrame:
    """``rank`` (from 0) over the whole table and ``total``, without one task that sorts all: ranges are ranked apart and moved by the rows before them."""
    parts = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    placed = cut(df.repartitionByRange(int(parts), *order).withColumn("_part", F.spark_partition_id()))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    # one row a range
    every = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"), F.sum("_n").over(every).alias("total"))
    inner = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return placed.withColumn("_at", inner).join(before, "_part").withColumn("rank", F.col("_at") + F.col("_before")).drop("_part", "_at", "_before")


def evenly(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The rows at ``n`` ranks spread evenly from first to last; all if there are no more."""
    r, steps = F.col("rank"), F.col("total") - 1
    # the k-th rank is floor(k * steps / (n - 1)): the rank is taken if some k falls on it
    k = F.ceil(r * (n - 1) / F.greatest(steps, F.lit(1)))
    taken = (F.col("total") <= n) | ((k <= n - 1) & (F.floor(k * steps / (n - 1)) == r))
    return ranked(df, order).where(taken).drop("total")


def every_kth(df: DataFrame, order: list[str], k: int) -> DataFrame:
    return ranked(df, order).where(F.col("rank") % k == 0).drop("total", "rank")


def shuffled(key: str, seed: int) -> Column:
    """A text whose order is a seeded shuffle of ``key``."""
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(seed)))


def per_group(df: DataFrame, by: list[str], key: str, share: Column, seed: int) -> DataFrame:
    """``share`` rows of each group (a Column over ``_n``, its row count), by seeded shuffle."""
    w = Window.partitionBy(*by)
    marked = df.withColumn("_n", F.count("*").over(w)).withColumn("_at", F.row_number().over(w.orderBy(shuffled(key, seed), key)))
    return marked.where(F.col("_at") <= share).drop("_n", "_at")


def block_terciles(df: DataFrame, by: str, order: list[str], x: str, blocks: int = 5) -> DataFrame:
    """``block`` of each partition in order, and ``tercile`` of ``x`` within the block (both from 1)."""
    cut_ = df.withColumn("block", F.ntile(blocks).over(Window.partitionBy(by).orderBy(*order)))
    return cut_.withColumn("tercile", F.ntile(3).over(Window.partitionBy(by, "block").orderBy(x, *order)))
