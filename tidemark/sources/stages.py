"""Stages with markers: a stage is done if its marker has the same inputs' hash and a good end."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MARKER = "name string, inputs_hash string, ok boolean, metrics string"


def inputs_hash(inputs: dict) -> str:
    """SHA-256 of the settings that a stage depends on, whatever their order."""
    return hashlib.sha256(json.dumps(inputs, sort_keys=True, default=str).encode()).hexdigest()


def marker(spark: SparkSession, root: str, name: str) -> dict | None:
    """The stage's marker by Spark's reader, so that ``root`` may lie in any store."""
    from pyspark.errors import AnalysisException

    try:
        row = spark.read.schema(MARKER).json(f"{root}/{name}/marker").first()
    except AnalysisException:
        return None
    return row and row.asDict()


def is_done(spark: SparkSession, root: str, name: str, inputs: dict) -> bool:
    found = marker(spark, root, name)
    return bool(found and found["ok"] and found["inputs_hash"] == inputs_hash(inputs))


def run_stage(spark: SparkSession, root: str, name: str, inputs: dict, make: Callable[[], DataFrame], force: bool = False) -> tuple[DataFrame, bool]:
    """(table, whether it was made now): the stage's table, made and marked unless that has been done with these inputs."""
    path = f"{root}/{name}/table"
    if not force and is_done(spark, root, name, inputs):
        return spark.read.parquet(path), False
    frame = make()
    frame.write.mode("overwrite").parquet(path)
    row = (name, inputs_hash(inputs), True, json.dumps({"columns": frame.columns}))
    spark.createDataFrame([row], MARKER).coalesce(1).write.mode("overwrite").json(f"{root}/{name}/marker")
    return spark.read.parquet(path), True


def select_stages(order: list[str], only: list[str] | None = None, first: str | None = None, last: str | None = None) -> list[str]:
    """The chosen stages in their order: a subset, or those from ``first`` to ``last``."""
    unknown = [s for s in [*(only or []), first, last] if s is not None and s not in order]
    if unknown:
        raise ValueError(f"no such stage: {unknown}")
    lo, hi = order.index(first) if first else 0, order.index(last) + 1 if last else len(order)
    return [s for s in order[lo:hi] if not only or s in only]
