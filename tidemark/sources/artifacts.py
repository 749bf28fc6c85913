"""Stored results of a pose table: products, patches, trajectories, masks, histograms, face and quality files.

An artifact is a Parquet table in a folder that the hash of its pose table names,
with a small metadata table beside it. Loading compares that metadata with what the
caller expects, so that results of another pose table or rig are never mixed in.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.graph import cut

#: The source whose results lie in the folder itself.
PLAIN = "export"
META = "kind string, key string, value string"
POSE_COLUMNS = ("t", "e", "n", "h", "roll", "pitch", "yaw")
#: Parts of a pose table's hash in the order of JSON keys, and how many pieces of one the driver reads at once.
POSE_PARTS, PIECES_AT_ONCE = ("origin", "pitch", "roll", "t", "yaw"), 32


class StaleArtifact(RuntimeError):
    """An artifact was made from other inputs than the ones asked for."""


def short_hash(payload: dict) -> str:
    """The first ten hex digits of the SHA-1 of a payload as JSON with sorted keys."""
    return hashlib.sha1(json.dumps(payload, sort_keys=True).encode()).hexdigest()[:10]


def _pose_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each batch as JSON list items, a text a part of the hash, with the batch's place in the order."""
    part = TaskContext.get().partitionId()
    for at, b in enumerate(batches):
        c = {k: b.column(i).to_pylist() for i, k in enumerate(POSE_COLUMNS)}
        rounded = lambda k, digits: [round(float(v), digits) for v in c[k]]
        lists = {"t": [repr(float(v)) for v in c["t"]], "origin": [list(v) for v in zip(*(rounded(k, 3) for k in "enh"))], **{k: rounded(k, 4) for k in ("roll", "pitch", "yaw")}}
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([at], pa.int32()), *[pa.array([json.dumps(lists[k])[1:-1]]) for k in POSE_PARTS]], names=["part", "at", *POSE_PARTS])


def pose_hash(poses: DataFrame, order: str = "frame") -> str:
    """Hash of a pose table: times as they are, places to a millimetre, angles to a ten-thousandth of a degree.

    A pose table has a row a photograph; its seven numbers are read in order. The
    tasks write the JSON text that is hashed in pieces of a batch each; the driver
    reads them part by part, a few at a time.
    """
    rows = poses.select(order, *POSE_COLUMNS).orderBy(order).select(*POSE_COLUMNS)
    texts = cut(rows.mapInArrow(_pose_texts, "part int, at int, " + ", ".join(f"{k} string" for k in POSE_PARTS)))
    few = max(1, texts.count() // PIECES_AT_ONCE)
    whole = hashlib.sha1()
    for k in POSE_PARTS:
        whole.update((("{" if k == POSE_PARTS[0] else ", ") + f'"{k}": [').encode())
        pieces = texts.where(F.length(k) > 0).select("part", "at", k).repartitionByRange(few, "part", "at").sortWithinPartitions("part", "at")
        for i, r in enumerate(pieces.toLocalIterator()):
            whole.update(((", " if i else "") + r[k]).encode())
        whole.update(b"]")
    whole.update(b"}")
    return whole.hexdigest()[:10]


def rig_hash(boresight: tuple[float, float, float], lever: tuple[float, float, float], dt: float) -> str:
    return short_hash({"R": [round(v, 6) for v in boresight], "l": [round(v, 5) for v in lever], "dt": round(dt, 6)})


def folder(root: str, kind: str, source: str = PLAIN, poses_hash: str = "") -> str:
    """Where artifacts of a kind lie: corrected sources have a folder of their own beside the plain one."""
    return f"{root}/{kind}" if source == PLAIN else f"{root}/{kind}_{poses_hash[:6]}"


def save(df: DataFrame, path: str, meta: dict[str, str], by: str | None = None) -> None:
    """Writes an artifact, partitioned by ``by``, and its metadata last: without it the artifact is not there."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(f"{path}/table")
    rows = [("meta", k, str(v)) for k, v in sorted(meta.items())]
    df.sparkSession.createDataFrame(rows, META).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def metadata(spark: SparkSession, path: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.read.parquet(f"{path}/meta").collect()}


def load(spark: SparkSession, path: str, expected: dict[str, str] | None = None, allow_stale: bool = False) -> DataFrame:
    """An artifact, if its metadata agrees with ``expected`` (or ``allow_stale``)."""
    found = metadata(spark, path)
    wrong = {k: (found.get(k), str(v)) for k, v in (expected or {}).items() if found.get(k) != str(v)}
    if wrong and not allow_stale:
        raise StaleArtifact(f"{path} was made from {wrong}")
    return spark.read.parquet(f"{path}/table")


def write_pose_table(poses: DataFrame, path: str, provenance: dict) -> str:
    """A pose table as CSV and its provenance, with the table's hash, as JSON beside it; returns the hash."""
    name = pose_hash(poses)
    poses.write.mode("overwrite").csv(f"{path}/poses", header=True)
    poses.sparkSession.createDataFrame([(json.dumps({**provenance, "poses_hash": name}, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/provenance")
    return name


def read_pose_table(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, dict]:
    """The table by its column names and the provenance; passes are taken as stored."""
    rows = spark.read.schema(schema).csv(f"{path}/poses", header=True, enforceSchema=False)
    return rows, json.loads(spark.read.text(f"{path}/provenance", wholetext=True).first()[0])


def pose_source(named: str | None, given: str | None, default: str = PLAIN) -> str:
    """Which pose table is meant: the named one, else the environment's, else the default."""
    return named or given or default


def merged_histograms(spark: SparkSession, paths: list[str], by: list[str], count: str = "n") -> DataFrame:
    """Histograms of several runs or tiles added up."""
    return spark.read.parquet(*[f"{p}/table" for p in paths]).groupBy(*by).agg(F.sum(count).alias(count))


def frames_of(spec: str, clean: DataFrame, every: DataFrame, predicted: DataFrame | None = None, key: str = "frame") -> DataFrame:
    """Frames of an expression: ``clean``, ``all``, a list like ``3,7``, or ``missing:`` and one of these, without the predicted ones."""
    if spec.startswith("missing:"):
        return frames_of(spec.removeprefix("missing:"), clean, every, None, key).join(predicted.select(key), key, "left_anti")
    if spec in ("clean", "all"):
        return (clean if spec == "clean" else every).select(key)
    return every.where(F.col(key).isin([int(x) for x in spec.split(",")])).select(key)


def finite(c: str | Column) -> Column:
    """A number of a text file: null where it is empty or not a number."""
    v = F.trim(F.col(c) if isinstance(c, str) else c)
    return F.when((v != "") & (F.lower(v) != "nan"), v.cast("double"))


def read_quality(spark: SparkSession, path: str, key: str = "frame", text: tuple[str, ...] = ("cls", "filename", "reasons")) -> DataFrame:
    """A quality file: numbers with nulls for missing ones, by frame."""
    raw = spark.read.csv(path, header=True)
    return raw.select(*[F.col(c).cast("long").alias(c) if c == key else F.col(c) if c in text else finite(c).alias(c) for c in raw.columns])


def flag(value: Column) -> Column:
    """A flag of three values: true, false, or unknown (null) where there is no entry."""
    return F.when(value.isNull(), F.lit(None).cast("boolean")).otherwise(value.cast("boolean"))


def write_features(faces: DataFrame, path: str, ring: str = "ring", properties: tuple[str, ...] = ()) -> None:
    """Polygons as GeoJSON features, one a line: any number of them can be written and read in parallel."""
    closed = F.concat(F.transform(ring, lambda v: F.array(v["x"], v["y"])), F.array(F.array(F.col(ring)[0]["x"], F.col(ring)[0]["y"])))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(closed).alias("coordinates"))
    line = F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*properties).alias("properties")))
    faces.select(line.alias("value")).write.mode("overwrite").text(path)


def read_features(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """Polygons of line-delimited features: ``properties`` (as a schema) and ``ring``, an array of (x, y) without the closing vertex."""
    schema = f"type string, geometry struct<type: string, coordinates: array<array<array<double>>>>, properties struct<{properties}>"
    f = spark.read.schema(schema).json(path)
    outer = F.col("geometry.coordinates")[0]
    ring = F.transform(F.slice(outer, 1, F.size(outer) - 1), lambda v: F.struct(v[0].alias("x"), v[1].alias("y")))
    return f.where("geometry.type = 'Polygon'").select("properties.*", ring.alias("ring"))
