"""Scans: driver tables as domain objects, and the file formats of the domain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POSE_SCHEMA = "frame int, filename string, t double, E double, N double, H double, roll double, pitch double, yaw double, pass_id int"
RAW_FRAME_COLUMNS = 17
#: Positions of timestamp, file name, E, N, H, roll, pitch and yaw in a raw frame file.
RAW_FRAME_PICK = {"t": 0, "filename": 1, "E": 2, "N": 3, "H": 4, "roll": 11, "pitch": 12, "yaw": 13}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a time series: ``t`` in seconds, partitioned by ``user_id``."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "user_id", "event_type", "value", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t"))


def spatial_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as points: the first three dimensions, scaled to metres."""
    e = table(spark, sf_dir, "embeddings")
    axis = lambda i: (F.get("embedding", F.lit(i)).cast("double") * 100).alias("xyz"[i])
    return e.select("vec_id", "label", axis(0), axis(1), axis(2))


def scan_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points with the attributes of a scan: class, time, scan line, colour, returns, intensity and the tile they lie in."""
    i = F.col("vec_id")
    tile = (F.floor(F.col("x") / 20) + 10) * 100 + F.floor(F.col("y") / 20) + 10
    return spatial_points(spark, sf_dir).select(
        i.alias("id"), "x", "y", "z", F.col("label").alias("cls"), (i * 0.37).alias("gps"), (i % 7).alias("psid"), *[(i * k % 256).alias(c) for c, k in (("r", 37), ("g", 73), ("b", 151))],
        (i % 3 + 1).alias("nret"), (i * 977 % 65536).alias("intensity"), tile.alias("tile"),
    )


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Camera frames with their poses: every 25th point of the scan."""
    p, i = scan_points(spark, sf_dir).where("id % 25 = 0"), F.col("id")
    angle = lambda c: c.cast("double")
    return p.select(
        F.floor(i / 25).alias("frame"), F.col("gps").alias("t"), F.col("x").alias("e"), F.col("y").alias("n"), (F.col("z") + 2).alias("h"),
        angle(i * 13 % 360 - 180).alias("yaw"), angle(i % 7 - 3).alias("roll"), angle(i % 5 - 2).alias("pitch"), F.col("cls").alias("pass_id"),
    )


def list_tiles(spark: SparkSession, folder: str, suffix: str = "laz") -> DataFrame:
    """(path, name, length) of the tile files in a folder; their content is not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{suffix}").load(folder)
    return found.select("path", tile_name(F.col("path")).alias("name"), "length").orderBy("path")


def tile_name(path: Column) -> Column:
    """Name of a tile from its file's: the last three characters before the second underscore."""
    return F.substring(F.regexp_extract(path, r"[^/_]*_([^/_.]*)[^/]*$", 1), -3, 3)


def read_raw_frames(spark: SparkSession, path: str) -> DataFrame:
    """Frames by column position of a 17-column CSV file with a header; blank rows are skipped."""
    schema = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(RAW_FRAME_COLUMNS)])
    header = spark.read.text(path).limit(1).first()
    if header is None or len(header[0].split(",")) != RAW_FRAME_COLUMNS:
        raise ValueError(f"{path}: not a {RAW_FRAME_COLUMNS}-column frame file")
    raw = spark.read.csv(path, header=True, schema=schema, enforceSchema=True).where(F.trim(F.coalesce("_0", F.lit(""))) != "")
    return raw.select(*[F.col(f"_{i}").cast("string" if k == "filename" else "double").alias(k) for k, i in RAW_FRAME_PICK.items()])


def read_poses(spark: SparkSession, path: str) -> DataFrame:
    """A pose table by header name, ``pass_id`` as stored."""
    raw = spark.read.csv(path, header=True)
    fields = [f.split() for f in POSE_SCHEMA.split(", ")]
    missing = [n for n, _ in fields if n not in raw.columns]
    if missing:
        raise ValueError(f"{path} lacks {missing}")
    return raw.select(*[F.col(n).cast(k).alias(n) for n, k in fields], *[c for c in raw.columns if c not in {n for n, _ in fields}])


def write_poses(poses: DataFrame, path: str) -> None:
    poses.write.mode("overwrite").csv(path, header=True)


def read_vector_objects(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON features as (uid, code, base_code, geom_type, coords); missing heights are null, features without code or geometry go."""
    coords = "geometry struct<type:string,coordinates:string>, properties map<string,string>"
    raw = spark.read.schema(f"features array<struct<{coords.replace(' struct', ':struct').replace(' map', ':map').replace(', ', ',')}>>").json(path, multiLine=True)
    f = raw.select(F.explode("features").alias("f")).select("f.geometry.type", "f.geometry.coordinates", "f.properties")
    f = f.where(F.col("type").isin("Point", "LineString", "Polygon") & F.element_at("properties", F.lit("jvfcode")).isNotNull())
    line = F.when(F.col("type") == "Point", F.concat(F.lit("["), "coordinates", F.lit("]"))).when(F.col("type") == "Polygon", F.expr("to_json(from_json(coordinates, 'array<array<array<double>>>')[0])")).otherwise(F.col("coordinates"))
    xyz = F.transform(F.from_json(line, "array<array<double>>"), lambda c: F.struct(c[0].alias("e"), c[1].alias("n"), F.get(c, F.lit(2)).alias("h")))
    code = F.element_at("properties", F.lit("jvfcode"))
    return f.select(F.element_at("properties", F.lit("uid")).alias("uid"), code.alias("code"), F.split(code, "-")[0].alias("base_code"), F.col("type").alias("geom_type"), xyz.alias("coords"))
