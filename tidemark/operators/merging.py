"""Products merged row by row, fragments merged into neighbours, content digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.raster import spread


class MissingRows(ValueError):
    """An input that must cover every row does not."""


def merged(base: DataFrame, key: str, colours: DataFrame | None, labels: DataFrame, clusters: DataFrame | None) -> DataFrame:
    """``base`` (key, colour) with the colours, labels and clusters of its rows.

    A missing colour leaves the base's and counts in ``fallback``; a missing
    cluster is -1; rows without a label are an error.
    """
    if not base.join(labels, key, "left_anti").isEmpty():
        raise MissingRows("the labels do not cover every row")
    out = base.join(labels, key)
    new = colours if colours is not None else base.limit(0)
    out = out.join(new.select(key, F.col("colour").alias("_colour")), key, "left")
    out = out.join(clusters, key, "left") if clusters is not None else out.withColumn("cluster", F.lit(None).cast("long"))
    out = out.withColumns({"fallback": F.col("_colour").isNull(), "colour": F.coalesce("_colour", "colour"), "cluster": F.coalesce("cluster", F.lit(-1).cast("long"))})
    return out.drop("_colour")


def consolidated(points: DataFrame, colours: DataFrame, labels: DataFrame, objects: DataFrame, key: str = "id") -> DataFrame:
    """``points`` (key, r, g, b, ...) with fused colours, labels and objects.

    Rows without a colour, or with one that no view gave, keep their own; every row
    needs a label (else ``MissingRows``); rows of no object have cluster -1, class 0
    and height 0.
    """
    if not points.join(labels, key, "left_anti").isEmpty():
        raise MissingRows("the labels do not cover every row")
    out = points.join(colours, key, "left").join(labels, key).join(objects, key, "left")
    own = F.coalesce("views", F.lit(0)) == 0
    out = out.withColumns({c: F.when(own, F.col(c)).otherwise(F.col("f" + c)) for c in "rgb"}).drop("fr", "fg", "fb")
    filled = {"views": 0, "conf": 0, "cluster": -1, "obj": 0, "hag": 0.0}
    return out.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in filled.items()})


def identity(a: DataFrame, b: DataFrame, key: list[str], values: list[str], by: str) -> DataFrame:
    """(by, n, missing, differing): rows of ``a`` that ``b`` lacks, or has with other values."""
    other = b.select(*key, F.lit(True).alias("_there"), *[F.col(c).alias("_" + c) for c in values])
    met = a.join(other, key, "left")
    unlike = F.lit(False)
    for c in values:
        unlike = unlike | ~F.col(c).eqNullSafe(F.col("_" + c))
    there = F.col("_there").isNotNull()
    return met.groupBy(by).agg(F.count("*").alias("n"), F.count_if(~there).alias("missing"), F.count_if(there & unlike).alias("differing"))


def verified(source: DataFrame, written: DataFrame, key: list[str], by: str, tolerance_mm: float) -> DataFrame:
    """What was written against its source: exact places and classes by ``by``, median and largest shift (mm) and how many exceed the tolerance."""
    other = written.select(*key, *[F.col(c).alias("_" + c) for c in ("x", "y", "z", "cls")])
    met = source.join(other, key)
    shift = 1000.0 * F.sqrt(sum(((F.col("_" + c) - F.col(c)) * (F.col("_" + c) - F.col(c)) for c in "xyz"), F.lit(0.0)))
    exact = (F.col("_x") == F.col("x")) & (F.col("_y") == F.col("y")) & (F.col("_z") == F.col("z"))
    met = met.withColumns({"_s": shift, "_e": exact})
    return met.groupBy(by).agg(F.count("*").alias("n"), F.bool_and("_e").alias("xyz_exact"), F.bool_and(F.col("_cls") == F.col("cls")).alias("class_exact"), F.percentile("_s", F.lit(0.5)).alias("shift_median_mm"), F.max("_s").alias("shift_max_mm"), F.count_if(F.col("_s") > tolerance_mm).alias("moved"))


def attached(points: DataFrame, overlap: float = 0.5) -> DataFrame:
    """(low, high): lower clusters and the upper one under whose footprint at least ``overlap`` of their points lie.

    ``points``: (i, j, low, high), one of the labels null. A cell's footprint is
    the upper label most points of it have (lowest on a tie), an empty cell's the
    highest label of its eight neighbours.
    """
    counts = points.where("high is not null").groupBy("i", "j", "high").agg(F.count("*").alias("n"))
    own = counts.groupBy("i", "j").agg(F.max(F.struct("n", (-F.col("high")).alias("minus"))).alias("m")).select("i", "j", (-F.col("m.minus")).alias("value"))
    foot = spread(own).groupBy("i", "j").agg(F.max(F.when((F.col("di") == 0) & (F.col("dj") == 0), F.col("value"))).alias("own"), F.max("value").alias("grown")).select("i", "j", F.coalesce("own", "grown").alias("under"))
    low = points.where("low is not null").groupBy("i", "j", "low").agg(F.count("*").alias("n"))
    votes = low.join(foot, ["i", "j"], "left").groupBy("low", "under").agg(F.sum("n").alias("n"))
    most = votes.groupBy("low").agg(F.sum("n").alias("total"), F.max(F.when(F.col("under").isNotNull(), F.struct("n", (-F.col("under")).alias("minus")))).alias("m"))
    return most.where(F.col("m.n") >= overlap * F.col("total")).select("low", (-F.col("m.minus")).alias("high"))


def absorbed(points: DataFrame, id_: str, voxel: float, eps: float, small: float, big: float, cell: float = 0.5) -> DataFrame:
    """(id, into): clusters with a footprint under ``small`` and the big one (at least ``big``) with which most of their voxels' points pair within ``eps``.

    ``points``: (point, id, x, y, z). A voxel stands for its least point; lower id
    on a tie. Pairs are found in cells as wide as ``eps``.
    """
    area = points.groupBy(id_).agg((F.countDistinct(F.floor(F.col("x") / cell), F.floor(F.col("y") / cell)) * cell * cell).alias("area"))
    at = [F.floor(F.col(c) / voxel).alias("_" + c) for c in "xyz"]
    firsts = points.groupBy(*at).agg(F.min(F.struct("point", F.col(id_).alias("id"), "x", "y", "z")).alias("p")).select("p.*")
    sized = firsts.join(area.withColumnRenamed(id_, "id"), "id")
    wide = lambda c, s=0: (F.floor(F.col(c) / eps) + s).alias("_" + c)
    tiny = sized.where(F.col("area") < small)
    near = F.array(*[F.struct(*[wide(c, s) for c, s in zip("xyz", (a, b, d))]) for a in (-1, 0, 1) for b in (-1, 0, 1) for d in (-1, 0, 1)])
    tiny = tiny.select("id", *[F.col(c).alias("s" + c) for c in "xyz"], F.explode(near).alias("c")).select("id", "sx", "sy", "sz", "c.*")
    large = sized.where(F.col("area") >= big).select(F.col("id").alias("into"), "x", "y", "z", *[wide(c) for c in "xyz"])
    d2 = sum(((F.col(c) - F.col("s" + c)) * (F.col(c) - F.col("s" + c)) for c in "xyz"), F.lit(0.0))
    touch = tiny.join(large, ["_x", "_y", "_z"]).where(d2 <= eps * eps).groupBy("id", "into").agg(F.count("*").alias("n"))
    return touch.groupBy("id").agg(F.max(F.struct("n", (-F.col("into")).alias("minus"))).alias("m")).select("id", (-F.col("m.minus")).alias("into"))


def digest(row: Column) -> Column:
    """Mergeable digest of a set of rows: sum of the leading 40 bits of each row's SHA-256."""
    return F.sum(F.conv(F.substring(F.sha2(row, 256), 1, 10), 16, 10).cast("long"))
