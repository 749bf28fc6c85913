"""Fusion and evaluation aggregates: top-k, robust medians, votes, histograms, confusion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Cutoff and slack of the outlier test, spread at which confidence is 0, label of nothing.
MAD_CUTOFF, MAD_SLACK, SPREAD_LIMIT, IGNORE = 2.5, 1e-3, 0.15, 255


def top_k(df: DataFrame, by: str, score: str, ties: list[str], k: int) -> DataFrame:
    """The ``k`` best rows of each key; Spark keeps k a task before the shuffle."""
    w = Window.partitionBy(by).orderBy(F.desc(score), *ties)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _field(name: str):
    return lambda v: v[name]


def _median(values: Column) -> Column:
    """Median of a short array, null for an empty one."""
    ordered, n = F.array_sort(values), F.size(values)
    return (F.get(ordered, F.floor((n - 1) / 2).cast("int")) + F.get(ordered, F.floor(n / 2).cast("int"))) / 2


def robust_colour(df: DataFrame, by: str, channels: list[str], score: str, ties: list[str], k: int = 5) -> DataFrame:
    """(by, channels, views, kept, mad, conf, best_*): robust fusion of the ``k`` best samples of each key.

    Median by channel, distance of each sample to it, median of those (``mad``);
    samples beyond ``MAD_CUTOFF`` of it go and the channels are the median of the
    rest (all, where none is left). ``conf`` falls from 255 with the spread; a
    single view counts as widely spread. One shuffle: no group is larger than k.
    """
    best = top_k(df, by, score, ties, k).groupBy(by).agg(F.array_sort(F.collect_list(F.struct("rank", *channels, *ties))).alias("s"))
    middles = {f"_m{c}": _median(F.transform("s", _field(c))) for c in channels}
    out = best.withColumns(middles)
    away = F.transform("s", lambda v: F.sqrt(sum(((v[c] - F.col(f"_m{c}")) * (v[c] - F.col(f"_m{c}")) for c in channels), F.lit(0.0))))
    out = out.withColumn("_away", away).withColumn("mad", _median(F.col("_away")))
    inside = F.transform("_away", lambda d: F.round(d, 9) <= F.round(MAD_CUTOFF * F.col("mad") + MAD_SLACK, 9))
    out = out.withColumn("_kept", F.filter(F.arrays_zip(F.col("s").alias("v"), inside.alias("in")), lambda z: z["in"]))
    spread = F.when(F.size("s") >= 2, F.col("mad")).otherwise(F.lit(SPREAD_LIMIT))
    conf = F.floor(F.least(F.greatest(F.round(255.0 * (1.0 - spread / SPREAD_LIMIT), 6), F.lit(0.0)), F.lit(255.0))).cast("int")
    colour = [F.coalesce(_median(F.transform(F.transform("_kept", _field("v")), _field(c))), F.col(f"_m{c}")).alias(c) for c in channels]
    return out.select(by, *colour, F.size("s").alias("views"), F.size("_kept").alias("kept"), "mad", conf.alias("conf"), *[F.get("s", F.lit(0))[t].alias(f"best_{t}") for t in ties])


def vote(df: DataFrame, by: str, label: str, weight: str, frame: list[str]) -> DataFrame:
    """(by, winner, conf, views, best_*): weighted vote; lowest label on a tie, and the first strongest vote.

    Where no vote has weight the winner is ``IGNORE``, conf 0 and there is no
    strongest vote; conf is the winner's share of 255, rounded half to even.
    """
    sums = df.groupBy(by, label).agg(F.sum(weight).alias("w"), F.count("*").alias("views"), F.min(F.when(F.col(weight) > 0, F.struct((-F.col(weight)).alias("w"), *frame))).alias("best"))
    out = sums.groupBy(by).agg(F.min(F.struct((-F.round("w", 6)).alias("w"), F.col(label).alias("label"))).alias("top"), F.sum("w").alias("total"), F.sum("views").alias("views"), F.min("best").alias("best"))
    has = F.col("total") > 0
    conf = F.when(has, F.rint(F.round(255 * -F.col("top.w") / F.col("total"), 6))).otherwise(0.0)
    return out.select(by, F.when(has, F.col("top.label")).otherwise(IGNORE).alias("winner"), conf.cast("int").alias("conf"), F.least("views", F.lit(255).cast("long")).alias("views"), *[F.col(f"best.{c}").alias(f"best_{c}") for c in frame])


def last_write(df: DataFrame, by: str, order: list[str], value: str) -> DataFrame:
    return df.groupBy(by).agg(F.max_by(value, F.struct(*order)).alias(value))


def binned(x: str | Column, width: float, bins: int) -> Column:
    """Bin number: truncated and clipped to the histogram."""
    return F.least(F.greatest(F.floor((F.col(x) if isinstance(x, str) else x) / width).cast("int"), F.lit(0)), F.lit(bins - 1))


SHARES = (25, 50, 75, 90, 95, 99)


def histogram_report(hist: DataFrame, by: str, bin_: str, count: str, width: float, high: float = 20.0, low: float = 5.0) -> DataFrame:
    """Statistics of fixed-bin histograms, one row a group, none for an empty one.

    n, mean, median, mad, p25 to p99 (each the centre of the first bin at which the
    cumulative share reaches it) and the percentages above ``high`` and below
    ``low``. ``mad`` is that quantile of the bins' distances to the median.
    """
    centre = (F.col(bin_) + 0.5) * width
    whole, upto = Window.partitionBy(by), (Window.unboundedPreceding, 0)
    rows = hist.where(F.col(count) > 0).withColumns({"_x": centre, "_n": F.sum(count).over(whole)})
    rows = rows.withColumn("_c", F.sum(count).over(whole.orderBy(bin_).rowsBetween(*upto)) / F.col("_n"))
    reached = lambda c, p, x: F.min(F.when(F.col(c) >= p / 100.0, F.col(x)))
    rows = rows.withColumn("_median", reached("_c", 50, "_x").over(whole)).withColumn("_d", F.abs(F.col("_x") - F.col("_median")))
    rows = rows.withColumn("_cd", F.sum(count).over(whole.orderBy("_d").rangeBetween(*upto)) / F.col("_n"))
    share = lambda which: 100.0 * F.sum(F.when(which, F.col(count)).otherwise(0)) / F.first("_n")
    return rows.groupBy(by).agg(
        F.first("_n").alias("n"), (F.sum(F.col(count) * F.col("_x")) / F.first("_n")).alias("mean"), F.first("_median").alias("median"), reached("_cd", 50, "_d").alias("mad"),
        *[reached("_c", p, "_x").alias(f"p{p}") for p in SHARES if p != 50], share(F.col("_x") > high).alias("pct_above"), share(F.col("_x") < low).alias("pct_below"),
    )


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def iou(cm: DataFrame) -> DataFrame:
    """(label, iou): true positives over the union; null for a label that never occurs."""
    rows, cols = cm.groupBy(F.col("truth").alias("label")).agg(F.sum("n").alias("r")), cm.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("c"))
    tp = cm.where("truth = predicted").select(F.col("truth").alias("label"), F.col("n").alias("tp"))
    full = rows.join(cols, "label", "full").join(tp, "label", "left").fillna(0, ["r", "c", "tp"])
    return full.select("label", F.try_divide(F.col("tp").cast("double"), F.col("r") + F.col("c") - F.col("tp")).alias("iou"))
