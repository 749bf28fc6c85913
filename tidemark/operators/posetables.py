"""Pose tables: speeds, sessions, overlays, pass transforms, frame groups, and the rotations of viewers and views."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import rotations as Q
from tidemark.functions import scalars as S
from tidemark.operators import sampling
from tidemark.operators.ordered import central_difference, wrapped

#: Rate (degrees a second) below which a frame is straight and above which it turns; least gain at which an alignment counts.
STRAIGHT, TURNING, GAIN = 5.0, 8.0, 0.01
#: Axes of the viewer's sphere in camera axes.
VIEWER = [[1.0, 0.0, 0.0], [0.0, 0.0, 1.0], [0.0, -1.0, 0.0]]


def planar_sessions(df: DataFrame, by: str, order: list[str], t: str, e: str, n: str, gap: float, jump: float) -> DataFrame:
    """``session``: number (from 0) of the stretch without a time gap or a step in the plane over ``jump``."""
    w = Window.partitionBy(by).orderBy(*order)
    step = F.hypot(F.col(e) - F.lag(e).over(w), F.col(n) - F.lag(n).over(w))
    new = ((F.col(t) - F.lag(t).over(w)) > gap) | (step > jump)
    return df.withColumn("session", F.sum(F.when(new, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))


def planar_speed(df: DataFrame, by: str, order: list[str], t: str, e: str, n: str) -> DataFrame:
    """``speed``: length of the second-order derivative of the place in the plane, 0 for a single row."""
    out = central_difference(df, by, order, t, e).withColumnRenamed("rate", "_ve")
    out = central_difference(out, by, order, t, n).withColumnRenamed("rate", "_vn")
    return out.withColumn("speed", F.hypot("_ve", "_vn")).drop("_ve", "_vn")


def overlaid(base: DataFrame, refined: DataFrame, key: str, pose: list[str]) -> DataFrame:
    """``base`` with the pose (and pass) of rows whose refinement has status ``refined``.

    Adds refined, pass_changed, moved (distance of e, n, h) and turned (degrees).
    A refined row with another file name than its base row is an error.
    """
    other = refined.where("status = 'refined'").select(F.col(key), *[F.col(c).alias("_" + c) for c in [*pose, "pass_id", "filename"]])
    both = base.join(other, key, "left")
    mixed = F.col("_filename").isNotNull() & (F.col("_filename") != F.col("filename"))
    both = both.withColumn("filename", F.when(mixed, F.raise_error(F.lit("the tables are out of step")).cast("string")).otherwise(F.col("filename")))
    refined_ = F.col("_pass_id").isNotNull()
    gone = F.sqrt(sum(((F.col("_" + c) - F.col(c)) * (F.col("_" + c) - F.col(c)) for c in "enh"), F.lit(0.0)))
    both = both.withColumns({"refined": refined_, "pass_changed": refined_ & (F.col("_pass_id") != F.col("pass_id")), "moved": gone, "turned": F.abs(wrapped(F.col("_yaw") - F.col("yaw")))})
    return both.withColumns({c: F.coalesce("_" + c, c) for c in [*pose, "pass_id"]}).drop(*["_" + c for c in [*pose, "pass_id", "filename"]])


def transformed(poses: DataFrame, transforms: DataFrame) -> DataFrame:
    """Poses with each pass's transform: places turned about the centre and shifted, headings turned along (in [-180, 180)); passes without one stay.

    ``transforms``: pass_id, dx, dy, dz, dyaw, cx, cy; a null centre is the mean place of the pass.
    """
    t = transforms.select("pass_id", *[F.col(c).alias("_" + c) for c in ("dx", "dy", "dz", "dyaw", "cx", "cy")])
    means = poses.groupBy("pass_id").agg(F.avg("e").alias("_me"), F.avg("n").alias("_mn"))
    both = poses.join(means, "pass_id").join(F.broadcast(t), "pass_id", "left")
    both = both.withColumns({"_cx": F.coalesce("_cx", "_me"), "_cy": F.coalesce("_cy", "_mn")})
    c, s = F.cos(F.radians("_dyaw")), F.sin(F.radians("_dyaw"))
    ex, ny = F.col("e") - F.col("_cx"), F.col("n") - F.col("_cy")
    new = {"e": c * ex - s * ny + F.col("_cx") + F.col("_dx"), "n": s * ex + c * ny + F.col("_cy") + F.col("_dy"), "h": F.col("h") + F.col("_dz")}
    # a turn about the vertical adds to the heading and leaves roll and pitch
    turned = {"yaw": wrapped(F.col("yaw") + F.coalesce("_dyaw", F.lit(0.0)))}
    return both.withColumns({k: F.coalesce(v, F.col(k)) for k, v in new.items()} | turned).select(*poses.columns)


def evenly_by_rank(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The rows at the ranks round(k * (rows - 1) / (n - 1)), halves to even; all if there are no more."""
    r, steps = F.col("rank"), (F.col("total") - 1).cast("double")
    near = F.round(r * (n - 1) / F.greatest(steps, F.lit(1.0))).cast("int")
    taken = (F.col("total") <= n) | F.exists(F.sequence(near - 1, near + 1), lambda k: (k >= 0) & (k <= n - 1) & (F.rint(k * steps / (n - 1)) == r))
    return sampling.ranked(df, order).where(taken).drop("total", "rank")


def frame_groups(frames: DataFrame, n: int, key: str = "frame") -> DataFrame:
    """(group, ``key``): turning frames, ``n`` straight clean ones spread evenly, and those refined or of a pass that moved far.

    ``frames``: key, rate, clean, refined, far (booleans); a null rate counts as 0. A frame may be in several groups.
    """
    rate = F.abs(F.coalesce("rate", F.lit(0.0)))
    pool = frames.where(F.col("clean") & (rate < STRAIGHT)).select(key)
    parts = {"turning": frames.where(rate > TURNING), "straight": evenly_by_rank(pool, [key], n), "refined_or_far": frames.where(F.col("refined") | F.col("far"))}
    out = None
    for name, part in parts.items():
        part = part.select(F.lit(name).alias("group"), key)
        out = part if out is None else out.union(part)
    return out


def planned(frames: DataFrame, alignments: DataFrame) -> DataFrame:
    """Start of each frame's refinement: its own time and pass, or an alignment's that gains at least ``GAIN``.

    ``alignments``: frame, score0, score, src_pass, src_time, dt, dyaw. A frame that
    changes pass starts at the alignment's time with no offset.
    """
    a = alignments.select("frame", *[F.col(c).alias("_" + c) for c in ("score0", "score", "src_pass", "src_time", "dt", "dyaw")])
    both = frames.select("frame", "t", "pass_id").join(a, "frame", "left")
    gains = F.coalesce(F.col("_score0") - F.col("_score") >= GAIN, F.lit(False))
    moved = gains & (F.col("_src_pass") != F.col("pass_id"))
    return both.select(
        "frame", F.when(moved, F.col("_src_time")).otherwise(F.col("t")).alias("t_base"), F.when(gains, F.col("_src_pass")).otherwise(F.col("pass_id")).alias("pass_target"),
        F.when(gains & ~moved, F.col("_dt")).otherwise(0.0).alias("dt0"), F.when(gains, F.col("_dyaw")).otherwise(0.0).alias("dyaw0"), moved.alias("reassigned"),
    )


#: Prior widths by parameter (s, degrees, m), and those of turning frames.
SIGMA = {"dt": 0.05, "dyaw": 0.5, "droll": 0.3, "dpitch": 0.3, "dlat": 0.15, "dh": 0.15}
SIGMA_TURNING = {"dt": 0.3, "dyaw": 2.0}


def prior_width(name: str, turning: Column) -> Column:
    return F.when(turning, F.lit(SIGMA_TURNING.get(name, SIGMA[name]))).otherwise(F.lit(SIGMA[name]))


def sphere_rotation(m: list[list[Column]], offset: float = 0.0) -> list[list[Column]]:
    """Viewer sphere to world, from a world-to-camera rotation: the transpose of viewer axes, azimuth offset and rotation."""
    fixed = [[F.lit(v) for v in row] for row in VIEWER]
    return Q.transposed(Q.times(Q.times(fixed, Q.about_z(F.lit(offset))), m))


def viewer_angles(m: list[list[Column]], offset: float = 0.0) -> dict[str, Column]:
    """course, pitch and roll (degrees) by which the viewer turns its sphere."""
    s = sphere_rotation(m, offset)
    b = F.asin(F.least(F.greatest(-s[2][0], F.lit(-1.0)), F.lit(1.0)))
    course = 90.0 - F.degrees(F.atan2(s[1][0], s[0][0]))
    return {"course": wrapped(course), "pitch": -F.degrees(b), "roll": F.degrees(F.atan2(s[2][1], s[2][2])) - 90.0}


def coordinate_line(name: Column, t: Column, place: list[Column], angles: dict[str, Column]) -> Column:
    """A line of the viewer's coordinate file: name, time and angles with six decimals, place with four."""
    fixed = lambda c, k: F.format_string(f"%.{k}f", c)
    return F.concat_ws("\t", name, fixed(t, 6), *[fixed(c, 4) for c in place], *[fixed(angles[k], 6) for k in ("course", "pitch", "roll")])


def view_axes(yaw: Column, pitch: Column) -> list[list[Column]]:
    """Levelled body axes (forward, left, up) to the axes of a view (right, up, forward); yaw turns left, pitch up."""
    y, p = F.radians(yaw), F.radians(pitch)
    cy, sy, cp, sp = F.cos(y), F.sin(y), F.cos(p), F.sin(p)
    return [[sy, -cy, F.lit(0.0)], [-cy * sp, -sy * sp, cp], [cy * cp, sy * cp, sp]]


def view_ray(i: Column, j: Column, size: int, fov: float) -> list[Column]:
    """Unit ray of a view's pixel centre (row, column) in the view's axes."""
    f = 0.5 / math.tan(math.radians(fov / 2))
    x, y = (j + 0.5) / size - 0.5, -((i + 0.5) / size - 0.5)
    norm = F.sqrt(x * x + y * y + f * f)
    return [x / norm, y / norm, F.lit(f) / norm]


def view_place(d: list[Column], fov: float) -> dict[str, Column]:
    """Place in a view (-0.5 to 0.5 inside) of a ray in its axes, whether it lies ahead and inside, and its fusion weight cos^2."""
    f = 0.5 / math.tan(math.radians(fov / 2))
    ahead = d[2] > 1e-6
    fs = F.when(ahead, d[2]).otherwise(1.0)
    x, y = d[0] / fs * f, -d[1] / fs * f
    inside = ahead & (F.abs(x) <= 0.5) & (F.abs(y) <= 0.5)
    far = F.least(F.greatest(F.abs(x), F.abs(y)) / 0.5, F.lit(1.0))
    c = F.cos(far * math.pi / 2)
    return {"x": x, "y": y, "ahead": ahead, "inside": inside, "weight": F.when(inside, c * c).otherwise(0.0)}


def view_name(yaw: Column, pitch: Column) -> Column:
    y, p = F.pmod(F.rint(yaw).cast("int"), F.lit(360)), F.rint(pitch).cast("int")
    return F.concat(F.lit("y"), F.lpad(y.cast("string"), 3, "0"), F.lit("_p"), F.when(p < 0, "-").otherwise("+"), F.lpad(F.abs(p).cast("string"), 2, "0"))


def panorama_rays(i: Column, j: Column, w: int, h: int) -> dict[str, Column]:
    """Unit camera ray of a panorama cell's centre, in the one convention of all projections."""
    return S.ray((j + 0.5) / w * S.PANO_W, (i + 0.5) / h * S.PANO_H)
