"""3x3 rotations and quaternions as Column expressions; a matrix is a list of three rows of three Columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Matrix = list[list[Column]]


def _turn(degrees: Column) -> tuple[Column, Column, Column, Column]:
    a = F.radians(degrees)
    return F.cos(a), F.sin(a), F.lit(0.0), F.lit(1.0)


def about_x(degrees: Column) -> Matrix:
    c, s, o, i = _turn(degrees)
    return [[i, o, o], [o, c, -s], [o, s, c]]


def about_y(degrees: Column) -> Matrix:
    c, s, o, i = _turn(degrees)
    return [[c, o, s], [o, i, o], [-s, o, c]]


def about_z(degrees: Column) -> Matrix:
    c, s, o, i = _turn(degrees)
    return [[c, -s, o], [s, c, o], [o, o, i]]


def times(a: Matrix, b: Matrix) -> Matrix:
    return [[a[i][0] * b[0][j] + a[i][1] * b[1][j] + a[i][2] * b[2][j] for j in range(3)] for i in range(3)]


def transposed(m: Matrix) -> Matrix:
    return [[m[j][i] for j in range(3)] for i in range(3)]


def applied(m: Matrix, v: list[Column]) -> list[Column]:
    return [row[0] * v[0] + row[1] * v[1] + row[2] * v[2] for row in m]


def vehicle(yaw: Column, roll: Column, pitch: Column) -> Matrix:
    """World to vehicle body; roll and pitch turn the other way than their sign says."""
    return times(about_y(-pitch), times(about_x(-roll), about_z(-yaw)))


def vehicle_angles(m: Matrix) -> tuple[Column, Column, Column]:
    """(yaw, roll, pitch) of a vehicle rotation, yaw in [-180, 180), for |roll| < 90."""
    yaw = F.degrees(F.atan2(-m[1][0], m[1][1]))
    level = F.sqrt(m[0][2] * m[0][2] + m[2][2] * m[2][2])
    return F.pmod(yaw + 180.0, F.lit(360.0)) - 180.0, -F.degrees(F.atan2(-m[1][2], level)), -F.degrees(F.atan2(m[0][2], m[2][2]))


def boresight(omega: Column, phi: Column, kappa: Column) -> Matrix:
    """Body to camera."""
    return times(about_z(kappa), times(about_y(phi), about_x(omega)))


def angle_between(a: Matrix, b: Matrix) -> Column:
    """Degrees of the turn from ``a`` to ``b``."""
    trace = sum((a[i][j] * b[i][j] for i in range(3) for j in range(3)), F.lit(0.0))
    return F.degrees(F.acos(F.least(F.greatest((trace - 1.0) / 2.0, F.lit(-1.0)), F.lit(1.0))))


def between(p: list[Column], q: list[Column], share: Column) -> list[Column]:
    """Quaternion on the shorter arc from ``p`` to ``q`` (w, x, y, z); nearly equal ones are mixed linearly."""
    dot = sum((a * b for a, b in zip(p, q)), F.lit(0.0))
    sign = F.when(dot < 0, -1.0).otherwise(1.0)
    angle = F.acos(F.least(F.abs(dot), F.lit(1.0)))
    near = F.abs(dot) > 0.9999999
    a = F.when(near, 1.0 - share).otherwise(F.sin((1.0 - share) * angle) / F.sin(angle))
    b = F.when(near, share).otherwise(F.sin(share * angle) / F.sin(angle)) * sign
    mixed = [a * x + b * y for x, y in zip(p, q)]
    length = F.sqrt(sum((c * c for c in mixed), F.lit(0.0)))
    return [c / length for c in mixed]


def eigenvalues(xx: Column, yy: Column, zz: Column, xy: Column, xz: Column, yz: Column) -> tuple[Column, Column, Column]:
    """Eigenvalues of a symmetric matrix, largest first (trigonometric form)."""
    mean = (xx + yy + zz) / 3.0
    a, b, c = xx - mean, yy - mean, zz - mean
    p = F.sqrt((a * a + b * b + c * c + 2.0 * (xy * xy + xz * xz + yz * yz)) / 6.0)
    det = a * (b * c - yz * yz) - xy * (xy * c - yz * xz) + xz * (xy * yz - b * xz)
    half = F.when(p > 0, det / (2.0 * p * p * p)).otherwise(0.0)
    phi = F.acos(F.least(F.greatest(half, F.lit(-1.0)), F.lit(1.0))) / 3.0
    third = 2.0943951023931953
    first, last = mean + 2.0 * p * F.cos(phi), mean + 2.0 * p * F.cos(phi + third)
    return first, 3.0 * mean - first - last, last


def with_eigenvalues(df: DataFrame, entries: dict[str, str], out: tuple[str, str, str]) -> DataFrame:
    """``df`` with the eigenvalues, largest first, of the symmetric matrix in its columns ``entries`` (xx, yy, zz, xy, xz, yz): in steps, so that no expression is written out twice."""
    xx, yy, zz, xy, xz, yz = (F.col(entries[k]) for k in ("xx", "yy", "zz", "xy", "xz", "yz"))
    df = df.withColumn("_mean", (xx + yy + zz) / 3.0)
    a, b, c = (v - F.col("_mean") for v in (xx, yy, zz))
    df = df.withColumns({"_p": F.sqrt((a * a + b * b + c * c + 2.0 * (xy * xy + xz * xz + yz * yz)) / 6.0), "_det": a * (b * c - yz * yz) - xy * (xy * c - yz * xz) + xz * (xy * yz - b * xz)})
    half = F.when(F.col("_p") > 0, F.col("_det") / (2.0 * F.col("_p") * F.col("_p") * F.col("_p"))).otherwise(0.0)
    df = df.withColumn("_phi", F.acos(F.least(F.greatest(half, F.lit(-1.0)), F.lit(1.0))) / 3.0)
    first, last = (F.col("_mean") + 2.0 * F.col("_p") * F.cos(F.col("_phi") + turn) for turn in (0.0, 2.0943951023931953))
    df = df.withColumns({out[0]: first, out[2]: last}).withColumn(out[1], 3.0 * F.col("_mean") - F.col(out[0]) - F.col(out[2]))
    return df.drop("_mean", "_p", "_det", "_phi")
