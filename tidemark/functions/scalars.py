"""Geometry and colour as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PANO_W, PANO_H = 8000, 4000
TOL_ABS, TOL_REL = 0.15, 0.03
#: Height error that the visibility test forgives (m), and the most that slope or grazing may add to its tolerance (m).
HEIGHT_TOL, SLOPE_CAP = 0.12, 2.0


def circular(a: Column, b: Column) -> Column:
    """Absolute difference of two angles in degrees."""
    return F.abs(F.pmod(a - b + 180.0, F.lit(360.0)) - 180.0)


def panorama(x: Column, y: Column, z: Column, w: int = PANO_W, h: int = PANO_H) -> dict[str, Column]:
    """Camera coordinates to panorama pixel and range: u from azimuth (180 - az), v from elevation."""
    az, el = F.degrees(F.atan2(y, x)), F.degrees(F.atan2(z, F.sqrt(x * x + y * y)))
    return {"u": F.pmod(180.0 - az, F.lit(360.0)) / 360.0 * w, "v": (90.0 - el) / 180.0 * h, "r": F.sqrt(x * x + y * y + z * z), "el": el}


def ray(u: Column, v: Column, w: int = PANO_W, h: int = PANO_H) -> dict[str, Column]:
    """Panorama pixel to unit ray."""
    az, el = F.radians(180.0 - u / w * 360.0), F.radians(90.0 - v / h * 180.0)
    return {"x": F.cos(el) * F.cos(az), "y": F.cos(el) * F.sin(az), "z": F.sin(el)}


def rotated(x: Column, y: Column, degrees: Column) -> tuple[Column, Column]:
    c, s = F.cos(F.radians(degrees)), F.sin(F.radians(degrees))
    return c * x - s * y, s * x + c * y


def to_linear(u8: Column) -> Column:
    c = u8 / 255.0
    return F.when(c <= 0.04045, c / 12.92).otherwise(F.pow((c + 0.055) / 1.055, F.lit(2.4)))


def to_srgb(linear: Column) -> Column:
    c = F.least(F.greatest(linear, F.lit(0.0)), F.lit(1.0))
    # halves to even, whatever the last digits of a power are
    return F.rint(F.round(255.0 * F.when(c <= 0.0031308, 12.92 * c).otherwise(1.055 * F.pow(c, F.lit(1 / 2.4)) - 0.055), 6)).cast("int")


def lab(r: Column, g: Column, b: Column) -> tuple[Column, Column, Column]:
    """CIELAB (D65) of 8-bit sRGB."""
    lr, lg, lb = to_linear(r), to_linear(g), to_linear(b)
    f = lambda t: F.when(t > 216.0 / 24389.0, F.pow(t, F.lit(1 / 3))).otherwise((24389.0 / 27.0 * t + 16.0) / 116.0)
    x = f((0.4124564 * lr + 0.3575761 * lg + 0.1804375 * lb) / 0.95047)
    y = f(0.2126729 * lr + 0.7151522 * lg + 0.0721750 * lb)
    z = f((0.0193339 * lr + 0.1191920 * lg + 0.9503041 * lb) / 1.08883)
    return 116.0 * y - 16.0, 500.0 * (x - y), 200.0 * (y - z)


def cie76(a: tuple[Column, Column, Column], b: tuple[Column, Column, Column]) -> Column:
    return F.sqrt(sum(((p - q) * (p - q) for p, q in zip(a, b)), F.lit(0.0)))


def depth_mm(metres: Column) -> Column:
    """Range in millimetres, 1 to 65535; 0 where there is none."""
    return F.when(metres.isNull(), 0).otherwise(F.least(F.greatest(F.rint(metres * 1000), F.lit(1)), F.lit(65535)).cast("int"))


def visible(r: Column, depth: Column, spread: Column, row: Column, h: int) -> Column:
    """Whether range ``r`` lies at its cell's depth or before, within a tolerance; an empty cell shows nothing.

    The tolerance is the largest of an absolute and a relative one, of the depth
    spread around the cell and of what a small height error makes of the range at
    the cell's elevation (``row`` of ``h``); the last two are capped.
    """
    elevation = F.abs(F.radians(90.0 - (row + 0.5) / h * 180.0))
    grazing = F.least(HEIGHT_TOL / F.greatest(F.sin(elevation), F.lit(0.05)), F.lit(SLOPE_CAP))
    slope = F.least(F.coalesce(spread, F.lit(0.0)), F.lit(SLOPE_CAP))
    return depth.isNotNull() & (r <= depth + F.greatest(F.lit(TOL_ABS), TOL_REL * r, slope, grazing))


def cell_of(u: Column, v: Column, w: int, h: int) -> tuple[Column, Column]:
    """(row, column) of a panorama place already scaled to ``w`` by ``h`` cells: truncated, rows clamped, columns wrapped."""
    row = F.least(F.greatest(v.cast("long"), F.lit(0).cast("long")), F.lit(h - 1).cast("long"))
    return row, F.pmod(u.cast("long"), F.lit(w).cast("long"))


def distance_score(r: Column, reach: float = 8.0) -> Column:
    return 1.0 / (1.0 + (r / reach) * (r / reach))


def ciede2000(a: tuple[Column, Column, Column], b: tuple[Column, Column, Column]) -> Column:
    """Colour difference of two CIELAB colours by CIEDE2000 with unit weights."""
    chroma = lambda p, q: F.sqrt(p * p + q * q)
    seventh = lambda c: F.pow(c, F.lit(7.0))
    mean = (chroma(a[1], a[2]) + chroma(b[1], b[2])) / 2.0
    g = 0.5 * (1.0 - F.sqrt(seventh(mean) / (seventh(mean) + 25.0**7)))
    a1, b1 = (1.0 + g) * a[1], (1.0 + g) * b[1]
    c1, c2 = chroma(a1, a[2]), chroma(b1, b[2])
    hue = lambda p, q: F.when((p == 0) & (q == 0), 0.0).otherwise(F.pmod(F.degrees(F.atan2(q, p)), F.lit(360.0)))
    h1, h2, grey = hue(a1, a[2]), hue(b1, b[2]), c1 * c2 == 0
    turn = F.when(grey, 0.0).when(h2 - h1 > 180, h2 - h1 - 360.0).when(h2 - h1 < -180, h2 - h1 + 360.0).otherwise(h2 - h1)
    dl, dc, dh = b[0] - a[0], c2 - c1, 2.0 * F.sqrt(c1 * c2) * F.sin(F.radians(turn / 2.0))
    lm, cm = (a[0] + b[0]) / 2.0, (c1 + c2) / 2.0
    hm = F.when(grey, h1 + h2).when(F.abs(h1 - h2) <= 180, (h1 + h2) / 2.0).when(h1 + h2 < 360, (h1 + h2 + 360.0) / 2.0).otherwise((h1 + h2 - 360.0) / 2.0)
    wave = lambda k, off: F.cos(F.radians(k * hm + off))
    t = 1.0 - 0.17 * wave(1.0, -30.0) + 0.24 * wave(2.0, 0.0) + 0.32 * wave(3.0, 6.0) - 0.20 * wave(4.0, -63.0)
    bend = 30.0 * F.exp(-((hm - 275.0) / 25.0) * ((hm - 275.0) / 25.0))
    sl = 1.0 + 0.015 * (lm - 50.0) * (lm - 50.0) / F.sqrt(20.0 + (lm - 50.0) * (lm - 50.0))
    sc, sh = 1.0 + 0.045 * cm, 1.0 + 0.015 * cm * t
    rt = -2.0 * F.sqrt(seventh(cm) / (seventh(cm) + 25.0**7)) * F.sin(F.radians(2.0 * bend))
    return F.sqrt((dl / sl) * (dl / sl) + (dc / sc) * (dc / sc) + (dh / sh) * (dh / sh) + rt * (dc / sc) * (dh / sh))
