"""Estimators: data is summed into normal equations of fixed size, only these are solved."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import joins



def least_squares(df: DataFrame, design: list[Column], y: Column, by: list[str]) -> DataFrame:
    """(by, coefficients, n, r2): fits of ``y`` on ``design`` for each group.

    The sums are partial aggregates; a group's small system is solved as one row.
    """
    k = len(design)
    sums = [F.sum(design[i] * design[j]) for i in range(k) for j in range(i, k)]
    table = df.groupBy(*by).agg(F.array(*sums).alias("a"), F.array(*[F.sum(c * y) for c in design]).alias("b"), F.sum(y * y).alias("yy"), F.sum(y).alias("sy"), F.count(y).alias("n"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema if f.name in by)

    def solve(batches):
        for t in batches:
            rows = []
            for a, b, yy, sy, n in zip(t.a, t.b, t.yy, t.sy, t.n):
                m = np.zeros((k, k))
                m[np.triu_indices(k)] = a
                m = m + np.triu(m, 1).T
                x = np.linalg.lstsq(m, np.asarray(b), rcond=None)[0]
                total = yy - sy * sy / n
                rows.append((x.tolist(), float(1 - (yy - x @ np.asarray(b)) / total) if total > 0 else None))
            out = t[[*by, "n"]].copy()
            out["coefficients"], out["r2"] = [r[0] for r in rows], [r[1] for r in rows]
            yield out[[*by, "coefficients", "n", "r2"]]

    return table.mapInPandas(solve, f"{fields}, coefficients array<double>, n long, r2 double")


def fourier(df: DataFrame, angle: str, y: str, by: list[str], order: int = 2) -> DataFrame:
    """Fit of ``y`` on 1, cos and sin of multiples of ``angle`` (degrees)."""
    waves = [f(F.radians(F.col(angle) * k)) for k in range(1, order + 1) for f in (F.cos, F.sin)]
    return least_squares(df, [F.lit(1.0), *waves], F.col(y), by)


def aligned(points: DataFrame, reference: DataFrame, gate: float, rounds: int = 10, tolerance: float = 1e-6) -> dict[str, float]:
    """Turn about the vertical and shift that lay ``points`` (id, x, y, z) on ``reference`` (rid, cx, cy, cz).

    A round joins each point with its nearest reference within ``gate``, and the
    best turn follows from sums over the pairs; one row a round reaches the driver.
    """
    turn, dx, dy, dz, n = 0.0, 0.0, 0.0, 0.0, 0
    for _ in range(rounds):
        c, s = float(np.cos(turn)), float(np.sin(turn))
        x, y = F.col("x"), F.col("y")
        moved = points.select("id", x.alias("ox"), y.alias("oy"), F.col("z").alias("oz"), (c * x - s * y + dx).alias("x"), (s * x + c * y + dy).alias("y"))
        met = joins.range_join(moved, reference, gate).groupBy("id").agg(F.min(F.struct("d2", "rid", "ox", "oy", "oz", "cx", "cy", "cz")).alias("m")).select("m.*")
        m = met.agg(F.count("*"), *[F.avg(k) for k in ("ox", "oy", "oz", "cx", "cy", "cz")], F.covar_pop("ox", "cx"), F.covar_pop("oy", "cy"), F.covar_pop("ox", "cy"), F.covar_pop("oy", "cx")).first()
        n = m[0]
        if n < 3:
            raise ValueError("fewer than three pairs within the gate")
        new = float(np.arctan2(m[9] - m[10], m[7] + m[8]))
        c, s = np.cos(new), np.sin(new)
        shift = float(m[4] - (c * m[1] - s * m[2])), float(m[5] - (s * m[1] + c * m[2])), float(m[6] - m[3])
        change = abs(new - turn) + abs(shift[0] - dx) + abs(shift[1] - dy)
        turn, dx, dy, dz = new, *shift
        if change < tolerance:
            break
    return {"yaw": float(np.degrees(turn)), "dx": dx, "dy": dy, "dz": dz, "pairs": n}


def gated_offset(df: DataFrame, x: str, by: list[str], gates: list[float]) -> DataFrame:
    """(by, offset, n): mean of ``x`` within shrinking gates about the offset so far (the median at first)."""
    now = df.groupBy(*by).agg(F.percentile(x, F.lit(0.5)).alias("offset"))
    for gate in gates:
        now = df.join(now, by).where(F.abs(F.col(x) - F.col("offset")) <= gate).groupBy(*by).agg(F.avg(x).alias("offset"), F.count("*").alias("n"))
    return now


#: Most neighbours of a node that is eliminated, and the number of nodes that are left to conjugate gradients.
DEGREE, CORE = 16, 64


class Eliminated:
    """Factor of a graph's normal equations: nodes with few neighbours are taken out, many apart from each other a round.

    A node's edges (weights ``w``) and its tie to the ground (``own``) become edges
    between its neighbours and ties of theirs: sums and products of positive numbers
    only. Chains and other sparse graphs go to the end, whatever their length; what
    is left of others is solved by conjugate gradients.
    """

    def __init__(self, n: int, a: np.ndarray, b: np.ndarray, w: np.ndarray, own: np.ndarray):
        self.n, self.rounds, self.own = n, [], own.copy()
        own, order = self.own, np.random.default_rng(0).permutation(n)
        a, b, w = self.merged(a, b, w)
        while len(a):
            degree = np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
            if np.count_nonzero(degree) <= CORE:
                break
            key = degree * n + order
            least = np.full(n, np.iinfo(np.int64).max)
            np.minimum.at(least, a, key[b])
            np.minimum.at(least, b, key[a])
            out = (degree > 0) & (degree <= DEGREE) & (key < least)
            if not out.any():
                break
            src, dst, ww = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([w, w])
            mine = np.nonzero(out[src])[0]
            mine = mine[np.argsort(src[mine], kind="stable")]
            src, dst, ww = src[mine], dst[mine], ww[mine]
            total = np.bincount(src, ww, n) + own
            share = ww / total[src]
            gone = np.nonzero(out)[0]
            self.rounds.append((gone, src, dst, share, total[gone]))
            own += np.bincount(dst, own[src] * share, n)
            stay = ~(out[a] | out[b])
            parts = [(a[stay], b[stay], w[stay])]
            for k in range(1, DEGREE):
                same = np.nonzero(src[k:] == src[:-k])[0]
                if not len(same):
                    break
                parts.append((dst[same], dst[same + k], ww[same] * share[same + k]))
            a, b, w = self.merged(*(np.concatenate(c) for c in zip(*parts)))
        self.a, self.b, self.w = a, b, w

    def merged(self, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        real = (a != b) & (w > 0)
        key, at = np.unique(np.minimum(a, b)[real] * self.n + np.maximum(a, b)[real], return_inverse=True)
        return key // max(self.n, 1), key % max(self.n, 1), np.bincount(at, w[real], len(key))

    def solve(self, v: np.ndarray, tolerance: float) -> np.ndarray:
        v, x = v.copy(), np.zeros(self.n)
        for _, src, dst, share, _ in self.rounds:
            v += np.bincount(dst, v[src] * share, self.n)
        core = np.zeros(self.n, bool)
        core[self.a] = core[self.b] = True
        alone = np.ones(self.n, bool)
        for out, *_ in self.rounds:
            alone[out] = False
        tied = alone & ~core & (self.own > 0)
        x[tied] = v[tied] / self.own[tied]
        x[core] = self.gradients(np.where(core, v, 0.0), np.where(core, self.own, 0.0), int(core.sum()), tolerance)[core]
        for out, src, dst, share, total in reversed(self.rounds):
            x[out] = v[out] / total + np.bincount(src, x[dst] * share, self.n)[out]
        return x

    def gradients(self, v: np.ndarray, own: np.ndarray, nodes: int, tolerance: float) -> np.ndarray:
        a, b, w, n = self.a, self.b, self.w, self.n

        def applied(x: np.ndarray) -> np.ndarray:
            pull = w * (x[b] - x[a])
            return own * x + np.bincount(b, pull, n) - np.bincount(a, pull, n)

        x, rest = np.zeros(n), v.copy()
        step, size = rest.copy(), float(rest @ rest)
        enough = tolerance * max(1.0, size) * tolerance
        for _ in range(10 * nodes):
            if size <= enough:
                break
            along = applied(step)
            down = float(step @ along)
            if down <= 0:
                break
            k = size / down
            x, rest = x + k * step, rest - k * along
            size, before = float(rest @ rest), size
            step = rest + size / before * step
        return x

    def parts(self) -> np.ndarray:
        """A number for each node, the same for all of one connected part."""
        part = np.arange(self.n)
        while len(self.a):
            low = part.copy()
            np.minimum.at(low, self.a, part[self.b])
            np.minimum.at(low, self.b, part[self.a])
            if (low == part).all():
                break
            part = low
        for _, src, dst, *_ in reversed(self.rounds):
            part[src] = part[dst]
        return part


def solved_graph(pairs: DataFrame, anchors: DataFrame, tolerance: float = 1e-12) -> dict[int, float]:
    """Offsets of nodes from differences (a, b, d = offset b - offset a, w) and anchors (a, d, w), by least squares.

    For graphs of passes: one edge a pair of passes reaches the driver, as columns,
    and the sparse normal equations are solved by elimination, then once more for
    what rounding has left. A part without an anchor is laid so that its offsets
    have mean 0.
    """
    mean = (F.sum(F.col("w") * F.col("d")) / F.sum("w")).cast("double").alias("d")
    weight = F.sum("w").cast("double").alias("w")
    edges = pairs.groupBy("a", "b").agg(weight, mean).toArrow()
    held = anchors.groupBy("a").agg(weight, mean).toArrow()
    column = lambda t, c: t.column(c).combine_chunks().to_numpy(zero_copy_only=False)
    names = np.unique(np.concatenate([column(edges, "a"), column(edges, "b"), column(held, "a")]))
    a, b, h = np.searchsorted(names, column(edges, "a")), np.searchsorted(names, column(edges, "b")), np.searchsorted(names, column(held, "a"))
    w, d, hw, hd = column(edges, "w"), column(edges, "d"), column(held, "w"), column(held, "d")
    n = len(names)
    factor = Eliminated(n, a, b, w, np.bincount(h, hw, n))
    x = np.zeros(n)
    for _ in range(2):
        pull, tie = w * (d - (x[b] - x[a])), hw * (hd - x[h])
        x = x + factor.solve(np.bincount(b, pull, n) - np.bincount(a, pull, n) + np.bincount(h, tie, n), tolerance)
    part = factor.parts()
    free = np.bincount(part, np.bincount(h, hw, n), n) == 0
    middle = np.bincount(part, x, n) / np.maximum(np.bincount(part, minlength=n), 1)
    x = x - np.where(free, middle, 0.0)[part]
    return dict(zip(names.tolist(), x.tolist()))
