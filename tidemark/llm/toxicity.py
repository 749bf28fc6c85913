"""Toxicity by gradient-boosted trees over dense features, calibrated isotonically.

Features are densities of a fixed and of a learned lexicon (words and word
beginnings), their proximity to second-person words, capitals, punctuation and
obfuscation rates. Lexicon, trees and calibration learn from different labelled
rows, so that none of them sees what the one before it has fitted.
"""

from __future__ import annotations

import gc
import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate

#: Labelled rows of each class that are learned from, about; this bounds what reaches the driver.
PER_CLASS = 4000
#: Learned lexicon entries of each kind at most (the surest), their beginnings' length, and the least lower bound of their log odds.
LEXICON, STEM, SURE = 2000, 5, 1.0
TREES, DEPTH, RATE, BINS, LEAST_LEAF = 80, 3, 0.15, 48, 5.0
#: Words within which a second-person word counts as near.
NEAR = 5
THRESHOLD = 0.3
# fixed values
INSULTS = "idiot idiots stupid moron morons loser losers pathetic worthless trash scum disgusting clown dumb imbecile fool jerk garbage filth vermin freak creep pig ugly hate".split()
SECOND_PERSON = "you your yours yourself youre u ur du dich dir dein deine ihr euch sie tu te toi ton ta tes vous votre vos usted ustedes tú ti tus su vosotros".split()
# end of fixed values
UNMASK = str.maketrans("0134578@$!*", "oieastbasi ")
WORD = re.compile(r"[^\W\d_]+")
MASKED = re.compile(r"\b[^\W\d_]+[0134578@$!*]+[^\W\d_]+\b")
SPACED = re.compile(r"\b(?:[^\W\d_][ .*_-]){3,}[^\W\d_]\b")
REPEATED = re.compile(r"[!?]{2,}|\.{4,}")


def features(text: str | None, words: dict[str, float], stems: dict[str, float]) -> list[float]:
    """Dense features of a text under a lexicon of words and word beginnings with their log odds."""
    text = text or ""
    found = WORD.findall(text.lower())
    n = max(1, len(found))
    fixed, person = FIXED, PERSON
    hits = [i for i, w in enumerate(found) if w in words or w in fixed]
    learned = [words[w] for w in found if w in words]
    begun = [stems[s] for s in [w[:STEM] for w in found] if s in stems]
    yours = [i for i, w in enumerate(found) if w in person]
    at, near = np.array(yours), 0
    if yours and hits:
        h = np.array(hits)
        k = np.searchsorted(at, h)
        near = int((np.minimum(np.abs(at[np.minimum(k, len(at) - 1)] - h), np.abs(at[np.maximum(k - 1, 0)] - h)) <= NEAR).sum())
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256) if text else np.zeros(256)
    size = max(1, len(text))
    upper, punct, marks = raw[65:91].sum(), raw[33:48].sum() + raw[58:65].sum() + raw[91:97].sum() + raw[123:127].sum(), raw[33] + raw[63]
    masked = MASKED.findall(text.lower()) if raw[48:58].sum() + raw[64] + raw[36] + raw[33] + raw[42] else []
    unmasked = sum(w.translate(UNMASK).replace(" ", "") in words or w.translate(UNMASK).replace(" ", "") in fixed for w in masked)
    return [
        math.log(n), sum(w in fixed for w in found) / n, len(learned) / n, len(learned), sum(learned) / n, max(learned, default=0.0),
        len(begun) / n, len(begun), sum(begun) / n, max(begun, default=0.0), near / max(1, len(hits)), near, len(yours) / n,
        upper / size, punct / size, marks / size, len(REPEATED.findall(text)) / n, raw[48:58].sum() / size, len(masked) / n, unmasked, len(SPACED.findall(text)) / n,
    ]


FIXED, PERSON = frozenset(INSULTS), frozenset(SECOND_PERSON)


@dataclass
class Trees:
    """Complete trees of ``DEPTH`` levels: feature and threshold of each inner node, value of each leaf."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, c, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            out += leaf[node - (1 << DEPTH) + 1]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = TREES) -> Trees:
    """Boosted trees of logistic loss with second-order leaves over quantile bins."""
    inner = (1 << DEPTH) - 1
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], 1)
    p0 = np.clip((weight * y).sum() / weight.sum(), 1e-6, 1 - 1e-6)
    model = Trees(float(np.log(p0 / (1 - p0))), np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    score = np.full(len(y), model.base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = weight * (y - p), weight * p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for at in range(inner):
            rows = node == at
            if weight[rows].sum() >= 2 * LEAST_LEAF:
                best, total_g, total_h = 1e-6, g[rows].sum(), h[rows].sum()
                for f in range(x.shape[1]):
                    if not len(edges[f]):
                        continue
                    b = binned[rows, f]
                    gs, hs, ws = (np.cumsum(np.bincount(b, v[rows], len(edges[f]) + 1))[:-1] for v in (g, h, weight))
                    fits = (ws >= LEAST_LEAF) & (weight[rows].sum() - ws >= LEAST_LEAF)
                    gain = np.where(fits, gs**2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g**2 / (total_h + 1), 0.0)
                    if gain.max() > best:
                        best, k = gain.max(), int(gain.argmax())
                        model.feature[t, at], model.cut[t, at] = f, edges[f][k]
            node = np.where(rows, 2 * at + 1 + (x[:, model.feature[t, at]] > model.cut[t, at]), node)
        leaf = node - inner
        model.leaf[t] = RATE * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
        score += model.leaf[t][leaf]
    return model


def isotonic(raw: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising step fit (pool adjacent violators), at the blocks' means."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []  # weight, weighted label, weighted raw
    for r, v, w in zip(raw[order], y[order], weight[order]):
        blocks.append([w, w * v, w * r])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    b = np.array(blocks)
    return b[:, 2] / b[:, 0], b[:, 1] / b[:, 0]


@dataclass
class Model:
    """``trees`` is None where there was nothing to learn; ``base`` is then the score of every text."""

    words: dict[str, float]
    stems: dict[str, float]
    trees: tuple | None
    knots: tuple | None
    base: float = 0.0

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.trees is None or not texts:
            return np.full(len(texts), self.base)
        raw = Trees(*self.trees).raw(np.array([features(t, self.words, self.stems) for t in texts]))
        # the trees order texts within a step of the calibration
        return 0.999 * np.interp(raw, *self.knots) + 0.001 / (1 + np.exp(-raw))


def _lexicon(rows: DataFrame, term) -> dict[str, float]:
    """Terms of which the log odds of toxic against other texts are surely high, with those odds."""
    each = rows.select("toxic", F.explode(F.array_distinct(term)).alias("term"))
    sizes = rows.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (sizes[0] + 1.0)) - F.log(b / (sizes[1] + 1.0))
    counted = each.groupBy("term").agg(F.count_if(F.col("toxic") == 1).alias("a"), F.count_if(F.col("toxic") == 0).alias("b")).where("a > 2")
    sure = counted.select("term", odds.alias("odds"), (odds - 1.96 * F.sqrt(1 / a + 1 / b)).alias("low")).where(F.col("low") > SURE)
    return {r.term: r.odds for r in sure.orderBy(F.desc("low"), "term").limit(LEXICON).collect()}


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", per_class: int = PER_CLASS) -> Model:
    """Learns from the rows of ``labels`` (key, label 0/1; null labels don't count, of several for a key the highest does).

    About ``per_class`` rows of each class are taken by a hash of the key; rows
    stand for the others of their class by weight.
    """
    marks = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("toxic"))
    sizes = {r[0]: r[1] for r in marks.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model({}, {}, None, None, 1.0 if sizes.get(1) else 0.0)
    share = F.when(F.col("toxic") == 1, min(1.0, per_class / sizes[1])).otherwise(min(1.0, per_class / sizes[0]))
    hashed = F.pmod(F.xxhash64(key), F.lit(1 << 20))
    chosen = marks.where(hashed < share * (1 << 20)).select(key, "toxic", F.pmod(F.xxhash64(key, F.lit("part")), F.lit(10)).alias("part"))
    # bounded by the sample's size
    rows = docs.select(key, F.coalesce(text, F.lit("")).alias("text")).join(F.broadcast(chosen), key)
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]+"), F.lit(0))
    lex_rows = rows.where("part < 4")
    word_odds = _lexicon(lex_rows, words)
    stem_odds = _lexicon(lex_rows, F.transform(F.filter(words, lambda w: F.length(w) > STEM), lambda w: F.substring(w, 1, STEM)))
    wide = annotate(rows.where("part >= 4"), {"x": T.ArrayType(T.DoubleType())}, lambda: lambda texts: [[features(t, word_odds, stem_odds) for t in texts]], "text", ["toxic", "part"])
    got = wide.collect()
    if len({r.toxic for r in got}) < 2:
        return Model(word_odds, stem_odds, None, None, sizes[1] / (sizes[0] + sizes[1]))
    x, y, part = np.array([r.x for r in got]), np.array([r.toxic for r in got], float), np.array([r.part for r in got])
    weight = np.where(y == 1, sizes[1] / min(sizes[1], per_class), sizes[0] / min(sizes[0], per_class))
    first = part < 8 if len({*y[part >= 8]}) == 2 and len({*y[part < 8]}) == 2 else np.ones(len(y), bool)
    last = ~first if not first.all() else first
    trees = boost(x[first], y[first], weight[first])
    knots = isotonic(trees.raw(x[last]), y[last], weight[last])
    return Model(word_odds, stem_odds, (trees.base, trees.feature, trees.cut, trees.leaf), knots)


def scored(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``THRESHOLD`` on).

    Null texts count as empty, which are scored like any other; input columns of
    the two names are replaced; repeated rows each get a row.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.words, model.stems, model.trees, model.knots, model.base))

    def make():
        gc.disable()  # a task makes no cycles
        m = Model(*shared.value)

        def run(texts):
            s = m.scores(texts)
            return s, (s >= THRESHOLD).astype(np.int32)

        return run

    return annotate(docs, {"score": T.DoubleType(), "predicted": T.IntegerType()}, make, text, keep)
