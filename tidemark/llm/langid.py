"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of one fixed public vocabulary.
A word's probability is the sum over all its segmentations into pieces (forward
algorithm, words of any length); a text's is the product over its words, and its score
the best language's posterior. Pieces never cross white space, so word scores are
computed once a worker and looked up afterwards.
"""

from __future__ import annotations

import base64
import gc
import math
import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, vocabulary_path
from .lattice import PieceTable, hashed

#: Expected number of training documents a language contributes at most.
PER_LABEL = 400
#: Rounds of expectation maximisation.
ROUNDS = 2
#: Pseudo-count of every piece in every language.
SMOOTH = 0.01
#: Words whose scores one worker remembers.
REMEMBERED = 300_000
#: Bytes from which on a word's sums are scaled on the way, so that they don't vanish.
LONG = 32
#: Numbers that a group of words may take at once.
CELLS = 4_000_000


def pieces(path: str | None = None) -> list[bytes]:
    """All pieces of a rank file that a word (a space, then letters) can contain, and every single byte."""
    path = path or vocabulary_path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        found = [base64.b64decode(line.split()[0]) for line in f if line.strip()]
    return sorted({p for p in found if IN_WORDS.fullmatch(p)} | {bytes([b]) for b in range(256)})


def piece_table(index: list[bytes]) -> PieceTable:
    """Table from piece hash to place in ``index``."""
    out = np.zeros(len(index), np.uint64)
    by_length = defaultdict(list)
    for i, p in enumerate(index):
        by_length[len(p)].append(i)
    for at in by_length.values():
        out[at] = hashed(_symbols([index[i] for i in at]))
    return PieceTable(out)


#: Words are runs of letters; case doesn't count.
WORD = re.compile(r"[^\W\d_]+")


IN_WORDS = re.compile(rb" ?[A-Za-z\x80-\xff]+")


def spelled(word: str) -> bytes:
    """A word as bytes after a space."""
    return b" " + word.encode("utf-8", "replace")


def _symbols(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1).astype(np.uint64)


def forward(words: list[bytes], table: PieceTable, probs: np.ndarray, longest: int) -> np.ndarray:
    """Log probability of words of one length, [word, language]: the sum over all segmentations. The last row of ``probs`` is zero."""
    length = len(words[0])
    rows = table.substrings(_symbols(words), longest)
    a, off = [np.ones((len(words), probs.shape[1]))], 0.0
    for e in range(1, length + 1):
        a.append(sum(a[e - k] * probs[rows[k - 1][:, e - k]] for k in range(1, min(longest, e) + 1)))
        if e > longest:
            a[e - longest - 1] = None
        if length > LONG and e % 8 == 0:
            # what no piece bridges any more may grow without bound; it only ever meets zeros
            now = a[e]
            off = off + np.log(now)
            for i in range(max(0, e - longest + 1), e + 1):
                a[i] = np.minimum(a[i] / now, 1e290)
    return off + np.log(a[length])


def _expected(words: list[bytes], counts: np.ndarray, table: PieceTable, p: np.ndarray, out: np.ndarray, longest: int) -> None:
    """Adds the expected piece counts of words of one length to ``out`` (forward-backward, in logarithms for long words)."""
    length = len(words[0])
    rows = table.substrings(_symbols(words), longest)
    spans = [(e, k) for e in range(1, length + 1) for k in range(1, min(longest, e) + 1)]
    if length <= LONG:
        a, b = np.zeros((2, length + 1, len(words)))
        a[0] = b[length] = 1.0
        for e, k in spans:
            a[e] += a[e - k] * p[rows[k - 1][:, e - k]]
        for e, k in reversed(spans):
            b[e - k] += p[rows[k - 1][:, e - k]] * b[e]
        weight = counts / a[length]
        for e, k in spans:
            r = rows[k - 1][:, e - k]
            out += np.bincount(r, a[e - k] * p[r] * b[e] * weight, len(out))
        return
    with np.errstate(divide="ignore"):
        lp = np.log(p)
    a, b = np.full((2, length + 1, len(words)), -np.inf)
    a[0] = b[length] = 0.0
    for e, k in spans:
        a[e] = np.logaddexp(a[e], a[e - k] + lp[rows[k - 1][:, e - k]])
    for e, k in reversed(spans):
        b[e - k] = np.logaddexp(b[e - k], lp[rows[k - 1][:, e - k]] + b[e])
    for e, k in spans:
        r = rows[k - 1][:, e - k]
        np.add.at(out, r, np.exp(a[e - k] + lp[r] + b[e] - a[length]) * counts)


@dataclass
class Model:
    """``langs`` sorted; ``index``: the pieces; ``probs`` [piece + 1, language], its last row zero."""

    langs: list[str]
    index: list[bytes]
    probs: np.ndarray

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.index), default=1)


def at_once(length: int, longest: int) -> int:
    """Words of ``length`` bytes in a group of bounded size."""
    return max(1, CELLS // (length * min(length, longest)))


def fit_counts(counts: dict[str, dict[str, int]], index: list[bytes], rounds: int = ROUNDS) -> Model:
    """Model from word counts by language."""
    langs, table, longest = sorted(counts), piece_table(index), max(map(len, index))
    probs = np.zeros((len(index) + 1, len(langs)))
    for g, lang in enumerate(langs):
        by_length = defaultdict(list)
        for w, c in counts[lang].items():
            by_length[len(spelled(w))].append((spelled(w), c))
        groups = [([w for w, _ in x[lo : lo + step]], np.array([c for _, c in x[lo : lo + step]], float)) for n, x in by_length.items() for step in (at_once(n, longest),) for lo in range(0, len(x), step)]
        guess = np.full(len(index) + 1, SMOOTH)  # at first: how often a piece occurs at all
        for words, c in groups:
            for r in table.substrings(_symbols(words), longest):
                guess += np.bincount(r.ravel(), np.repeat(c, r.shape[1]), len(guess))
        for _ in range(rounds):
            guess[-1] = 0.0
            p, guess = guess / guess.sum(), np.full(len(index) + 1, SMOOTH)
            for words, c in groups:
                _expected(words, c, table, p, guess, longest)
        guess[-1] = 0.0
        probs[:, g] = guess / guess.sum()
    return Model(langs, index, probs)


def fit(docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", per_label: int = PER_LABEL, vocabulary: str | None = None) -> Model:
    """Fits a model on labelled rows; rows with a null label or text don't count.

    Of each label about ``per_label`` rows are taken, by a hash of ``key``, so
    that what reaches the driver (word counts) does not grow with the table.
    """
    rows = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(F.col(label).cast("string")).count().collect()}
    if not sizes:
        return Model([], pieces(vocabulary), np.zeros((0, 0)))
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, per_label / n))])
    taken = rows.select(F.col(label).cast("string").alias("label"), F.col(text).alias("t"), F.xxhash64(F.col(key)).alias("h")).where(
        F.pmod("h", F.lit(1 << 20)) < F.element_at(share, F.col("label")) * (1 << 20)
    )
    counted = taken.select("label", F.explode(F.expr(r"regexp_extract_all(lower(t), '[\\p{L}]+', 0)")).alias("w")).groupBy("label", "w").count()
    counts: dict[str, dict[str, int]] = {k: {} for k in sizes}
    for r in counted.toLocalIterator():
        counts[r[0]][r[1]] = r[2]
    return fit_counts(counts, pieces(vocabulary))


class Scorer:
    """Scores texts; keeps the scores of words it has met."""

    def __init__(self, model: Model):
        self.model, self.known, self.table = model, {}, piece_table(model.index)
        gc.collect()  # a reused worker may hold what earlier tasks left
        gc.disable()  # a task makes no cycles, and has very many small objects
        self.scores = np.zeros((0, len(model.langs)))

    def score(self, words: list[str]) -> np.ndarray:
        """Log probabilities [word, language]."""
        by_length, out = defaultdict(list), np.zeros((len(words), len(self.model.langs)))
        for at, w in enumerate(words):
            by_length[len(spelled(w))].append(at)
        for length, group in by_length.items():
            step = at_once(length, self.model.longest)
            for lo in range(0, len(group), step):
                at = group[lo : lo + step]
                out[at] = forward([spelled(words[i]) for i in at], self.table, self.model.probs, self.model.longest)
        return out

    def learn(self, fresh: list[str]) -> None:
        for w in fresh:
            self.known[w] = len(self.known)
        self.scores = np.concatenate([self.scores, self.score(fresh)])

    def __call__(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = [], []
        if len(self.known) > REMEMBERED:
            self.known, self.scores = {}, np.zeros((0, len(self.model.langs)))
        docs = [WORD.findall(t.lower()) if self.model.langs and t and any(map(str.isalpha, t)) else [] for t in texts]
        fresh = {w for d in docs for w in d if w not in self.known}
        if fresh:
            self.learn(sorted(fresh))
        for d in docs:
            if not d:
                langs.append("und")
                scores.append(0.0)
                continue
            known = self.known
            total = self.scores[[known[w] for w in d]].sum(0)
            best = int(total.argmax())
            langs.append(self.model.langs[best])
            scores.append(1.0 / sum(math.exp(max(-700.0, x - total[best])) for x in total))
        return langs, scores


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (posterior, 0 to 1).

    ``und`` with score 0: null text, no letter in it, or nothing was learned.
    Input columns of these two names are replaced; repeated rows each get a row.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.index, model.probs))
    return annotate(docs, {"lang_pred": T.StringType(), "score": T.DoubleType()}, lambda: Scorer(Model(*shared.value)), text, keep)
