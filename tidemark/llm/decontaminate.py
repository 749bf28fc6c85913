"""Benchmark decontamination by CGK embedding, bit-sampling LSH and edit verification.

Texts and items are sequences of words (letters and digits, case ignored). A CGK
random walk copies a word to the output and moves on, or not, by a random bit of
word and step: few edits between two sequences become few differing places of
their walks. Each repetition samples some places of its own walk as a bucket key.
An item-sized window is looked up in the buckets of the items of its length; the
items that it meets there are candidates, and their word edit distance to the text
around the window is then computed exactly.

Which windows are looked up is exact: an item cut into one segment more than it may
have edits leaves one segment intact in every match (pigeonhole), so windows are
taken, at all shifts up to the edit bound, around stretches that are a segment of
some item of their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate

#: Least similarity (1 - edits / words of the item): items under five words may have no edit.
SIMILARITY = 0.8
#: Walks and places sampled from each for items of up to ``SHORT`` words; longer ones have walks in proportion, of one place less.
WALKS, PLACES, SHORT = 40, 3, 60
#: Items held by a worker at once; larger benchmarks are searched in blocks.
BLOCK_ITEMS = 20_000
#: Candidate windows embedded at once.
AT_ONCE = 4096
WORD = re.compile(r"\w+")
HIT = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("edits", T.IntegerType()), T.StructField("first_word", T.LongType())]), False)


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def edits_within(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance of ``item`` to any stretch of ``text``, and where the stretch starts."""
    n = len(text)
    row, start = np.zeros(n + 1, np.int64), np.arange(n + 1)
    cols = np.arange(n + 1)
    for i, w in enumerate(item, 1):
        subst, gone = row[:-1] + (text != w), row[1:] + 1
        new, at = np.concatenate([[i], np.minimum(subst, gone)]), np.concatenate([[0], np.where(subst <= gone, start[:-1], start[1:])])
        # insertions: running minimum of new - column
        best = np.minimum.accumulate(new - cols)
        from_ = np.maximum.accumulate(np.where(new - cols == best, cols, 0))
        row, start = best + cols, at[from_]
    end = int(row.argmin())
    return int(row[end]), int(start[end])


def bits(walks: int, steps: int) -> np.ndarray:
    """Random odd multipliers, one for each walk and step."""
    return np.random.default_rng(7).integers(1, 1 << 63, (walks, steps), np.uint64) * np.uint64(2) + np.uint64(1)


def effort(length: int) -> tuple[int, int]:
    """Walks, and places sampled from each, for items of ``length`` words."""
    return (WALKS, min(PLACES, 2 * length)) if length <= SHORT else (-(-WALKS * length // SHORT), PLACES - 1)


@lru_cache(maxsize=None)
def plan(length: int) -> tuple[np.ndarray, dict[int, list[int]]]:
    """Multipliers [walk, step] of the walks over ``length`` words, and the walks that sample each step."""
    walks, places = effort(length)
    rng = np.random.default_rng(length)
    wanted: dict[int, list[int]] = {}
    for walk in range(walks):
        for place in rng.choice(2 * length, places, replace=False).tolist():
            wanted.setdefault(place, []).append(walk)
    return bits(walks, 2 * length), wanted


def sampled(seqs: np.ndarray, length: int) -> np.ndarray:
    """[sequence, walk] -> bucket of the sampled places of the CGK walk over rows of ``length`` words; no two walks share a bucket."""
    turn, wanted = plan(length)
    walks = len(turn)
    # one row of words after another: the place of a walk is an index into all of them
    padded = np.concatenate([seqs.astype(np.uint64) + np.uint64(2), np.ones((len(seqs), 1), np.uint64)], axis=1)
    flat, first = padded.ravel(), (np.arange(len(seqs)) * (length + 1))[:, None]
    at = np.repeat(first, walks, axis=1)
    end = first + length
    keys = np.repeat(np.arange(walks, dtype=np.uint64)[None, :], len(seqs), axis=0)
    with np.errstate(over="ignore"):
        for t in range(max(wanted) + 1):
            now = flat[at]
            if t in wanted:
                keys[:, wanted[t]] = keys[:, wanted[t]] * np.uint64(0x9E3779B97F4A7C15) + now[:, wanted[t]]
            now *= turn[:, t]
            now >>= np.uint64(63)
            at += now.view(np.int64)
            np.minimum(at, end, out=at)
    return keys


@dataclass
class Benchmark:
    """Items as arrays of word numbers, the segments of the items of a length, and their LSH buckets."""

    items: list[tuple[int, str]]
    vocabulary: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.ids, self.seqs = [], []
        by_length: dict[int, list[int]] = {}
        segments: dict[int, dict[int, set]] = {}
        for item_id, text in self.items:
            seq = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            n = len(seq)
            if not n:
                continue
            by_length.setdefault(n, []).append(len(self.ids))
            self.ids.append(item_id), self.seqs.append(np.array(seq, np.int64))
            k = self.bound(n)
            cuts = [round(j * n / (k + 1)) for j in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                segments.setdefault(b - a, {}).setdefault(self.hash(self.seqs[-1][a:b], b - a)[0], set()).add((n, a))
        self.segments = {m: (np.array(sorted(x), np.uint64), [sorted(x[h]) for h in sorted(x)]) for m, x in segments.items()}
        #: by length: sorted buckets, and the item of each
        self.buckets = {}
        for n, at in by_length.items():
            keys = sampled(np.stack([self.seqs[i] for i in at]), n)
            order = np.argsort(keys, axis=None, kind="stable")
            self.buckets[n] = keys.ravel()[order], np.repeat(at, keys.shape[1])[order]

    @staticmethod
    def bound(n: int) -> int:
        """Edits that an item of ``n`` words may have."""
        return int((1 - SIMILARITY) * n + 1e-9)

    @staticmethod
    def hash(seq: np.ndarray, m: int) -> np.ndarray:
        """Hashes of all stretches of ``m`` words."""
        x, h = seq.astype(np.uint64), np.zeros(max(0, len(seq) - m + 1), np.uint64)
        with np.errstate(over="ignore"):
            for j in range(m):
                h = h * np.uint64(0xD6E8FEB86659FD93) + x[j : j + len(h)] + np.uint64(1)
        return h

    def windows(self, text: np.ndarray) -> set[tuple[int, int]]:
        """(words, start) of windows around stretches that are a segment of an item of that many words, as if nothing before had been edited."""
        found = set()
        for m, (hashes, where) in self.segments.items():
            h = self.hash(text, m)
            if not len(h):
                continue
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            for p in np.nonzero(hashes[at] == h)[0].tolist():
                found.update((n, p - a) for n, a in where[at[p]])
        return found

    def candidates(self, seqs: np.ndarray, n: int) -> set[tuple[int, int]]:
        """(row, item): items of ``n`` words that share a bucket with a row."""
        keys, items = self.buckets[n]
        own = sampled(seqs, n)
        first, last = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
        found = set()
        for row, walk in zip(*(x.tolist() for x in np.nonzero(last > first))):
            found.update((row, i) for i in items[first[row, walk] : last[row, walk]].tolist())
        return found

    def search(self, texts: list[str | None]) -> list[list[tuple[int, int, int]]]:
        """For each text, (item id, edits, first word) of the best match of each item that has one."""
        words, bounds, get = [], [0], self.vocabulary.get
        for t in texts:
            words += words_of(t)
            words.append("\n")  # no word: never in the vocabulary
            bounds.append(len(words))
        text = np.fromiter(map(get, words, repeat(0)), np.int64, len(words))
        starts = np.array(bounds)
        document = lambda place: int(np.searchsorted(starts, min(len(text) - 1, max(0, place)), "right")) - 1
        hits: list[dict[int, tuple[int, int]]] = [{} for _ in texts]
        wanted: dict[int, set[tuple[int, int]]] = {}
        for n, s in self.windows(text):
            # the segment lies in one document; the window may reach over its ends by the edits
            for d in {document(s), document(s + self.bound(n)), document(s + n - 1)}:
                if d < len(texts):
                    wanted.setdefault(n, set()).add((d, s))
        for n, places in wanted.items():
            # windows of one passage overlap in their shifts: each is embedded once
            k = self.bound(n)
            left = sorted({(d, s + shift) for d, s in places for shift in range(-k, k + 1)})
            for lo in range(0, len(left), AT_ONCE):
                self._verify(text, bounds, n, left[lo : lo + AT_ONCE], hits)
        return [sorted((self.ids[i], e, at) for i, (e, at) in h.items()) for h in hits]

    def _verify(self, text, bounds, n, places, hits) -> None:
        k = self.bound(n)
        lo = np.array([bounds[d] for d, _ in places])
        hi = np.array([bounds[d + 1] - 1 for d, _ in places])
        start = np.array([s for _, s in places])
        index = start[:, None] + np.arange(n)
        inside = (index >= lo[:, None]) & (index < hi[:, None])
        seqs = np.where(inside, text[np.clip(index, 0, len(text) - 1)], -1)
        for j, i in sorted(self.candidates(seqs, n)):
            d, a, b = places[j][0], max(lo[j], start[j] - k), min(hi[j], start[j] + n + k)
            if a >= b or (i in hits[d] and hits[d][i][0] == 0):
                continue
            edits, at = edits_within(self.seqs[i], text[a:b])
            if edits <= k and (i not in hits[d] or edits < hits[d][i][0]):
                hits[d][i] = edits, int(a - lo[j]) + at


def blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items on the driver, one block of bounded size after another; items without an id or a text are none."""
    rows = benchmark.where(F.col(text).isNotNull() & F.col(item).isNotNull()).select(F.col(item).cast("long"), text).distinct()
    parts = -(-max(1, rows.count()) // BLOCK_ITEMS)
    for p in range(parts):
        yield sorted(tuple(r) for r in rows.where(F.pmod(F.xxhash64(item, text), F.lit(parts)) == p).collect())


def searched(docs: DataFrame, items: list[tuple[int, str]], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``hits``: matches with items of one block."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def make():
        bench = Benchmark(shared.value)
        return lambda texts: [[[{"item_id": i, "edits": e, "first_word": w} for i, e, w in h] for h in bench.search(texts)]]

    return annotate(docs, {"hits": HIT}, make, text, keep)


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, item_id, edits, first_word) for each document and item that it contains.

    A document contains an item if a stretch of its words is within a fifth of the
    item's words in edits. Null and empty texts contain nothing, null items are
    none; equal items are each reported, repeated rows each get their rows.
    """
    found = None
    for items in blocks(benchmark):
        part = searched(docs, items, text, [key]).select(key, F.explode("hits").alias("h")).select(key, "h.*")
        found = part if found is None else found.union(part)
    return found


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that contain no item; all columns stay (but an input column ``hits``)."""
    for items in blocks(benchmark):
        docs = searched(docs, items, text).where(F.size("hits") == 0).drop("hits")
    return docs
