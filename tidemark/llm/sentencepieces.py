"""SentencePiece encoding and decoding with N-best segmentation.

The lattice has an edge for every vocabulary piece; a character without one gets
an edge of byte pieces at a penalty. A forward Viterbi pass gives the best score
of every prefix. That score is the exact heuristic of an A* search which runs
backwards from the end and yields segmentations best first.

No piece joins a letter to a following non-letter, and white space only starts
a piece, so the lattice falls apart into chunks (spaces, then letters or others). Chunks are searched once a worker; a text's N best
follow exactly from its chunks' N best.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import annotate, vocabulary_path
from .lattice import PieceTable, hashed

#: Segmentations returned for a text.
N_BEST = 3
#: Added to the lowest piece score for a character that no piece covers.
UNKNOWN_PENALTY = -10.0
#: Scores at or below this mark pieces set apart by the vocabulary, not ranked ones.
SPECIAL = -1e8
#: Classes of characters that no piece of a usable vocabulary has side by side.
NOT_LETTERS = r"\W\d_\u00b2\u00b3\u00b9"
LETTER, OTHER = f"[^{NOT_LETTERS}]", f"(?:(?![ \\n])[{NOT_LETTERS}])"
#: Chunks one worker remembers; the longest that are searched many at once.
REMEMBERED, LONGEST_AT_ONCE = 50_000, 40
CHUNK = re.compile(f" *{LETTER}+| *{OTHER}+|\\n| +")


def _symbols(words: list[str]) -> np.ndarray:
    """[word, code point] of words of one length."""
    return np.array(words).view(np.uint32).reshape(len(words), -1).astype(np.uint64)


@dataclass
class Vocabulary:
    """``pieces``: text with plain spaces -> (score, id); ``raw``: id -> bytes; ``byte_ids``: byte -> id."""

    pieces: dict[str, tuple[float, int]]
    raw: list[bytes]
    byte_ids: list[int]
    longest: int = field(init=False)
    worst: float = field(init=False)
    splits: bool = field(init=False)

    def parts(self) -> tuple:
        return self.pieces, self.raw, self.byte_ids

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.pieces), default=1)
        self.worst = min((s for s, _ in self.pieces.values() if s > SPECIAL), default=0.0) + UNKNOWN_PENALTY
        bad = ("[^ ] ", f"{LETTER}[{NOT_LETTERS}]", f"(?! )[{NOT_LETTERS}]{LETTER}", ".\\n|\\n.")
        self.splits = not any(re.search(x, p) for p in self.pieces for x in bad)


def load(path: str | None = None) -> Vocabulary:
    """Vocabulary of a model file with byte pieces."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path or vocabulary_path("piece_bpe_32k.model"))
    pieces, raw, byte_ids = {}, [], [0] * 256
    for i in range(m.get_piece_size()):
        p = m.id_to_piece(i)
        if m.is_byte(i):
            raw.append(bytes([int(p[1:-1], 16)]))
            byte_ids[raw[-1][0]] = i
        elif m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
            raw.append(b"")
        else:
            p = p.replace("▁", " ")
            raw.append(p.encode())
            pieces[p] = (m.get_score(i), i)
    return Vocabulary(pieces, raw, byte_ids)


def n_best(chunk: str, v: Vocabulary, n: int = N_BEST) -> list[tuple[float, list[int]]]:
    """The ``n`` best segmentations of ``chunk`` as (score, ids), best first; equal scores in search order."""
    get, size, longest = v.pieces.get, len(chunk), v.longest
    best = [0.0] + [float("-inf")] * size
    edges: list[list] = [[]]
    for e in range(1, size + 1):
        here, top = [], float("-inf")
        for j in range(max(0, e - longest), e):
            if hit := get(chunk[j:e]):
                here.append((j, hit[0], (hit[1],)))
                top = max(top, best[j] + hit[0])
        if not here or here[-1][0] != e - 1:
            here.append((e - 1, v.worst, tuple(v.byte_ids[b] for b in chunk[e - 1].encode())))
            top = max(top, best[e - 1] + v.worst)
        edges.append(here)
        best[e] = top
    # Each open node stands for at least one whole segmentation of score f, and no
    # two share one: beyond the n best, open nodes can't reach the result.
    found, open_nodes, order = [], [(-best[size], 0, size, 0.0, None)], 0
    while open_nodes and len(found) < n:
        f, _, at, rest, path = heapq.heappop(open_nodes)
        if at == 0:
            ids = []
            while path is not None:
                ids.extend(path[0])
                path = path[1]
            found.append((-f, ids))
            continue
        for j, s, ids in edges[at]:
            order -= 1
            heapq.heappush(open_nodes, (-(best[j] + s + rest), order, j, s + rest, (ids, path)))
        if len(open_nodes) > 64 + n:
            open_nodes = heapq.nsmallest(n - len(found), open_nodes)
    return found


def merge(gaps: list[list[float]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``n`` least sums of one entry from each ascending list that starts with 0, with the entries taken."""
    sums: list[tuple[float, tuple[int, ...]]] = [(0.0, ())]
    for g in gaps:
        sums = heapq.nsmallest(n, [(s + x, (*took, k)) for s, took in sums for k, x in enumerate(g)])
    return sums


def decode(ids: list[int], v: Vocabulary) -> str:
    """Text of ids; the space put before every text is taken off again."""
    return b"".join(map(v.raw.__getitem__, ids)).decode("utf-8", "replace")[1:]


class Encoder:
    """Encodes batches of texts; keeps the segmentations of chunks it has met."""

    def __init__(self, v: Vocabulary, n: int = N_BEST):
        self.v, self.n = v, n
        self.split = CHUNK if v.splits else re.compile(r"(?s).+")
        by_length: dict[int, list] = {}
        for p, (s, i) in v.pieces.items():
            by_length.setdefault(len(p), []).append((p, s, i))
        listed = [x for group in by_length.values() for x in group]
        self.table = PieceTable(np.concatenate([hashed(_symbols([p for p, _, _ in group])) for group in by_length.values()]))
        self.scores = np.array([s for _, s, _ in listed] + [-np.inf])
        self.ids = np.array([i for _, _, i in listed] + [0], np.int32)
        gc.collect()  # a reused worker may hold what earlier tasks left
        gc.disable()  # a task makes no cycles, and has very many small objects
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chunks: list[str] = []
        self.searched: dict[int, list[tuple[float, list[int]]]] = {}
        self.best, self.gap = np.zeros(0), np.zeros(0)
        self.start, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def search(self, k: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations of the k-th chunk."""
        if k not in self.searched:
            self.searched[k] = n_best(self.chunks[k], self.v, self.n)
        return self.searched[k]

    def learn(self, fresh: list[str]) -> None:
        """Best segmentation of new chunks and the gap to the next best, for many chunks at once."""
        first = len(self.chunks)
        self.chunks += fresh
        for k, c in enumerate(fresh, first):
            self.known[c] = k
        best, gap = np.full(len(fresh), -np.inf), np.zeros(len(fresh))
        ids: list[np.ndarray] = [np.zeros(0, np.int32)] * len(fresh)
        by_length: dict[int, list[int]] = {}
        for k, c in enumerate(fresh):
            if len(c) <= LONGEST_AT_ONCE:
                by_length.setdefault(len(c), []).append(k)
        for length, at in by_length.items():
            step = max(1, 200_000 // length)
            for lo in range(0, len(at), step):
                self._viterbi([fresh[k] for k in at[lo : lo + step]], at[lo : lo + step], best, gap, ids)
        for k in np.nonzero(np.isinf(best))[0].tolist():  # long, or with a character that no piece covers
            hits = self.search(first + k)
            best[k], ids[k] = hits[0][0], np.array(hits[0][1], np.int32)
            gap[k] = best[k] - hits[1][0] if len(hits) > 1 else np.inf
        size = np.array([len(x) for x in ids], np.int64)
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
        self.size, self.flat = np.concatenate([self.size, size]), np.concatenate([self.flat, *ids])
        self.best, self.gap = np.concatenate([self.best, best]), np.concatenate([self.gap, gap])

    def _viterbi(self, chunks: list[str], at: list[int], best: np.ndarray, gap: np.ndarray, ids: list[np.ndarray]) -> None:
        n, length = len(chunks), len(chunks[0])
        rows = self.table.substrings(_symbols(chunks), self.v.longest)
        top, second = np.full((2, length + 1, n), -np.inf)
        top[0] = 0.0
        back = np.zeros((length + 1, n), np.int64)
        for e in range(1, length + 1):
            for k in range(1, min(len(rows), e) + 1):
                s = self.scores[rows[k - 1][:, e - k]]
                c = top[e - k] + s
                better = c > top[e]
                second[e] = np.maximum(np.maximum(second[e], second[e - k] + s), np.minimum(c, top[e]))
                back[e][better] = k
                top[e][better] = c[better]
        dead = np.isinf(top[length])
        best[at], gap[at] = top[length], np.where(dead, 0.0, np.where(dead, 0.0, top[length]) - second[length])
        good = np.nonzero(~np.isinf(top[length]))[0]
        path, pos, steps = np.full((n, length), -1, np.int32), np.full(n, length), np.zeros(n, np.int64)
        live = good
        while len(live):
            k, e = back[pos[live], live], pos[live]
            for size in np.unique(k).tolist():
                w = live[k == size]
                path[w, steps[w]] = self.ids[rows[size - 1][w, pos[w] - size]]
            steps[live] += 1
            pos[live] = e - k
            live = live[pos[live] > 0]
        for w in good.tolist():
            ids[at[w]] = path[w, : steps[w]][::-1]

    def __call__(self, texts: list[str]) -> list[tuple[np.ndarray, float, list[float]]]:
        """For each text: ids of the best segmentation, its score, and the scores of the n best."""
        if len(self.chunks) > REMEMBERED:
            self.forget()
        cut = [self.split.findall(" " + t) if t else [] for t in texts]
        if fresh := {c for d in cut for c in d if c not in self.known}:
            self.learn(sorted(fresh))
        out = []
        for d in cut:
            if not d:
                out.append((np.zeros(0, np.int32), 0.0, [0.0]))
                continue
            known = self.known
            ks = np.array([known[c] for c in d])
            size = self.size[ks]
            ends = np.cumsum(size)
            ids = self.flat[np.repeat(self.start[ks] - ends + size, size) + np.arange(ends[-1])]
            top, gap = float(self.best[ks].sum()), self.gap[ks]
            # at most n - 1 chunks differ from their best, and they have the least gaps
            near = np.arange(len(gap)) if len(gap) < self.n else np.argpartition(gap, self.n - 1)[: self.n - 1]
            hits = [self.search(int(ks[i])) for i in sorted(near) if np.isfinite(gap[i])]
            out.append((ids, top, [top - x for x, _ in merge([[h[0][0] - s for s, _ in h] for h in hits], self.n)]))
        return out


COLUMNS = {
    "n_pieces": T.LongType(),
    "ids": T.ArrayType(T.IntegerType(), False),
    "ids_sha256": T.StringType(),
    "best_score": T.DoubleType(),
    "nbest_scores": T.ArrayType(T.DoubleType(), False),
    "decoded_equal": T.BooleanType(),
}


def encode(docs: DataFrame, text: str = "text", keep: list[str] | None = None, vocabulary: str | None = None, n: int = N_BEST, columns: tuple[str, ...] = tuple(COLUMNS)) -> DataFrame:
    """``docs`` with the encoding of each whole text (null: as empty, which has no pieces).

    ``columns`` picks from: n_pieces, ids, ids_sha256 (of little-endian 32-bit
    ids), best_score, nbest_scores (descending, ``n`` at most), decoded_equal
    (decoding gives the text again). Input columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(vocabulary).parts())

    def make():
        coder = Encoder(Vocabulary(*shared.value), n)

        def run(texts):
            texts = [t or "" for t in texts]
            coded = coder(texts)
            rows = {"n_pieces": [len(x) for x, _, _ in coded], "ids": [x for x, _, _ in coded], "best_score": [s for _, s, _ in coded], "nbest_scores": [b for _, _, b in coded]}
            if "ids_sha256" in columns:
                rows["ids_sha256"] = [hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x, _, _ in coded]
            if "decoded_equal" in columns:
                rows["decoded_equal"] = [decode(x.tolist(), coder.v) == t for (x, _, _), t in zip(coded, texts)]
            return [rows[c] for c in columns]

        return run

    return annotate(docs, {c: COLUMNS[c] for c in columns}, make, text, keep)


def decoded(coded: DataFrame, ids: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """``coded`` with ``text`` decoded from the array column ``ids`` (null: empty)."""
    shared = coded.sparkSession.sparkContext.broadcast(load(vocabulary).parts())

    def make():
        v = Vocabulary(*shared.value)
        return lambda rows: [[decode(r or [], v) for r in rows]]

    return annotate(coded, {"text": T.StringType()}, make, ids)
