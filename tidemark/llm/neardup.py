"""Near-duplicate detection on 64-bit SimHashes by covering anchors.

Two fingerprints within three bits differ by at most one bit in one of their two
32-bit halves. Each half is 31 bits of a perfect Hamming code (covering radius 1)
and one free bit; the code words are the anchors. Every fingerprint has one home
anchor a half and is copied to all anchors within covering radius plus one (17 at
most), so each linked pair meets at the home of its smaller member. Equal
fingerprints are one class throughout; only links between different ones exist.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, checkpointed, fresh, unheld

#: Words in a shingle, and bits by which linked fingerprints differ at most.
WORDS, RADIUS = 3, 3
NO_ID = (1 << 63) - 1
MASKS = [sum(1 << p for p in range(1, 32) if p >> j & 1) for j in range(5)]


def simhash(text: str | None, words: int = WORDS) -> int:
    """Unsigned fingerprint: bits set in over half the hashes of all word shingles."""
    found = (text or "").encode("utf-8", "replace").lower().split()
    if not found:
        return 0
    n = max(1, len(found) - words + 1)
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = np.concatenate([[0], ends[:-1]])[:n].tolist()
    ends = (ends[min(words, len(found)) - 1 :] - 1).tolist()
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(joined[a:b], 42) for a, b in zip(starts, ends)], np.uint64)
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, 4096):
        part = hashes[lo : lo + 4096]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(sum(1 << b for b in np.nonzero(2 * ones > n)[0].tolist()))


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprinted(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``fp`` (long) of each whole text; null or wordless: 0."""
    return annotate(docs, {"fp": T.LongType()}, lambda: lambda texts: [[signed(simhash(t)) for t in texts]], text, keep)


def hexed(fp: str | Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _half(i: int) -> Column:
    return F.shiftrightunsigned("fp", 32 * i).bitwiseAND(0xFFFFFFFF)


def _syndrome(h: Column) -> Column:
    out = F.lit(0)
    for j, m in enumerate(MASKS):
        out = out + F.shiftleft(F.bit_count(h.bitwiseAND(F.lit(m))).bitwiseAND(1), j)
    return out


def _bit(p: Column) -> Column:
    """2^p, and 0 for p = 0: place 0 of the syndrome is no place of the code."""
    return F.when(p == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), p))


def homes(fps: DataFrame) -> DataFrame:
    """(fp, half, anchor): the nearest anchor of each half."""
    return fps.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("half"), _half(i).bitwiseXOR(_bit(_syndrome(_half(i)))).alias("anchor")) for i in (0, 1)])).alias("at")).select("fp", "at.*")


def copies(fps: DataFrame) -> DataFrame:
    """(fp, half, anchor): all anchors within covering radius plus one of each half."""
    at = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("half"), _half(i).alias("h"), _syndrome(_half(i)).alias("s")) for i in (0, 1)])).alias("x")).select("fp", "x.*")
    home = F.col("h").bitwiseXOR(_bit(F.col("s")))
    near = F.transform(
        F.filter(F.sequence(F.lit(1), F.lit(31)), lambda p: (F.col("s") != 0) & (p < p.bitwiseXOR(F.col("s")))),
        lambda p: F.col("h").bitwiseXOR(_bit(p)).bitwiseXOR(_bit(p.bitwiseXOR(F.col("s")))),
    )
    return at.select("fp", "half", F.explode(F.concat(F.array(home, home.bitwiseXOR(1)), near)).alias("anchor"))


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b), a < b as signed longs: all pairs of the distinct ``fp`` within ``radius`` (3 at most) bits."""
    if not 0 <= radius <= RADIUS:
        raise ValueError("the halves' anchors cover three bits at most")
    home, copy = homes(fps).alias("x"), copies(fps).alias("y")
    near = (F.col("x.fp") < F.col("y.fp")) & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= radius)
    met = home.join(unheld(copy), (F.col("x.half") == F.col("y.half")) & (F.col("x.anchor") == F.col("y.anchor")) & near)
    return met.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b); comp is the smallest node reachable.

    Each round sends a node to its least neighbour and contracts the edges, so
    they at least halve; nothing but an emptiness test reaches the driver.
    """
    left, steps = checkpointed(edges.select("a", "b").where("a <> b").distinct()), []
    while not left.isEmpty():
        both = left.select(F.col("a").alias("node"), F.col("b").alias("other")).union(left.select("b", "a"))
        step = checkpointed(both.groupBy("node").agg(F.least("node", F.min("other")).alias("to")))
        steps.append(step)
        a, b = step.select(F.col("node").alias("a"), F.col("to").alias("u")), step.select(F.col("node").alias("b"), F.col("to").alias("v"))
        left = checkpointed(left.join(unheld(a), "a").join(unheld(b), "b").where("u <> v").select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct())
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("comp")).limit(0)
    out = steps.pop().select("node", F.col("to").alias("comp"))
    while steps:
        later = out.select(F.col("node").alias("to"), "comp")
        out = steps.pop().join(unheld(later), "to", "left").select("node", F.coalesce("comp", "to").alias("comp"))
    return out


def classes(marked: DataFrame, key: str = "doc_id") -> DataFrame:
    """(fp, comp, component_id) of the rows' fingerprints: smallest ``fp`` and smallest ``key`` over all linked ones."""
    ids = checkpointed(marked.groupBy("fp").agg(F.min(F.coalesce(key, F.lit(NO_ID))).alias("first")))
    parts = components(links(ids.select("fp"))).withColumnRenamed("node", "fp")
    joined = checkpointed(ids.join(unheld(parts), "fp", "left").select("fp", "first", F.coalesce("comp", "fp").alias("comp")))
    lowest = joined.groupBy("comp").agg(F.min("first").alias("component_id"))
    return joined.join(unheld(lowest), "comp").select("fp", "comp", "component_id")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: ``key``, fingerprint (16 hex digits), component_id.

    Null ids are ignored where a component has others (else component_id is
    null); null and wordless texts have fingerprint 0 and are linked like any
    other. Repeated rows each get a row; further columns of ``docs`` don't matter.
    """
    marked = checkpointed(fingerprinted(docs, text, [key]))
    whole = marked.join(unheld(classes(marked, key)), "fp")
    return whole.select(key, hexed("fp").alias("fingerprint"), F.nullif("component_id", F.lit(NO_ID)).alias("component_id"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component: its smallest id (null last), then the least hash of the text, then of the whole row; all columns stay."""
    tag, whole, first, same, row = (fresh(c, *docs.columns) for c in ("tag", "whole", "first", "same", "row"))
    rows = docs.withColumns({tag: F.xxhash64(text), whole: F.xxhash64(*docs.columns)})
    marked = checkpointed(fingerprinted(rows.select(F.coalesce(key, F.lit(NO_ID)).alias(first), F.col(tag).alias(same), F.col(whole).alias(row), text), text, [first, same, row]))
    found = marked.join(unheld(classes(marked, first).select("fp", "comp")), "fp").groupBy("comp", F.struct(first, same, row).alias("who")).agg(F.count("*").alias("rows"))
    stay = checkpointed(found.groupBy("comp").agg(F.min(F.struct("who", "rows")).alias("x")).select("x.who.*", "x.rows"))
    kept = rows.join(unheld(stay), (F.coalesce(rows[key], F.lit(NO_ID)) == stay[first]) & (rows[tag] == stay[same]) & (rows[whole] == stay[row]), "left_semi")
    # rows that are alike in every column are one; where no kept row has a twin this changes nothing and is left out
    return (kept.dropDuplicates([key, tag, whole]) if not stay.where("rows > 1").isEmpty() else kept).drop(tag, whole)
