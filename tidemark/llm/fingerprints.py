"""Document fingerprints: SimHash of weighted terms, in DataFrame functions only.

Terms are three-word shingles, weighted by how often they occur. Each of the 128
bits of a term's hash votes with that weight; a fingerprint has the bits with more
than half of the votes. The votes for two bits share one long, so that a row's
fingerprint is 64 sums in one hash aggregate. Permuted block tables find all
fingerprints within a Hamming radius.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed

WORDS, BITS, RADIUS = 3, 128, 3
#: Buckets of neighbouring ids for each shuffle partition.
BUCKETS_PER_PARTITION = 4
#: Parts into which a hot fingerprint's asked rows are split.
SALTS = 64
LANES = (1 << 32) + 1
LOW = (1 << 32) - 1


def shingles(text: Column, words: int = WORDS) -> Column:
    """Array of structs of the words of each shingle, null where there are too few words; a text of too few words has one."""
    w = F.array_remove(F.split(text, r"[ \t-\r]+"), "")
    parts = [w, *[F.slice(w, i + 1, F.size(w)) for i in range(1, words)]]
    whole = F.slice(F.arrays_zip(*[p.alias(f"w{i}") for i, p in enumerate(parts)]), 1, F.greatest(F.size(w) - words + 1, F.lit(1)))
    return F.when(F.size(w) > 0, whole)


def votes(hashes: list[Column]) -> list[Column]:
    """Sums of the bits of 64-bit hashes, bits j and j + 32 of a hash in one long."""
    return [F.sum(F.shiftrightunsigned(h, j).bitwiseAND(F.lit(LANES))).alias(f"v{k}_{j}") for k, h in enumerate(hashes) for j in range(32)]


def elected(n: Column, count: int = 2) -> Column:
    """Hex digits of the bits that have over half of ``n`` votes."""

    def half(k: int, upper: bool) -> Column:
        out = F.lit(0).cast("long")
        for j in range(32):
            v = F.col(f"v{k}_{j}")
            ones = F.shiftrightunsigned(v, 32) if upper else v.bitwiseAND(F.lit(LOW))
            out = out + F.when(2 * ones > n, F.lit(1 << j)).otherwise(F.lit(0))
        return F.lpad(F.lower(F.hex(out)), 8, "0")

    return F.concat(*[half(k, upper) for k in range(count) for upper in (True, False)])


def fingerprints(texts: DataFrame, by: list[str], text: str = "text") -> DataFrame:
    """(``by``, fingerprint): 32 hex digits for each distinct value of ``by``; texts without a word: zeros.

    The rows of one ``by`` are taken together; where ``texts`` is partitioned by
    some of its columns already, nothing is shuffled.
    """
    s = texts.select(*by, F.explode_outer(shingles(F.col(text))).alias("s")).select(*by, F.concat_ws(" ", *[F.col(f"s.w{i}") for i in range(WORDS)]).alias("t"), F.col("s").isNotNull().alias("has"))
    hashes = s.select(*by, *[F.when(F.col("has"), h).alias(n) for n, h in (("h0", F.xxhash64("t")), ("h1", F.xxhash64(F.lit(1), "t")))])
    summed = hashes.groupBy(*by).agg(F.count("h0").alias("terms"), *votes([F.col("h0"), F.col("h1")]))
    return summed.select(*by, elected(F.col("terms")).alias("fingerprint"))


def _bits(fp: str | Column) -> list[Column]:
    """The four 32-bit quarters of a fingerprint as longs."""
    return [F.conv(F.substring(fp, 8 * i + 1, 8), 16, 10).cast("long") for i in range(BITS // 32)]


def differing(a: str, b: str) -> Column:
    """Number of bits in which two fingerprints differ."""
    out = F.lit(0)
    for x, y in zip(_bits(a), _bits(b)):
        out = out + F.bit_count(x.bitwiseXOR(y))
    return out


def likeness(a: str, b: str) -> Column:
    return 1.0 - differing(a, b) / BITS


def block_keys(fp: str, radius: int) -> Column:
    """Keys of the permuted tables. Of ``radius`` + 2 blocks of hex digits at least two are free of differences; each table leads with another two."""
    digits, blocks = BITS // 4, radius + 2
    cut = [round(i * digits / blocks) for i in range(blocks + 1)]
    part = [F.substring(fp, a + 1, b - a) for a, b in zip(cut, cut[1:])]
    return F.array(*[F.concat(F.lit(f"{i},{j}:"), part[i], part[j]) for i, j in combinations(range(blocks), 2)])


def within(fingerprints_: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(query, fingerprint, distance): for each distinct ``fingerprint`` of ``queries`` all distinct ones within ``radius`` bits, itself too."""
    asked = queries.select(F.col("fingerprint").alias("query")).distinct()
    tables = fingerprints_.select("fingerprint").distinct().select("fingerprint", F.explode(block_keys("fingerprint", radius)).alias("block"))
    keyed = asked.select("query", F.explode(block_keys("query", radius)).alias("block"))
    near = keyed.join(tables, "block").withColumn("distance", differing("query", "fingerprint")).where(F.col("distance") <= radius)
    return near.select("query", "fingerprint", "distance").distinct()


def bounds(docs: DataFrame, key: str, parts: int) -> list[int]:
    """Ascending values of ``key`` that cut the rows into about ``parts`` equal buckets; the first is the least."""
    ranged = docs.select(key).repartitionByRange(parts, key)
    got = ranged.groupBy(F.spark_partition_id()).agg(F.min(key).alias("first")).collect()
    return sorted({r.first for r in got}) or [0]


def bucket_of(key: str, cuts: list[int]) -> Column:
    """Number of the last cut at or below ``key``, by binary search."""
    at, steps = F.array(*[F.lit(c).cast("long") for c in cuts]), [1 << i for i in range(len(cuts).bit_length() - 1, -1, -1)]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda pos, s: F.when(F.get(at, pos + s) <= F.col(key), pos + s).otherwise(pos))


def neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(bucket, row, tail, id, text, next): each text (null: empty) with that of the next row by (``key``, text).

    Rows lie together in buckets of neighbouring ids. A bucket ends with a copy of
    its successor's first rows (``tail``), the last bucket with the first one's, so
    no row is out of reach of its neighbour. A null id comes first.
    """
    low = -(1 << 63)
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(low)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    parts = BUCKETS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = bounds(docs.select(F.coalesce(F.col(key).cast("long"), F.lit(low)).alias("id")), "id", parts)
    at = rows.withColumn("own", bucket_of("id", cuts))
    first = F.get(F.array(*[F.lit(c).cast("long") for c in cuts]), F.col("own")) == F.col("id")
    own, before = F.struct(F.col("own").alias("bucket"), F.lit(False).alias("tail")), F.struct(F.pmod(F.col("own") - 1, F.lit(len(cuts))).alias("bucket"), F.lit(True).alias("tail"))
    placed = at.select("id", "text", F.explode(F.when(first, F.array(own, before)).otherwise(F.array(own))).alias("p")).select("p.*", "id", "text")
    w = Window.partitionBy("bucket").orderBy("tail", "id", "text")
    return placed.select("bucket", F.row_number().over(w).alias("row"), "tail", "id", "text", F.coalesce(F.lead("text").over(w), F.lit("")).alias("next"))


def edited(text: str, other: str) -> Column:
    """``text`` with its last half (rounded down) replaced by the first as many code points of ``other``."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substr(F.col(text), F.lit(1), n - half), F.substr(F.col(other), F.lit(1), half))


def compared(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, with the likeness of both and of the next document's.

    Null texts count as empty; repeated rows each get a row (their next is the
    other copy); other columns of ``docs`` don't matter; the last document's next
    is the first, a single document's next is itself.
    """
    low = -(1 << 63)
    rows = neighbours(docs, key, text).withColumn("edited", edited("text", "next"))
    rows = rows.withColumns({"n_chars": F.char_length("text").cast("long"), "edited_sha256": F.sha2("edited", 256)})
    by = ["bucket", "row", "tail", "id", "n_chars", "edited_sha256"]
    pair = F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("text")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))
    both = rows.select(*by, F.explode(F.when(F.col("tail"), F.slice(pair, 1, 1)).otherwise(pair)).alias("p")).select(*by, "p.*")
    marked = fingerprints(both, [*by, "which"])
    wide = marked.groupBy(*by).agg(F.max(F.when(F.col("which") == 0, F.col("fingerprint"))).alias("fingerprint"), F.max(F.when(F.col("which") == 1, F.col("fingerprint"))).alias("edited_fingerprint"))
    w = Window.partitionBy("bucket").orderBy("row")
    full = wide.withColumn("following", F.coalesce(F.lead("fingerprint").over(w), F.col("fingerprint"))).where(~F.col("tail"))
    return full.select(F.nullif("id", F.lit(low)).alias(key), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness("fingerprint", "edited_fingerprint").alias("near_edited"), likeness("fingerprint", "following").alias("near_next"))


def near_counts(marked: DataFrame, key: str = "doc_id", every: int = 50, radius: int = RADIUS) -> DataFrame:
    """``marked`` with ``n_near``: for ids divisible by ``every``, the number of other fingerprints within ``radius`` bits; else null."""
    marked = checkpointed(marked)
    is_asked = F.coalesce(F.col(key) % every == 0, F.lit(False))
    asked = marked.where(is_asked)
    found = within(marked, asked, radius).groupBy("query").agg((F.count("*") - 1).alias("n_near"))
    # only asked rows are joined, a hot fingerprint's in parts
    salt = F.pmod(F.xxhash64(key, "n_chars"), F.lit(SALTS)).alias("salt")
    spread = found.select(F.col("query").alias("fingerprint"), "n_near", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    counted = asked.select("*", salt).join(spread, ["fingerprint", "salt"]).select(*marked.columns, "n_near")
    return counted.unionByName(marked.where(~is_asked).withColumn("n_near", F.lit(None).cast("long")))
