"""Secret scan, in DataFrame functions only: patterns and a randomness test battery.

Three patterns give the base spans. Further tokens are judged by their characters:
for the encoding that a token's alphabet implies, chi-squared uniformity, a runs
test and lag-one serial correlation must not reject randomness; and its repeat
rate must be too low for words, a p-value that gets stronger with length. Over a
document's tokens these p-values go through Benjamini-Hochberg control; tokens that
the battery rejects stay in the family with p = 1, so it is fixed beforehand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KINDS = ["assign", "access", "hex", "random"]
#: With the filters on length folded in where that finds the same spans.
PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{14,}",
    "hex": r"[0-9a-f]{16,}",
    "random": r"[A-Za-z0-9+/_-]{20,}",
}
LEAST_VALUE = 12
#: Alphabets by encoding, most special first; plain numbers are no candidates.
ALPHABETS = {
    "hex": (r"^(?:[0-9A-F]+|[0-9a-f]+)$", "0123456789ABCDEF"),
    "base32": (r"^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    "base64": (r"^[A-Za-z0-9+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    "base64url": (r"^[A-Za-z0-9_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
}
#: Level at which a test of the battery rejects randomness; false-discovery rate of a document's tokens.
REJECT, RATE = 0.001, 0.05
#: Probability that two characters of a word-like token agree, and how much more it varies than by chance.
WORD_REPEATS, OVERDISPERSION = 0.065, 2.0


def normal_cdf(z: Column) -> Column:
    """Logistic approximation, off by 0.0002 at most."""
    return 1.0 / (1.0 + F.exp(-(1.5976 * z + 0.070566 * z * z * z)))


def two_sided(z: Column) -> Column:
    return 2.0 * normal_cdf(-F.abs(z))


def encoding(token: str) -> Column:
    out = F.when(F.col(token).rlike("^[0-9]+$"), F.lit(None).cast("string"))
    for name, (pattern, _) in ALPHABETS.items():
        out = out.when(F.col(token).rlike(pattern), F.lit(name))
    return out


def battery(df: DataFrame, token: str = "token") -> DataFrame:
    """``df`` with ``encoding``, ``p_random`` (that a random token looks at most as random) and ``p_words`` (that a word-like one looks as random), null without an encoding."""
    n = F.length(token).cast("double")
    alphabet, size = F.lit(""), F.lit(0.0)
    for name, (_, letters) in ALPHABETS.items():
        alphabet, size = F.when(F.col("encoding") == name, F.lit(letters)).otherwise(alphabet), F.when(F.col("encoding") == name, F.lit(float(len(letters)))).otherwise(size)
    df = df.withColumn("encoding", encoding(token)).withColumns({"_n": n, "_k": size, "_alphabet": alphabet})
    chars = F.split(F.when(F.col("encoding") == "hex", F.upper(token)).when(F.col("encoding").isNotNull(), F.col(token)), "")
    df = df.withColumn("_v", F.transform(chars, lambda c: (F.call_function("locate", c, F.col("_alphabet")) - 1).cast("double")))
    shifted = F.slice(F.col("_v"), 2, F.size("_v"))
    first = F.slice(F.col("_v"), 1, F.size("_v") - 1)
    total = lambda a, f: F.aggregate(a, F.lit(0.0), lambda s, x: s + f(x))
    df = df.withColumns({
        "_squares": total(F.array_distinct("_v"), lambda x: F.pow(F.size(F.filter("_v", lambda y: y == x)).cast("double"), F.lit(2.0))),
        "_mean": total(F.col("_v"), lambda x: x) / F.col("_n"),
        "_high": total(F.col("_v"), lambda x: F.when(x >= F.col("_k") / 2, 1.0).otherwise(0.0)),
        "_changes": total(F.zip_with(first, shifted, lambda x, y: F.when((x >= F.col("_k") / 2) != (y >= F.col("_k") / 2), 1.0).otherwise(0.0)), lambda x: x),
    })
    df = df.withColumns({
        "_spread": total(F.col("_v"), lambda x: F.pow(x - F.col("_mean"), F.lit(2.0))),
        "_lag": total(F.zip_with(first, shifted, lambda x, y: (x - F.col("_mean")) * (y - F.col("_mean"))), lambda x: x),
    })
    df_ = F.col("_k") - 1
    chi = F.col("_k") / F.col("_n") * F.col("_squares") - F.col("_n")
    z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / df_, F.lit(1 / 3)) - (1 - 2 / (9 * df_))) / F.sqrt(2 / (9 * df_))
    expected = 2 * F.col("_high") * (F.col("_n") - F.col("_high")) / F.col("_n") + 1
    variance = (expected - 1) * (expected - 2) / (F.col("_n") - 1)
    p_runs = F.when(variance > 0, two_sided((F.col("_changes") + 1 - expected) / F.sqrt(variance))).otherwise(F.lit(0.0))
    p_serial = F.when(F.col("_spread") > 0, two_sided((F.col("_lag") / F.col("_spread") + 1 / F.col("_n")) * F.sqrt("_n"))).otherwise(F.lit(0.0))
    repeats = (F.col("_squares") - F.col("_n")) / (F.col("_n") * (F.col("_n") - 1))
    sd = OVERDISPERSION * F.sqrt(2 * WORD_REPEATS * (1 - WORD_REPEATS) / (F.col("_n") * (F.col("_n") - 1)))
    natural = F.when(F.col("encoding") == "hex", F.lit(0.1)).otherwise(F.lit(WORD_REPEATS))
    known = F.col("encoding").isNotNull()
    return df.withColumns({
        "p_random": F.when(known, F.least(F.lit(1.0), 3 * F.least(1 - normal_cdf(z_chi), p_runs, p_serial))),
        "p_words": F.when(known, normal_cdf((repeats - natural) / sd)),
    }).drop("_n", "_k", "_alphabet", "_v", "_squares", "_mean", "_high", "_changes", "_spread", "_lag")


def found_by(kind: str) -> Column:
    """Array of the matches of one kind with the length of the text before each of them since the last."""
    match = F.regexp_extract_all("_text", F.lit(PATTERNS[kind]), F.lit(0))
    before = F.slice(F.split("_text", PATTERNS[kind], -1), 1, F.size(match))

    def one(b: Column, m: Column) -> Column:
        value = F.length(F.regexp_extract(m, PATTERNS["assign"], 2)) if kind == "assign" else F.lit(LEAST_VALUE)
        token = m if kind == "random" else F.lit(None).cast("string")
        return F.struct(F.lit(KINDS.index(kind)).alias("kind"), F.length(b).alias("gap"), F.length(m).alias("size"), (value >= LEAST_VALUE).alias("good"), token.alias("token"))

    return F.when(F.col("_text").rlike(PATTERNS[kind]), F.zip_with(before, match, one)).otherwise(F.array().cast("array<struct<kind:int,gap:int,size:int,good:boolean,token:string>>"))


def spans_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: ``key``, ``base`` and ``extra``, ascending arrays of (start, kind, end) in code points.

    ``extra`` are the random-looking tokens that overlap no base span. Null texts
    count as empty; repeated rows each get a row; other columns don't matter.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    hits = rows.select("_row", "_key", F.concat(*[found_by(k) for k in KINDS]).alias("_hits"))
    each = hits.select("_row", "_key", F.posexplode_outer("_hits").alias("_at", "_hit")).select("_row", "_key", "_at", "_hit.*").repartition("_row")
    w = Window.partitionBy("_row", "kind").orderBy("_at")
    placed = each.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(w)).withColumn("start", F.col("end") - F.col("size"))
    is_random = F.col("kind") == KINDS.index("random")
    # base spans that start at or before a token, and at or after it: whether one of them overlaps it
    is_base, up_to, from_ = ~is_random & F.col("good"), (Window.unboundedPreceding, 0), (0, Window.unboundedFollowing)
    by_start = Window.partitionBy("_row").orderBy("start")
    covered = (F.max(F.when(is_base, F.col("end"))).over(by_start.rangeBetween(*up_to)) > F.col("start")) | (F.min(F.when(is_base, F.col("start"))).over(by_start.rangeBetween(*from_)) < F.col("end"))
    judged = battery(placed.withColumn("covered", F.coalesce(covered, F.lit(False)))).withColumn("span", F.struct("start", "kind", "end"))
    # a token that the battery rejects counts among the tests with p = 1: the family is fixed before any test is seen
    p = F.when(F.col("p_random") >= REJECT, F.col("p_words")).otherwise(F.lit(1.0))
    gathered = judged.groupBy("_row", "_key").agg(
        F.array_sort(F.collect_list(F.when(is_base, F.col("span")))).alias("base"),
        F.array_sort(F.collect_list(F.when(is_random & ~F.col("covered") & F.col("encoding").isNotNull(), F.struct(p.alias("p"), F.col("span").alias("span"))))).alias("tests"),
    )
    # the largest i with p(i) <= i * rate / m; all up to there are found
    last = F.array_max(F.transform("tests", lambda t, i: F.when(t["p"] <= (i + 1) * RATE / F.size("tests"), i + 1).otherwise(0)))
    extra = F.array_sort(F.transform(F.slice("tests", 1, F.coalesce(last, F.lit(0))), lambda t: t["span"]))
    return gathered.select(F.col("_key").alias(key), "base", extra.alias("extra"))


def written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and spans of each document, written as kind:start:end by start, then kind."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return spans_of(docs, key, text).select(
        key, *[count(k) for k in KINDS[:3]], F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.array_sort(F.concat("base", "extra"))).alias("spans"), F.size("extra").cast("long").alias("n_random")
    )
