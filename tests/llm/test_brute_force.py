"""Operators and the pipeline against plain Python over whole tables."""

import itertools
import math
import random
import re
import struct
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

from tidemark.llm import decontaminate, fingerprints, langid, linededup, neardup, queries, secretscan, sentencepieces, toxicity, urlrules
from tidemark.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()


@pytest.fixture(scope="module")
def items():
    return duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet' ORDER BY 1").fetchall()


# 1


def contained(texts, items):
    """(text number, item id) -> edits, of every item within a fifth of its words of some stretch of a text."""
    vocabulary: dict = {}
    number = lambda t: np.array([vocabulary.setdefault(w, len(vocabulary)) for w in decontaminate.words_of(t)], np.int64)
    seqs, out = [(i, number(t)) for i, t in items], {}
    for k, t in enumerate(texts):
        words = number(t)
        for i, s in seqs:
            if len(s) and len(words) and (e := decontaminate.edits_within(s, words)[0]) <= int(0.2 * len(s) + 1e-9):
                out[k, i] = e
    return out


def test_benchmark_matches_against_exhaustive_search(spark, docs, items):
    short = [(9000, "the of and"), (9001, docs[3][1].split()[0]), (9002, " ".join(docs[5][1].split()[:4]))]
    want = contained([t for _, t, _ in docs], items + short)
    bench = spark.createDataFrame(items + short, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.matches(table(spark, SF, "documents"), bench).collect()}
    want = {(docs[k][0], i): e for (k, i), e in want.items()}
    assert set(got) <= set(want) and len(got) >= 0.98 * len(want) and len(want) > 3
    assert all(got[k] >= want[k] for k in got) and np.mean([got[k] == want[k] for k in got]) >= 0.95


@pytest.mark.parametrize("n", [1, 3, 4, 5, 9, 30, 60, 61, 100, 200, 400])
def test_recall_at_the_bound_by_length(n):
    rng, found = random.Random(n), []
    words = [f"w{i}" for i in range(500)]
    items = [(i, " ".join(rng.choices(words, k=n))) for i in range(30)]
    bench = decontaminate.Benchmark(items)
    for i, text in items:
        seq = text.split()
        for at in sorted(rng.sample(range(n), int(0.2 * n + 1e-9)), reverse=True):
            seq[at : at + 1] = rng.choice([[], ["qq"], [seq[at], "qq"]])
        found.append(i in {a for a, _, _ in bench.search([" ".join(["foo"] * 9 + seq + ["bar"] * 9)])[0]})
    assert np.mean(found) >= 0.95


# 2


def test_trees_against_plain_sums(monkeypatch):
    monkeypatch.setattr(toxicity, "TREES", 3)
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(120, 3)), 1)
    y, weight = (x[:, 0] + 0.3 * rng.normal(size=120) > 0).astype(float), rng.uniform(1, 2, 120)
    p0 = (weight * y).sum() / weight.sum()
    score = np.full(120, math.log(p0 / (1 - p0)))
    inner = (1 << toxicity.DEPTH) - 1
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, toxicity.BINS)[1:-1])) for c in x.T]
    for _ in range(3):
        p = 1 / (1 + np.exp(-score))
        g, h = weight * (y - p), weight * p * (1 - p)
        rows = {0: list(range(120))}
        for at in range(inner):
            mine, best, cut = rows.get(at, []), 1e-6, None
            total = [sum(v[i] for i in mine) for v in (g, h, weight)]
            if total[2] >= 2 * toxicity.LEAST_LEAF:
                for f, e in itertools.chain.from_iterable(((f, e) for e in edges[f]) for f in range(3)):
                    left = [i for i in mine if x[i, f] <= e]
                    lg, lh, lw = (sum(v[i] for i in left) for v in (g, h, weight))
                    gain = lg**2 / (lh + 1) + (total[0] - lg) ** 2 / (total[1] - lh + 1) - total[0] ** 2 / (total[1] + 1)
                    if lw >= toxicity.LEAST_LEAF and total[2] - lw >= toxicity.LEAST_LEAF and gain > best + 1e-12:
                        best, cut = gain, (f, e)
            rows[2 * at + 1] = [i for i in mine if cut is None or x[i, cut[0]] <= cut[1]]
            rows[2 * at + 2] = [i for i in mine if cut is not None and x[i, cut[0]] > cut[1]]
        for leaf in range(inner, 2 * inner + 1):
            mine = rows.get(leaf, [])
            score[mine] += toxicity.RATE * sum(g[i] for i in mine) / (sum(h[i] for i in mine) + 1)
    assert np.allclose(toxicity.boost(x, y, weight, 3).raw(x), score)


def test_isotonic_against_the_min_max_formula():
    rng = np.random.default_rng(3)
    x, w = np.sort(rng.normal(size=60)), rng.uniform(1, 2, 60)
    y = (rng.uniform(size=60) < 1 / (1 + np.exp(-x))).astype(float)
    mean = lambda a, b: (w[a : b + 1] * y[a : b + 1]).sum() / w[a : b + 1].sum()
    want = [max(min(mean(a, b) for b in range(i, 60)) for a in range(i + 1)) for i in range(60)]
    at, value = toxicity.isotonic(x, y, w)
    assert np.allclose(sorted(set(np.round(want, 9))), np.round(value, 9)) and (np.diff(at) > 0).all()


# 3


def p_values(token):
    """Encoding and the two p-values of a token, written out plainly."""
    if re.fullmatch("[0-9]+", token):
        return None
    name = next((k for k, (p, _) in secretscan.ALPHABETS.items() if re.search(p, token)), None)
    if not name:
        return None
    letters = secretscan.ALPHABETS[name][1]
    v = [letters.index(c) for c in (token.upper() if name == "hex" else token)]
    n, k = len(v), len(letters)
    cdf = lambda z: 1 / (1 + math.exp(-(1.5976 * z + 0.070566 * z**3)))
    squares = sum(c * c for c in Counter(v).values())
    z = (max(k / n * squares - n, 0) / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))
    p_chi = 1 - cdf(z / math.sqrt(2 / (9 * (k - 1))))
    high = sum(x >= k / 2 for x in v)
    runs = 1 + sum((a >= k / 2) != (b >= k / 2) for a, b in zip(v, v[1:]))
    expected = 2 * high * (n - high) / n + 1
    variance = (expected - 1) * (expected - 2) / (n - 1)
    p_runs = 2 * cdf(-abs((runs - expected) / math.sqrt(variance))) if variance > 0 else 0.0
    m = sum(v) / n
    spread = sum((x - m) ** 2 for x in v)
    lag = sum((a - m) * (b - m) for a, b in zip(v, v[1:]))
    p_serial = 2 * cdf(-abs((lag / spread + 1 / n) * math.sqrt(n))) if spread else 0.0
    sd = secretscan.OVERDISPERSION * math.sqrt(2 * secretscan.WORD_REPEATS * (1 - secretscan.WORD_REPEATS) / (n * (n - 1)))
    natural = 0.1 if name == "hex" else secretscan.WORD_REPEATS
    return min(1.0, 3 * min(p_chi, p_runs, p_serial)), cdf(((squares - n) / (n * (n - 1)) - natural) / sd)


def test_secret_spans_of_all_kinds_against_plain_python(spark, docs):
    import base64

    rng = random.Random(7)
    texts = [t for _, t, _ in docs[:60]]
    for _ in range(80):
        parts = [base64.b64encode(rng.randbytes(24)).decode(), rng.randbytes(16).hex(), "token=" + rng.randbytes(12).hex(), "thethethethethethetheandandand", "AKIA" + "".join(rng.choices("ABCDEFGHIJ0123", k=16)), "word", "1" * 25, "é"]
        texts.append(" ".join(rng.choices(parts, k=rng.randrange(30))))
    assign = re.compile(secretscan.PATTERNS["assign"], re.A)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secretscan.scanned(df).collect()}
    for i, t in enumerate(texts):
        base = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 12] + [(m.start(), k, m.end()) for k in (1, 2) for m in re.finditer(secretscan.PATTERNS[secretscan.KINDS[k]], t)]
        tests = []
        for m in re.finditer(secretscan.PATTERNS["random"], t):
            if any(a < m.end() and b > m.start() for a, _, b in base) or (p := p_values(m[0])) is None:
                continue
            tests.append((p[1] if p[0] >= secretscan.REJECT else 1.0, (m.start(), 3, m.end())))
        tests.sort()
        last = max([k for k, (p, _) in enumerate(tests, 1) if p <= k * secretscan.RATE / len(tests)], default=0)
        spans = sorted(base + [s for _, s in tests[:last]])
        assert got[i] == ",".join(f"{secretscan.KINDS[k]}:{a}:{b}" for a, k, b in spans), t


# 5


def simhash128(text):
    words = [w for w in re.split("[ \t-\r]+", text) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    second = xxhash.xxh64_intdigest(struct.pack("<i", 1), 42)
    out = 0
    for seed in (42, second):
        hashes = [xxhash.xxh64_intdigest(s.encode(), seed) for s in shingles]
        out = out << 64 | sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return out


def test_fingerprints_against_plain_python(spark, docs):
    got = {r.doc_id: r for r in queries.op5_fingerprints(spark, SF).collect()}
    fps = {d: simhash128(t) for d, t, _ in docs}
    for k, (d, t, _) in enumerate(docs):
        n, (d2, t2, _) = len(t), docs[(k + 1) % len(docs)]
        other = simhash128(t[: n - n // 2] + t2[: n // 2])
        like = lambda a, b: 1 - (a ^ b).bit_count() / 128
        r = got[d]
        assert (r.n_chars, int(r.fingerprint, 16), int(r.edited_fingerprint, 16)) == (n, fps[d], other)
        assert abs(r.near_edited - like(fps[d], other)) < 1e-12 and abs(r.near_next - like(fps[d], fps[d2])) < 1e-12
        assert r.n_near == (len({f for f in fps.values() if (f ^ fps[d]).bit_count() <= 3}) - 1 if d % 50 == 0 else None)


def test_neighbours_of_large_ids(spark):
    base = 1 << 60
    rows = [(base + i * 3, f"text {i} and more") for i in range(300)] + [(None, "none"), (-base, "low")]
    got = {r.id: r.next for r in fingerprints.neighbours(spark.createDataFrame(rows, "doc_id long, text string")).where("not tail").collect()}
    order = sorted((-(1 << 63) if i is None else i, t) for i, t in rows)
    assert got == {i: order[(k + 1) % len(order)][1] for k, (i, _) in enumerate(order)}


# 7


def test_mined_rules_against_all_token_sets(spark):
    rng = random.Random(9)
    rows = []
    for i in range(400):
        bad = rng.random() < 0.4
        host = rng.choice(["win.casino.test", "news.test", "shop.test"]) if bad else rng.choice(["news.test", "shop.test", "docs.test"])
        rows.append((i, f"http://{host}/{rng.choice(['a', 'b'])}/{'free' if bad and rng.random() < 0.7 else 'page'}?{rng.choice(['id', 'ref'])}={i}", bad))
    df = spark.createDataFrame(rows, "page_id long, url string, bad boolean")
    got = {tuple(r.antecedent): (round(r.confidence, 9), round(r.support, 9), r.checked) for r in urlrules.mined(df.select("page_id", "url"), df.select("page_id", "bad")).collect()}
    sets = {r[0]: frozenset(r[1]) for r in df.select("page_id", urlrules.tokens("url")).collect()}
    held = {i for i, _, _ in rows if xxhash.xxh64_intdigest(struct.pack("<q", i), 42) % urlrules.FOLDS == 0}
    learn, kept = [(sets[i], b) for i, _, b in rows if i not in held], [(sets[i], b) for i, _, b in rows if i in held]
    n, base = len(learn), sum(b for _, b in learn)
    support = max(urlrules.SUPPORT, min(1.0, urlrules.LEAST_COUNT / n))
    sure = {}
    for a in {frozenset(c) for s, _ in learn for k in range(1, len(s) + 1) for c in itertools.combinations(s, k)}:
        hits, all_ = sum(a <= s and b for s, b in learn), sum(a <= s for s, _ in learn)
        if hits >= math.ceil(support * n) and hits / all_ >= max(urlrules.CONFIDENCE, urlrules.LIFT * base / n):
            sure[a] = (hits / all_, hits / n)
    want = {}
    for a, (confidence, share) in sure.items():
        if any(sure.get(a - {x}, (0,))[0] >= confidence for x in a):
            continue
        seen = [b for s, b in kept if a <= s]
        if not seen or np.mean(seen) >= urlrules.CONFIDENCE:
            want[tuple(sorted(a))] = (round(confidence, 9), round(share, 9), len(seen))
    assert got == want and want
    verdicts = {r.page_id: r.verdict for r in urlrules.judged(df.select("page_id", "url"), urlrules.mined(df.select("page_id", "url"), df.select("page_id", "bad"))).collect()}
    assert verdicts == {i: "block" if any(set(a) <= sets[i] for a in want) else "allow" for i in sets}


# 8


def components(fps):
    """Least key of each key's component over fingerprints within three bits."""
    name = {d: d for d in fps}

    def root(d):
        while name[d] != d:
            d = name[d]
        return d

    for a, b in itertools.combinations(sorted(fps), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 3:
            x, y = sorted((root(a), root(b)))
            name[y] = x
    return {d: root(d) for d in fps}


def test_component_ids_against_all_pairs(spark, docs):
    fps = {d: neardup.simhash(t) for d, t, _ in docs}
    want = components(fps)
    got = queries.op8_neardup(spark, SF).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in got} == {d: (fps[d], want[d]) for d in fps}


# the pipeline


def near_lines(found):
    """Places of lines to remove, of (place, line) in order: those that an earlier one equals or is within the wide bound of."""
    first, out = {}, set()
    for at, x in found:
        if x in first:
            out.add(at)
        else:
            first[x] = at
    by_size: dict = {}
    numbers: dict = {}
    rows = [(at, np.array([numbers.setdefault(w, len(numbers)) for w in x.split(" ")])) for x, at in first.items()]
    for at, w in rows:
        n = len(w)
        if n >= linededup.FEWEST:
            reach = max(1, math.ceil(n / (linededup.PER_EDIT - 1)) + 1)
            bags = [v for m in range(max(linededup.FEWEST, n - reach), n + reach + 1) for v in by_size.get(m, [])]
            for v in bags:
                longer = max(n, len(v))
                bound = longer // linededup.PER_EDIT if longer >= 20 else 1
                if abs(n - len(v)) <= bound and len(np.setdiff1d(w, v)) <= bound and edits(w, v) <= bound:
                    out.add(at)
                    break
            by_size.setdefault(n, []).append(w)
    return out


def edits(a, b):
    row = np.arange(len(b) + 1)
    for i, x in enumerate(a, 1):
        new = np.concatenate([[i], np.minimum(row[:-1] + (b != x), row[1:] + 1)])
        row = np.minimum.accumulate(new - np.arange(len(b) + 1)) + np.arange(len(b) + 1)
    return int(row[-1])


def test_pipeline_stage_by_stage(spark, docs, items):
    import corpus_pipeline

    counts: dict = {}
    for d, t, lang in docs:
        if zlib.crc32(str(d).encode()) % 5 and lang is not None and t is not None:
            counts.setdefault(lang, Counter()).update(langid.WORD.findall(t.lower()))
    langs, scores = langid.Scorer(langid.fit_counts(counts, langid.pieces()))([t for _, t, _ in docs])
    kept = {d: (t, lang) for (d, t, _), lang, s in zip(docs, langs, scores) if lang != "und" and s >= corpus_pipeline.LANGUAGE_SCORE}
    lines = [((d, i), x.strip(" ")) for d, (t, _) in kept.items() for i, x in enumerate(t.split("\n")) if x.strip(" ")]
    gone = near_lines(lines)
    after = {d: ("\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone), lang) for d, (t, lang) in kept.items()}
    after = {d: (t, lang) for d, (t, lang) in after.items() if t.strip(" ") or not any((d, i) in gone for i in range(kept[d][0].count("\n") + 1))}
    groups = components({d: neardup.simhash(t) for d, (t, _) in after.items()})
    single = {d: v for d, v in after.items() if groups[d] == d}
    hit = {k for k, _ in contained([t for t, _ in single.values()], items)}
    want = {d: v for k, (d, v) in enumerate(single.items()) if k not in hit}
    v = sentencepieces.load()
    got = {r.doc_id: (sentencepieces.decode(r.ids, v), r.lang) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


@pytest.mark.parametrize("stage", range(5))
def test_pipeline_stages_on_odd_tables(spark, stage):
    """Empty tables, null texts, languages and ids, equal rows and rows of one id."""
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "one two three four five six", "en", "s", 27), (1, "one two three four five six", "en", "s", 27), (None, None, None, None, None), (2, "", "de", None, 0), (None, "seven eight nine ten eleven twelve", None, "s", 5), (3, "é" * 4000, "fr", "s", 4000)]
    _, f = corpus_pipeline.STAGES[stage]
    for some in (rows, []):
        out = f(spark, spark.createDataFrame(some, schema), SF)
        assert stage == 4 or out.columns == corpus_pipeline.COLUMNS
        assert out.count() <= len(some)
