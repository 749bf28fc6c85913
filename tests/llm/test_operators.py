"""The training-data operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, fingerprints, langid, linededup, neardup, ppm, secretscan, sentencepieces, toxicity, urlrules
from tidemark.llm.common import checkpointed, released, table

SF = "/root/testdata/sf0.001"
ODD = [(5, "a b c d e f"), (1, "é" * 3000 + " b"), (2, None), (9, ""), (9, ""), (7, "..."), (3, "a b c d e f"), (None, "x y")]
SCHEMA = "doc_id long, text string, score string, hits int, fp string, copies string, near string, _id int, _tag int, gone int"


def odd(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns that have the names of added ones."""
    return spark.createDataFrame([(*r, "s", 1, "f", "c", "n", 7, 8, 9) for r in ODD], SCHEMA)


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()


def test_every_operator_takes_odd_and_empty_tables(spark):
    bench = spark.createDataFrame([(1, "a b c d e f"), (2, None), (3, "")], "item_id long, text string")
    labels = spark.createDataFrame([(5, 1), (1, 0), (3, None)], "doc_id long, toxic int")
    for df, n in ((odd(spark), len(ODD)), (odd(spark).limit(0), 0)):
        assert decontaminate.matches(df, bench).count() == (2 if n else 0)
        assert decontaminate.decontaminated(df, bench).count() == max(0, n - 2)
        assert toxicity.scored(df, toxicity.fit(df, labels)).count() == n
        assert secretscan.scanned(df).count() == n
        assert langid.predict(df, langid.fit(df.selectExpr("*", "'xx' AS lang"))).count() == n
        assert fingerprints.near_counts(fingerprints.compared(df)).count() == n
        assert ppm.scored(df).count() == n
        assert neardup.near_duplicates(df).count() == n
        assert sentencepieces.encode(df).where("decoded_equal").count() == n
        assert linededup.deduplicated(df).count() == n
    assert neardup.deduplicated(odd(spark)).count() == len({neardup.simhash(t) for _, t in ODD})


# 1


def test_decontamination_recall_at_the_bound():
    rng = random.Random(1)
    items = [(i, " ".join(rng.choices("alpha beta gamma delta eps zeta eta theta iota kappa".split(), k=rng.randrange(15, 60)))) for i in range(40)]
    bench, found = decontaminate.Benchmark(items), []
    for i, text in items:
        words = text.split()
        for _ in range(int(0.2 * len(words))):
            at = rng.randrange(len(words))
            words[at : at + rng.choice([0, 1])] = rng.choice([[], ["qq"]])
        hit = {a: e for a, e, _ in bench.search([" ".join(["foo"] * 9 + words + ["bar"] * 9)])[0]}
        found.append(i in hit)
    assert np.mean(found) >= 0.95


def test_edit_distance_matches_brute_force():
    rng = np.random.default_rng(0)

    def brute(a, b):
        best = len(a)
        for i, j in itertools.combinations_with_replacement(range(len(b) + 1), 2):
            row = list(range(j - i + 1))
            for x, w in enumerate(a, 1):
                row = list(itertools.accumulate(range(1, j - i + 1), lambda left, y: min(left + 1, prev[y] + 1, prev[y - 1] + (w != b[i + y - 1])), initial=x)) if (prev := row) else []
            best = min(best, row[-1])
        return best

    for _ in range(30):
        a, b = rng.integers(0, 3, rng.integers(1, 6)), rng.integers(0, 3, rng.integers(1, 9))
        assert decontaminate.edits_within(a, b)[0] == brute(list(a), list(b))


# 2


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(2)
    plain = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choices(plain, k=60) + (["grumbly", "sneerish"] if i % 4 == 0 else [])), i, int(i % 4 == 0)) for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long, toxic int")
    model = toxicity.fit(df.select("doc_id", "text"), df.where("doc_id < 900").select("doc_id", "toxic"))
    got = toxicity.scored(df.where("doc_id >= 900"), model).collect()
    assert np.mean([r.predicted == r.toxic for r in got]) > 0.98 and all(0 <= r.score <= 1 for r in got)


def test_isotonic_rises_and_keeps_the_mean():
    rng = np.random.default_rng(0)
    x, w = rng.normal(size=200), rng.uniform(1, 2, 200)
    y = (rng.uniform(size=200) < 1 / (1 + np.exp(-x))).astype(float)
    at, value = toxicity.isotonic(x, y, w)
    assert (np.diff(value) > 0).all() and (np.diff(at) > 0).all()


# 3


def test_secret_spans_against_python(spark):
    assign = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    rng = random.Random(3)
    parts = ["token=", "secret : ", "PASSWORD='", "api_key:", "AKIA", "é", " ", "abcdef0123456789", "ABCDEFGHIJKLMNOP", "=", "x", "_", "deadbeef"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randrange(12)))) for i in range(300)]
    got = {r.doc_id: r for r in secretscan.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 12] + [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18] + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        text = ",".join(f"{secretscan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert got[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest(), t


def test_random_tokens_are_found_and_words_are_not(spark):
    import base64

    rng = random.Random(4)
    rows = [(0, " ".join(f"go {base64.b64encode(rng.randbytes(30)).decode()}" for _ in range(20))), (1, "thethethethethetheandandandthethe /usr/local/lib/python/site-packages/some_long_name " * 5)]
    got = {r.doc_id: r.n_random for r in secretscan.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] >= 16 and got[1] == 0


# 4


def test_forward_sums_all_segmentations():
    model = langid.fit_counts({"a": {"the": 3, "then": 1}, "b": {"und": 2}}, langid.pieces())

    def brute(w, g):
        return 1.0 if not w else sum(model.probs[model.index.index(w[:k]), g] * brute(w[k:], g) for k in range(1, len(w) + 1) if w[:k] in model.index)

    got = langid.forward([b" then"], langid.piece_table(model.index), model.probs, model.longest)[0]
    assert np.allclose(got, [math.log(brute(b" then", g)) for g in range(2)])


@pytest.mark.parametrize("n", [5, 40, 300, 3000])
def test_forward_on_long_words(n):
    """Against a plain sum in logarithms over every piece of the vocabulary, at lengths where products vanish."""
    model = langid.fit_counts({"a": {"the": 3, "thentionally" * 9: 2}, "b": {"und": 2, "über" * 30: 1}}, langid.pieces())
    word = ("thentionüberunderstanding" * n)[:n]
    place, spelled = {p: i for i, p in enumerate(model.index)}, langid.spelled(word)
    want = np.zeros((len(spelled) + 1, 2))
    with np.errstate(divide="ignore"):
        lp = np.log(model.probs)
    for e in range(1, len(spelled) + 1):
        terms = [want[s] + lp[place[spelled[s:e]]] for s in range(max(0, e - model.longest), e) if spelled[s:e] in place]
        want[e] = np.logaddexp.reduce(terms)
    assert np.allclose(langid.Scorer(model).score([word])[0], want[-1])


def test_language_on_held_out_documents(docs):
    counts = {}
    for _, t, lang in docs[::2]:
        counts.setdefault(lang, Counter()).update(langid.WORD.findall(t.lower()))
    langs, _ = langid.Scorer(langid.fit_counts(counts, langid.pieces()))([t for _, t, _ in docs[1::2]])
    assert np.mean([a == b for a, (_, _, b) in zip(langs, docs[1::2])]) > 0.95


# 5


def test_edited_texts_and_likeness(spark, docs):
    got = fingerprints.compared(table(spark, SF, "documents")).orderBy("doc_id").collect()
    for k, (r, (i, t, _)) in enumerate(zip(got, docs)):
        half, other = len(t) // 2, docs[(k + 1) % len(docs)][1]
        assert r.doc_id == i and r.edited_sha256 == hashlib.sha256((t[: len(t) - half] + other[:half]).encode()).hexdigest()
    assert np.mean([r.near_edited > r.near_next for r in got]) > 0.9


def test_block_tables_find_all_within_the_radius(spark):
    rng = random.Random(5)
    fps = {rng.getrandbits(128) for _ in range(30)}
    fps |= {f ^ sum(1 << b for b in rng.sample(range(128), rng.randrange(1, 6))) for f in fps}
    df = spark.createDataFrame([(f"{f:032x}",) for f in fps], "fingerprint string")
    want = {(a, b) for a in fps for b in fps if (a ^ b).bit_count() <= 3}
    assert {(int(r[0], 16), int(r[1], 16)) for r in fingerprints.within(df, df).collect()} == want


# 6


def test_base_scores_and_total_probability(spark):
    rows = [(i, " ".join(random.Random(i).choices("The the AND cat cats dog".split(), k=8))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "doc_id % 5 <> 1 AS learn")
    got = {r.doc_id: r for r in ppm.scored(df, train=df["learn"]).collect()}
    train = [t for i, t in rows if i % 5 != 1]
    c = Counter(w for t in train for w in ppm.tokens(t))
    n, v = sum(c.values()) + len(train), len(c) + 1
    for i, t in rows:
        base = sum(math.log10((x + 0.5) / (n + 0.5 * (v + 1))) for x in [*(c[w] for w in ppm.tokens(t)), len(train)])
        assert abs(got[i].base_score - base) < 1e-6 and got[i].n_tokens == len(t.split()) + 1 and got[i].train_tokens == n
    # all symbols after a context share probability one
    levels = [{1: 3.0, 2: 1.0}, {2: 5.0, 7: 1.0}, {}]
    assert abs(sum(10 ** ppm.escape_chain(levels, s) for s in range(ppm.SYMBOLS)) - 1) < 1e-9


def ppm_by_hand(rows, learn, text, held, frequent):
    """The model's log10 probability of a text, from whole dictionaries: pairs of tokens, then every prefix of every word."""
    counts, pairs, trie, short = Counter(), {}, {}, {}
    for i, t in rows:
        if learn(i):
            seq = [*ppm.tokens(t), None]
            counts.update(seq)
            for a, b in zip([0, *seq], seq):
                pairs.setdefault(a, Counter())[b] += 1
    for w, c in counts.items():
        if w is None:
            trie.setdefault(b"", Counter())[ppm.TEXT_END] += c
            continue
        for i in range(len(w) + 1):
            s = w[i] if i < len(w) else ppm.WORD_END
            trie.setdefault(w[:i], Counter())[s] += c
            for k in range(min(2, i) + 1):
                short.setdefault(w[i - k : i], Counter())[s] += 1

    def spelled(w):
        if w is None:
            return ppm.escape_chain([trie.get(b"", {}), short.get(b"", {})], ppm.TEXT_END)
        chain = lambda i: [trie.get(w[:i], {}), *[short.get(w[i - k : i], {}) for k in range(min(2, i), -1, -1)]]
        return sum(ppm.escape_chain(chain(i), w[i] if i < len(w) else ppm.WORD_END) for i in range(len(w) + 1))

    out, before = 0.0, 0
    for w in [*ppm.tokens(text), None]:
        seen = {} if before in frequent else pairs.get(before, {})
        total = sum(seen.values())
        if seen.get(w):
            out += math.log10((seen[w] - ppm.DISCOUNT) / total)
        else:
            out += spelled(w)
            if total:
                mass = sum(10 ** spelled(x) for x in seen if x is None or x in held)
                out += math.log10(ppm.DISCOUNT * len(seen) / total) - math.log10(1 - mass)
        before = w
    return out


@pytest.mark.parametrize("held, share, group", [(100_000, 1, 10_000), (4, 8, 10_000), (0, 5, 25), (6, 1, 10_000)])
def test_model_scores_against_whole_dictionaries(spark, monkeypatch, held, share, group):
    monkeypatch.setattr(ppm, "HELD_WORDS", held), monkeypatch.setattr(ppm, "SHARE", share), monkeypatch.setattr(ppm, "GROUP", group)
    rng = random.Random(6)
    vocabulary = ["the", "then", "there", "thesis", "cat", "cats", "dog", "do", "a", "\x00b", "é", "x" * 300, "x" * 299 + "y"]
    rows = [(i, " ".join(rng.choices(vocabulary, [9, 6, 5, 1, 4, 3, 3, 2, 7, 1, 1, 1, 1], k=rng.randrange(12)))) for i in range(60)]
    rows += [(60, None), (61, "unseen thereof catsup"), (66, "The CAT"), (71, "x" * 350)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    learn = lambda i: i % 5 != 1
    got = {r.doc_id: r for r in ppm.scored(df, train=df["doc_id"] % 5 != 1).collect()}
    order = Counter(w for _, t in rows for w in ppm.tokens(t))
    most = min(group, (sum(order.values()) + len(rows)) / share)
    frequent = {w for w, n in order.items() if n > most} | ({0} if len(rows) > most else set())
    size = lambda n: n.bit_length() * 16 + (n >> max(0, n.bit_length() - 4))
    top = {w for w in order if sum(size(n) >= size(order[w]) for n in order.values()) <= held} | (frequent - {0})
    known = {w for i, t in rows if learn(i) for w in ppm.tokens(t)}
    for i, t in rows:
        assert abs(got[i].score - ppm_by_hand(rows, learn, t, top, frequent)) < 1e-6, (i, t)
        assert got[i].n_known == sum(w in known for w in ppm.tokens(t)) + 1 and got[i].held_out == (not learn(i))


@pytest.mark.parametrize("held, spread, at_once", [(100_000, 40_000, 2_000_000), (100_000, 8, 20), (4, 40_000, 20), (0, 3, 2_000_000)])
def test_model_scores_with_every_token_as_context(spark, monkeypatch, held, spread, at_once):
    """The most frequent tokens too, in more than one batch of texts."""
    monkeypatch.setattr(ppm, "HELD_WORDS", held), monkeypatch.setattr(ppm, "SPREAD", spread), monkeypatch.setattr(ppm, "JUDGED_AT_ONCE", at_once), monkeypatch.setattr(ppm, "BATCH_ROWS", 16)
    rng = random.Random(7)
    vocabulary = ["the", "then", "there", "cat", "cats", "a", "é", "x" * 300]
    rows = [(i, " ".join(rng.choices(vocabulary, [20, 3, 3, 2, 1, 9, 1, 1], k=rng.randrange(20)))) for i in range(80)]
    rows += [(81, "the unseen the unseen the"), (86, "cats catsup the the the the"), (91, None), (96, "é é the then")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    learn = lambda i: zlib.crc32(str(i).encode()) % 5 != 1
    order = Counter(w for _, t in rows for w in ppm.tokens(t))
    size = lambda n: n.bit_length() * 16 + (n >> max(0, n.bit_length() - 4))
    top = {w for w in order if sum(size(n) >= size(order[w]) for n in order.values()) <= held}
    known = {w for i, t in rows if learn(i) for w in ppm.tokens(t)}
    got = {r.doc_id: r for r in ppm.scored(df).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        assert abs(got[i].score - ppm_by_hand(rows, learn, t, top, set())) < 1e-6, (i, t)
        assert got[i].n_known == sum(w in known for w in ppm.tokens(t)) + 1 and got[i].held_out == (not learn(i))


def test_words_of_a_million_bytes(spark):
    rows = [(i, f"{'ab' * 500_000}{i}") for i in (2, 3)] + [(4, "q" + "ba" * 500_000)]
    got = ppm.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 3 and all(r.score < 0 for r in got)


# 7


def test_url_parts_rules_and_mining(spark):
    urls = ["http://WWW.example.com/en/7x?q#f", "https://a.COM/en/1", "ftp://net/de/", "x", None, "http://b.org?x=/es/", "http://spam.test/a/bad-page/1"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = urlrules.mined(df, df.selectExpr("page_id", "false AS bad"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlrules.judged(df, rules).collect()}
    assert got == {
        0: ("www.example.com", "/en/7x", "example.com/en/7", "allow"), 1: ("a.com", "/en/1", "com/en/", "block"), 2: ("net", "/de/", "net/de/", "block"), 3: ("", "", None, "allow"),
        4: ("", "", None, "allow"), 5: ("b.org", "", None, "allow"), 6: ("spam.test", "/a/bad-page/1", None, "allow"),
    }
    many = spark.createDataFrame([(i, f"http://{'spam' if i % 3 == 0 else 'good'}.test/{i}") for i in range(120)], "page_id long, url string")
    rules = urlrules.mined(many, many.selectExpr("page_id", "page_id % 3 = 0 AS bad"))
    assert [r.antecedent for r in rules.collect()] == [["h:spam"]]
    assert all((r.verdict == "block") == (r.page_id % 3 == 0) for r in urlrules.judged(many, rules).collect())


# 8


def test_components_against_brute_force(spark):
    rng = random.Random(8)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(200):
        fps.append(rng.choice(fps) ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5))))
    fps = list(dict.fromkeys(fps))
    got = {(r.a, r.b) for r in neardup.links(spark.createDataFrame([(neardup.signed(f),) for f in fps], "fp long")).collect()}
    want = {tuple(sorted((neardup.signed(a), neardup.signed(b)))) for a, b in itertools.combinations(fps, 2) if (a ^ b).bit_count() <= 3}
    assert got == want


def test_simhash_bits():
    import xxhash

    t = "A b\tc  D e"
    words = t.lower().split()
    hashes = [xxhash.xxh64(" ".join(words[i : i + 3]).encode(), seed=42).intdigest() for i in range(3)]
    assert neardup.simhash(t) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > 3)


# 9


def test_n_best_against_brute_force_and_round_trip(docs):
    v = sentencepieces.load()

    def brute(c):
        if not c:
            return [0.0]
        out = [v.pieces[c[:k]][0] + s for k in range(1, min(len(c), v.longest) + 1) if c[:k] in v.pieces for s in brute(c[k:])]
        return out if c[0] in v.pieces else out + [v.worst + s for s in brute(c[1:])]

    coder = sentencepieces.Encoder(v, 4)
    for text in ("the", "thereor ab", " aé▁x", "==== and\n\nof", "日本 the", ""):
        ((ids, best, scores),) = coder([text])
        assert scores == sorted(brute(" " + text if text else ""), reverse=True)[:4] and best == scores[0]
    for (_, t, _), (ids, _, _) in zip(docs, coder([t for _, t, _ in docs])):
        assert sentencepieces.decode(ids.tolist(), v) == t


# 10


def test_line_dedup_against_brute_force(spark, docs):
    found = [(d, i, x.strip(" ")) for d, t, _ in docs for i, x in enumerate(t.split("\n")) if x.strip(" ")]
    first: dict = {}
    copies = {(d, i) for d, i, x in found if first.setdefault(x, (d, i)) != (d, i)}
    near, seen = set(), {}
    for x, at in first.items():
        w = x.split(" ")
        if len(w) >= linededup.FEWEST:
            for k in range(len(w)):
                seen.setdefault((" ".join(w[:k] + w[k + 1 :]), k), []).append(at)
                seen.setdefault((" ".join(w[:k] + w[k + 1 :]), -1), []).append((at, x))
    for (text, k), group in seen.items():
        if k >= 0:
            near |= {at for at in group if at > min(group)}
        elif text in first and len(text.split(" ")) >= linededup.FEWEST:
            near |= {max(at, first[text]) for at, _ in group}
    got = {r.doc_id: (r.n_copies, r.n_near, r.text) for r in linededup.deduplicated(table(spark, SF, "documents").select("doc_id", "text")).collect()}
    for d, t, _ in docs:
        lines = t.split("\n")
        want = "\n".join(x for i, x in enumerate(lines) if (d, i) not in copies | near)
        assert got[d] == (sum(a == d for a, _ in copies), sum(a == d for a, _ in near), want)


def test_shuffles_of_a_written_table_are_dropped(spark):
    """The last query's, too, of which the session keeps the plan."""
    files = lambda: {b.toString() for b in _all(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()) if "shuffle" in b.toString()}
    before = files()
    checkpointed(spark.range(1000).repartition("id").groupBy((F.col("id") % 7).alias("k")).count())
    assert files() - before
    released(spark)
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before


def _all(found):
    return [found.apply(i) for i in range(found.size())]


def test_wide_line_dedup_against_brute_force(spark):
    rng = random.Random(10)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for n in (4, 5, 6, 8, 9, 12, 18, 19, 20, 21, 29, 36, 39, 40, 44, 70, 130, 300):
        for _ in range(4):
            base = rng.choices(vocabulary, k=n)
            rows.append(" ".join(base))
            for share in (0.04, 0.08, 0.1, 0.1, 0.13):
                words = list(base)
                for _ in range(max(1, round(share * n))):
                    at = rng.randrange(len(words))
                    words[at : at + rng.choice([0, 1, 1])] = rng.choice([[], ["qq"], [rng.choice(vocabulary)]])
                rows.append(" ".join(words))
    rng.shuffle(rows)
    rows = list(dict.fromkeys(x for x in rows if x))

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            prev, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(row[-1] + 1, prev[j] + 1, prev[j - 1] + (x != y)))
        return row[-1]

    def close(a, b):
        longer, shorter = max(len(a), len(b)), min(len(a), len(b))
        bound = longer // linededup.PER_EDIT if longer >= 20 else 1
        return shorter >= linededup.FEWEST and longer - shorter <= bound and distance(a, b) <= bound

    words = [x.split(" ") for x in rows]
    want = [any(close(w, v) for v in words[:i]) for i, w in enumerate(words)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.n_near for r in linededup.deduplicated(df, wide=True).collect()}
    assert [bool(got[i]) for i in range(len(rows))] == want
    assert sum(want) > sum(r.n_near for r in linededup.deduplicated(df).collect())


def join_rows(df) -> list:
    """Rows that came out of each join of the plan that was run."""
    df.collect()
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if "Join" in name:
            out.append(node.metrics().apply("numOutputRows").value())
        todo += [node.executedPlan()] if name == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in name else _all(node.children())
    return out


def test_unlike_copies_of_one_line_are_not_joined_with_each_other(spark, monkeypatch):
    """Copies of a long line that each have 15 other words: all but two are further from each other than the bound, though they share most words."""
    rng = random.Random(12)
    base = [f"word{i}" + "x" * rng.randrange(9) for i in range(200)]
    texts = []
    for k in range(120):
        w = list(base)
        for i in rng.sample(range(200), 15):
            w[i] = f"{k}other{i}"
        texts.append(" ".join(w))
    texts.append(texts[50].replace(" word7", " word8", 1))
    most, write = [], linededup.checkpointed
    monkeypatch.setattr(linededup, "checkpointed", lambda df: most.extend(join_rows(df)) or write(df))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.doc_id for r in linededup.deduplicated(df, wide=True).where("n_near > 0").collect()] == [120]
    # a row for each line and pair of words at most, not one for each pair of lines
    assert max(most) <= len(texts) * (2 * 22 + 1)


def test_unlike_long_lines_are_not_verified(spark, monkeypatch):
    """Lines of 250 words that share a long one and have as many words, but are unlike otherwise."""
    rng = random.Random(13)
    vocabulary = [f"w{i}" for i in range(600)]
    texts = [" ".join(["longer" * 5, *rng.choices(vocabulary, k=249)]) for _ in range(60)]
    pairs, verify = [], linededup._verified
    monkeypatch.setattr(linededup, "_verified", lambda found, texts: pairs.append(found.count()) or verify(found, texts))
    df = spark.createDataFrame(list(enumerate([*texts, texts[3] + " w0"])), "doc_id long, text string")
    assert [r.doc_id for r in linededup.deduplicated(df, wide=True).where("n_near > 0").collect()] == [60]
    assert sum(pairs) <= len(texts)


# the pipeline


def test_pipeline_keeps_what_its_stages_keep(spark, docs):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF).collect()
    ids = {r.doc_id for r in rows}
    assert len(ids) == len(rows) and all(r.decoded_equal for r in rows)
    v = sentencepieces.load()
    texts = [sentencepieces.decode(r.ids, v) for r in rows]
    bench = decontaminate.Benchmark(duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall())
    assert not any(bench.search(texts))
    assert len({neardup.simhash(t) for t in texts}) == len(texts)


def test_rows_without_an_id_of_their_own(spark):
    rng = random.Random(11)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(3000)], k=40)) for _ in range(7)]
    shared = "one line that all of them have in common"
    for ids in ((None, None, None), (4, 4, 4)):
        rows = [(1, f"{texts[0]}\n{shared}"), *[(i, f"{shared}\n{t}") for i, t in zip(ids, texts[1:3])], (ids[2], f"{texts[3]}\n{texts[4]}")]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        for wide in (False, True):
            got = sorted(r.text for r in linededup.deduplicated(df, wide=wide).collect())
            assert got == sorted([rows[0][1], *texts[1:3], rows[3][1]])
        many = spark.createDataFrame([(ids[0], t) for t in [*texts, texts[0]]], "doc_id long, text string")
        assert sorted(r.text for r in neardup.deduplicated(many).collect()) == sorted(texts)


def test_each_stage_runs_once(spark, monkeypatch):
    import corpus_pipeline

    read = spark.sparkContext.accumulator(0)

    def first(spark, docs, sf_dir):
        def run(batches):
            for b in batches:
                read.add(b.num_rows)
                yield b

        return docs.select("doc_id").mapInArrow(run, "doc_id long")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("first", first), ("second", lambda spark, docs, sf_dir: docs.union(docs.where("doc_id >= 0")))])
    n = table(spark, SF, "documents").count()
    assert corpus_pipeline.run(spark, SF).count() >= n and read.value == n


def broadcasts(df) -> int:
    """How many tables of the plan that was run were sent to every task."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def linked_texts(spark):
    texts = [" ".join(random.Random(k).choices("abcdefgh", k=200)) for k in range(20)]
    return spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *texts, *[t + " z" for t in texts]])], "doc_id long, text string")


def test_near_duplicates_broadcast_no_table_that_grows(spark):
    """Fingerprints, links and classes grow with the documents: small as they are here, the driver must not build them."""
    assert broadcasts(neardup.near_duplicates(linked_texts(spark))) == 0


def test_one_document_of_a_group_is_kept_without_broadcasts(spark):
    kept = neardup.deduplicated(linked_texts(spark))
    assert broadcasts(kept) == 0


def test_long_lines_are_told_apart_where_words_share_a_letter(spark, monkeypatch):
    """With two letters for all words every pair seems near; the words decide. Texts meet only the pairs that letters leave."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.sample(words, 30)) for _ in range(12)]

    def edited(line, n):
        w = line.split()
        for i in rng.sample(range(30), n):
            w[i] = f"x{rng.randrange(10**6)}"
        return " ".join(w)

    rows = [(i, t) for i, t in enumerate([*base, *[edited(t, 3) for t in base], *[edited(t, 4) for t in base]])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = []
    for letters in (2, linededup.LETTERS):
        monkeypatch.setattr(linededup, "LETTERS", letters)
        got.append({r.doc_id for r in linededup.deduplicated(df, wide=True).where("n_near > 0").collect()})
    assert got[0] == got[1] and set(range(12, 24)) <= got[0] and not got[0] & set(range(12))
    words_ = spark.createDataFrame([(k, t, t) for k, t in enumerate(base)], "ref long, line string, letters string")
    sides = linededup._verified(spark.createDataFrame([(0, 1)], "a long, b long"), words_)
    assert sides.columns == ["a", "b"] and sides.count() == 0
