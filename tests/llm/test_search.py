"""Decontamination, ranked search and periodic runs on hard rows against plain Python, and on the given tables against SQL."""

import hashlib
import math
import random
import re
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from foliate.llm import decontaminate, lexical, periodic

DATA = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PASSAGE = "the quick brown fox jumps over one lazy dog and then it sleeps until noon"
LONG = "alpha beta gamma " * 20000
TEXTS = [
    (1, PASSAGE),
    (2, PASSAGE.upper() + "!"),
    (3, ""),
    (4, None),
    (5, " \t\n.-"),
    (6, LONG),
    (7, "x" * 70000),
    (8, "ünï–cödé 漢字 two words"),
    (8, "ünï–cödé 漢字 two words"),
    (None, f"before {PASSAGE} after"),
    (None, None),
    (9, "brown fox jumps over one lazy dog and then"),
    (10, f"{PASSAGE}. {PASSAGE} again; short item here, short item there"),
    (11, "tick tock " * 9 + "boom"),
    (12, "a b c a b c a b c a b c a b x a b c"),
]
ITEMS = [(1, PASSAGE), (2, "short item"), (3, "漢字"), (4, None), (5, ""), (10, "gamma alpha beta gamma alpha beta gamma alpha beta gamma alpha"), (None, "two words"), (2, "short item"), (7, "never seen " * 8)]
EXTRA = ["key", "n", "row", "fp", "left", "right", "at", "hits", "print", "rank", "score", "query", "runs", "tiles", "period"]


def words(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string").withColumns({c: F.lit("extra") for c in EXTRA}), spark.createDataFrame(ITEMS, "item_id long, text string").withColumns({c: F.lit("extra") for c in EXTRA})


def contaminated(texts, items):
    windows = {}
    for name, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(name)
    out = []
    for key, text in texts:
        w, hit, named = words(text), set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                if tuple(w[i : i + m]) in windows:
                    hit |= set(range(i, i + m))
                    named |= windows[tuple(w[i : i + m])]
        out.append((key, len(w), len(hit), tuple(sorted(str(n) for n in named if n is not None))))
    return Counter(out)


def test_decontamination_of_hard_rows(spark, hard):
    found = decontaminate.decontaminate(*hard).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r.hit_items)) for r in found) == contaminated(TEXTS, ITEMS)
    for r in found:
        assert r.n_hit == len({w for s in r.hit_spans for w in range(s.begin, s.end)})
    assert decontaminate.decontaminate(hard[0].limit(0), hard[1]).count() == 0
    assert decontaminate.decontaminate(*(df.limit(n) for df, n in zip(hard, (99, 0), strict=True))).where("n_hit > 0").count() == 0


def test_decontamination_of_repetitive_texts(spark):
    """Few different words, so that hashes tie and windows overlap in every way."""
    rnd = random.Random(7)
    texts = [(i, " ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 80)))) for i in range(150)]
    items = [(i, " ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 24)))) for i in range(40)]
    found = decontaminate.decontaminate(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r.hit_items)) for r in found) == contaminated(texts, items)


def ranked(texts, items, top=10):
    bags = [(key, Counter(words(text))) for key, text in texts]
    n = sum(1 for _, b in bags if b)
    length = sum(sum(b.values()) for _, b in bags)
    out = set()
    for name, text in items:
        asked, scores = Counter(words(text)), []
        for key, bag in bags:
            m = 25 + (75 * sum(bag.values()) * n) // length if length else 25
            held = [(t, c) for t, c in asked.items() if t in bag]
            score = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * sum(1 for _, b in bags if t in b) + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m)) for t, c in held)
            if score > 0:
                scores.append((-score, key is None, key, score))
        out |= {(name, rank, key, score) for rank, (_, _, key, score) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:top], 1)}
    return out


def test_search_of_hard_rows(spark, hard):
    found = lexical.search(*hard)
    assert {(r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()} == ranked(TEXTS, ITEMS)
    assert lexical.search(hard[0].limit(0), hard[1]).count() == 0
    assert lexical.search(hard[0], hard[1].limit(0)).count() == 0


@pytest.mark.parametrize("bits", [2, 16])
def test_search_ends_with_the_best(spark, monkeypatch, bits):
    """Whatever the bounds are worth: with four coordinates nearly all documents reach the threshold."""
    monkeypatch.setattr(lexical, "BLOCK_QUERIES", 7)
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    draw = lambda n: " ".join(vocabulary[min(59, int(rnd.expovariate(0.1)))] for _ in range(n))
    texts = [(i, draw(rnd.randint(0, 60))) for i in range(300)] + [(300 + i, "w3 w9 w27 w3") for i in range(40)] + [(400, "w5 " * 700)]
    items = [(i, draw(rnd.randint(1, 12))) for i in range(20)]
    found = lexical.search(spark.createDataFrame(texts, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string"), first=12, bits=bits)
    assert {(r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()} == ranked(texts, items)


def runs_of(words):
    """(start, period, length) of every run, from each period's agreements alone."""
    runs = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                runs.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, q, n) for (s, n), q in runs.items())


def collapse(words, runs):
    gone = {i for s, q, n in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_runs_of_hard_rows(spark, hard):
    short = [t for t in TEXTS if t[0] != 6]
    got = Counter((r.doc_id, tuple(map(tuple, r.runs)), r.collapsed_sha256) for r in periodic.periodic_runs(hard[0]).where("doc_id is null or doc_id <> 6").collect())
    want = [(k, (t or "").split(), runs_of((t or "").split())) for k, t in short]
    assert got == Counter((k, tuple(r), sha(collapse(w, r))) for k, w, r in want)
    (long,) = periodic.periodic_runs(hard[0].where("doc_id = 6")).collect()
    assert [tuple(r) for r in long.runs] == [(0, 3, 60000)] and long.collapsed == "alpha beta gamma"
    assert periodic.periodic_runs(hard[0].limit(0)).count() == 0


def test_runs_of_repetitive_texts(spark):
    rnd = random.Random(11)
    texts = []
    for i in range(200):
        n = rnd.choice([0, 11, 12, 13, 30, 64, 150, 500])
        w = [f"v{rnd.randint(0, rnd.choice([1, 2, 4, 60]))}" for _ in range(n)]
        if n and i % 2:
            a, p = rnd.randrange(n), rnd.randint(1, max(1, n // 3))
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        texts.append((i, " ".join(w)))
    found = periodic.periodic_runs(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r.doc_id: [tuple(x) for x in r.runs] for r in found} == {k: runs_of(t.split()) for k, t in texts}
    assert {r.doc_id: r.collapsed_sha256 for r in found} == {k: sha(collapse(t.split(), runs_of(t.split()))) for k, t in texts}


@pytest.mark.skipif(not Path(DATA).exists(), reason="the given tables are not here")
def test_op13_agrees_with_plain_python(spark):
    import zlib

    short = "length(text) < 6000"
    got = {r.doc_id: tuple(r) for r in periodic.op13_periodic_runs(spark, DATA).collect()}
    for doc_id, text in spark.read.parquet(f"{DATA}/documents.parquet").where(short).select("doc_id", "text").collect():
        w = (text or "").split()
        h, n = zlib.crc32(str(doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            w = [w[i] if i < a else w[a + (i - a) % (1 + (n - a) // (3 + g % 8))] for i in range(n)]
        runs = runs_of(w)
        best = min(runs, key=lambda r: (-r[2], r[0], r[1])) if runs else None
        facts = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
        assert got[doc_id] == (doc_id, len(runs), *facts, sha("".join(f"{s},{n},{q}\n" for s, q, n in runs)), sha(collapse(w, runs)))


@pytest.mark.skipif(not Path(DATA).exists(), reason="the given tables are not here")
@pytest.mark.parametrize("query, module", [("op11_decontamination", decontaminate), ("op12_lexical_search", lexical)])
def test_queries_agree_with_sql(spark, query, module):
    duck = duckdb.connect()
    for t in ("documents", "benchmark"):
        duck.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = duck.sql(module.ORACLE)
    got = getattr(module, query)(spark, DATA).select(*want.columns)
    assert Counter(map(tuple, got.collect())) == Counter(want.fetchall())
