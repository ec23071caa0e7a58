import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np

from tickloom.llm import periodic
from tickloom.llm.periodic import SquareCatcher, find_runs


def brute(words, min_length=0, min_exponent=2):
    """Every maximal stretch of every period; the smallest period of a stretch."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - p:
            j = i
            while j < len(words) - p and words[j] == words[j + p]:
                j += 1
            if j - i >= p:
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((a, b - a, p) for (a, b), p in found.items() if b - a >= max(min_length, min_exponent * p))


def sequences(seed, count, longest=110):
    rng = random.Random(seed)
    for _ in range(count):
        kinds, n = rng.choice([1, 2, 2, 3, 5, 20]), rng.randrange(longest)
        words = [rng.randrange(kinds) for _ in range(n)]
        if n > 6 and rng.random() < 0.6:
            a = rng.randrange(n)
            p = 1 + rng.randrange((n - a) // 2 + 1)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        yield words


def test_every_run_however_words_arrive():
    rng = random.Random(1)
    for words in sequences(2, 250):
        catcher, at = SquareCatcher(), 0
        while at < len(words):
            step = rng.choice([1, 1, 2, 9])
            catcher.append(np.array(words[at:at + step]))
            at += step
        assert [tuple(r) for r in catcher.runs().tolist()] == brute(words)


def test_every_run_of_texts_searched_together():
    texts = list(sequences(3, 800))
    for words, runs in zip(texts, find_runs([np.array(t, np.int64) for t in texts], 0, 2)):
        assert [tuple(r) for r in runs.tolist()] == brute(words)


def test_misleading_fingerprints(monkeypatch):
    monkeypatch.setattr(periodic, "mixed", lambda a, b: (a + b) % np.uint64(3))
    for words in sequences(4, 60, 40):
        catcher = SquareCatcher()
        catcher.append(np.array(words, np.int64))
        for start, length, p in catcher.runs().tolist():
            assert length >= 2 * p and words[start:start + length - p] == words[start + p:start + length]


def test_long_repetitions():
    zeros = np.zeros(50_000, np.int64)
    assert find_runs([zeros], 24, 3)[0].tolist() == [[0, 50_000, 1]]
    nested = np.tile(np.append(np.zeros(100, np.int64), 1), 300)
    assert len(find_runs([nested], 24, 3)[0]) == 301


def expected(doc_id, text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words, 24, 3)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    gone = {i for s, m, p in runs for i in range(s + p, s + m)}
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in sorted(runs, key=lambda r: (r[0], r[2]))).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_on_the_whole_table(spark, sf_dir):
    from tickloom.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    short = [r for r in docs if len(r["text"] or "") < 12_000]
    found = {r["doc_id"]: tuple(r) for r in QUERIES["op12_dyadic_square_runs"](spark, sf_dir).select(*COLUMNS).collect()}
    assert len(found) == len(docs) and len(short) > 0.9 * len(docs)
    for r in short:
        assert found[r["doc_id"]] == expected(r["doc_id"], r["text"])


def test_odd_rows(spark, odd, nothing):
    some = odd.filter("doc_id is null or doc_id <> 5")
    found = sorted((tuple(r) for r in periodic.run_digests(some).collect()), key=str)
    assert found == sorted((expected(r["doc_id"], r["text"]) for r in some.collect()), key=str)
    assert periodic.run_digests(nothing).collect() == []
    assert periodic.periodic_runs(odd).count() == odd.count()
    text = "x y " + "a b c " * 30 + "z " * 24
    row = periodic.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row["runs"]] == [(2, 90, 3), (92, 24, 1)]
    assert row["collapsed"] == "x y a b c z"
