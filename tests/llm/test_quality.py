import collections
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tickloom.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fixed(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    counts = collections.Counter(grams)
    repeated = {p for i, g in enumerate(grams) if counts[g] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated))


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def texts():
    rng = random.Random(12)
    made = [" ".join(rng.choice("abcdé") for _ in range(n)) for n in (1, 2, 3, 4, 5, 60, 400)]
    return made + ["a b c a b c a", "x x x x", "l1 a\nl1 a\n\n \t\nl1 a\r\nl2", "\x0bö\x0c日本 ### <|>", "a b  c", "", None]


def test_fixed_rules_equal_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    rows = quality.judge(docs, docs.filter("false").select("doc_id"), threshold=-1e9).collect()
    assert len(rows) == len(texts())
    for r in rows:
        n, _, _, _, again = wanted = fixed(texts()[r["doc_id"]])
        assert tuple(r[c] for c in NAMES) == wanted, texts()[r["doc_id"]]
        assert r["base_failed"] == (n < 50 or 100 * again > 50 * n)
        assert r["kept"] == (not r["base_failed"]) and r["ratio"] == 0


def test_ratio_equals_counts(spark):
    """With more buckets than n-grams, against plain counts; hashes only decide collisions."""
    rows = [(0, "a b a"), (1, "a c"), (2, "d"), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    buckets = 1 << 14
    found = {r["doc_id"]: r["ratio"] for r in quality.judge(
        docs, docs.filter("doc_id in (0, 2)").select("doc_id"), buckets=buckets).collect()}

    def grams(text):
        w = text.split()
        return w + [tuple(x) for x in zip(w, w[1:])]

    raw = collections.Counter(g for _, t in rows for g in grams(t))
    target = collections.Counter(g for i, t in rows if i in (0, 2) for g in grams(t))
    n, m = sum(raw.values()) + buckets, sum(target.values()) + buckets
    for i, t in rows:
        g = grams(t)
        mean = sum(math.log((target[x] + 1) / m / ((raw[x] + 1) / n)) for x in g) / max(1, len(g))
        assert found[i] == pytest.approx(mean, abs=2e-6)


def test_junk_scores_below_trusted_text(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.judge(docs, labels.filter("quality = 1 and toxic = 0").select("doc_id")).join(labels, "doc_id").collect()
    good = [r for r in rows if r["quality"] == 1 and not r["base_failed"]]
    poor = [r for r in rows if r["quality"] == 0]
    assert sum(r["kept"] for r in good) >= 0.98 * len(good)
    assert sum(r["kept"] for r in poor) <= 0.4 * len(poor)
    raw = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(tuple(r[c] for c in NAMES) == fixed(raw[r["doc_id"]]) for r in rows)


def test_odd_rows(odd, nothing):
    rows = quality.judge(odd, odd.select("doc_id")).collect()
    assert len(rows) == odd.count()
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["doc_id"] in (3, 4, 7))
    assert quality.judge(nothing, nothing.select("doc_id")).collect() == []


def test_few_toxic_words_are_found(spark):
    """One bad word in a text of 80; no threshold is given, and no label of the bad texts is used."""
    rng = random.Random(5)
    rows = [(i, [f"w{int(300 * rng.random() ** 2)}" for _ in range(80)]) for i in range(660)]
    for i, words in rows[600:]:
        words[rng.randrange(80)] = "idiot"
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    kept = {r["doc_id"] for r in quality.judge_held_out(docs, docs.filter("doc_id < 300").select("doc_id")).filter("kept").collect()}
    assert len(kept & set(range(600, 660))) <= 0.25 * 60
    assert len(kept & set(range(300, 600))) >= 0.95 * 300       # clean, but not trusted


def test_lowest_window_equals_brute_force(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts()) if t and len(t.split(" ")) > 3], "doc_id long, text string")
    weights = quality.ratios(docs, docs.filter("doc_id % 2 = 0").select("doc_id"), "doc_id", "text", 1 << 10)
    found = quality.scored(docs, weights, "doc_id", "text", 3).collect()
    hashed = {r["doc_id"]: (r["w"], r["p"]) for r in docs.select("doc_id", quality.let(F.transform(
        quality.words_of(F.col("text")), lambda w: F.xxhash64(w)), lambda h: F.struct(h.alias("w"), quality.joined(h, 2).alias("p"))).alias("x")).select("doc_id", "x.*").collect()}
    for r in found:
        words, pairs = hashed[r["doc_id"]]
        each = [weights[0][w & 1023] + (weights[0][pairs[i - 1] & 1023] if i else 0.0) for i, w in enumerate(words)]
        low = min(sum(each[i:i + 3]) for i in range(len(each) - 2)) / 6 if len(each) > 3 else r["ratio"]
        assert r["lowest"] == pytest.approx(low, abs=2e-6)


def test_held_out_odd_rows(odd, nothing):
    rows = quality.judge_held_out(odd, odd.select("doc_id")).collect()
    assert len(rows) == odd.count()
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["doc_id"] in (3, 4, 7))
    assert quality.judge_held_out(nothing, nothing.select("doc_id")).collect() == []
    assert all(r["kept"] == (not r["base_failed"]) for r in quality.judge_held_out(odd, nothing.select("doc_id")).collect())


def test_weights_stay_out_of_the_driver(spark, monkeypatch):
    """Neither the counts nor the weights of the query's million buckets pass through Python; and both
    ways of summing windows agree."""
    rng = random.Random(6)
    docs = spark.createDataFrame([(i, " ".join(f"w{rng.randrange(90)}" for _ in range(70))) for i in range(60)], "doc_id long, text string")
    trusted = docs.filter("doc_id % 3 = 0").select("doc_id")
    array = quality.ratios(docs, trusted, "doc_id", "text", 1 << 12, 5)
    assert array.shape == (5, 1 << 12)
    plain = sorted(quality.scored(docs, array, "doc_id", "text", 3).collect())

    def refuse(self):
        raise AssertionError("a table was collected")

    for name in ("toArrow", "toPandas"):
        monkeypatch.setattr(type(docs), name, refuse)
    made = quality.scored(docs, quality.ratio_table(docs, trusted, "doc_id", "text", 1 << 12, 5), "doc_id", "text", 3)
    kept = quality.judge_held_out(docs, trusted, buckets=1 << 12)
    monkeypatch.undo()
    assert sorted(made.collect()) == plain and kept.count() == 60
    monkeypatch.setattr(quality, "UNROLLED", 0)
    rolled = sorted(quality.scored(docs, array, "doc_id", "text", 3).collect())
    assert all(a["lowest"] == pytest.approx(b["lowest"], abs=2e-6) and a[:8] == b[:8] for a, b in zip(rolled, plain))
