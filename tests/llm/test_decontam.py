import hashlib
import random
import re

from tickloom.llm import decontam
from tickloom.llm.queries import QUERIES

WORD = re.compile(decontam.WORD)


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def brute_force(docs, items):
    out = {}
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for item_id, passage in items:
            w = words(passage)
            n = min(10, len(w))
            grams = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
            for i in range(len(own) - n + 1 if n else 0):
                if tuple(own[i:i + n]) in grams:
                    hit |= set(range(i, i + n))
                    found.add("" if item_id is None else str(item_id))
        named = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc_id, text] = (len(own), len(hit), len(found), named, bool(hit))
    return out


def run(spark, docs, items):
    found = decontam.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                                   spark.createDataFrame(items, "item_id long, text string, doc_id long")
                                   if items else spark.createDataFrame([], "item_id long, text string"))
    return sorted((r["_id"] is None, r["_id"] or 0, r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
                  for r in found.collect())


def test_equals_brute_force(spark):
    rng = random.Random(11)
    vocabulary = ["the", "of", "Äpfel", "x1", "é", "日本", "and", "to", "zz", "qq"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 6, 9, 10, 11, 14, 30])))) for i in range(40)]
    items = [(i, t) for i, t in items if len(words(t)) > 2] + [(50, ""), (51, None), (2, "The, the; THE of/of of x1 x1 x1 x1"), (None, "zz zz zz zz zz zz")]
    docs = []
    for i in range(150):
        parts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 12))) for _ in range(3)]
        if i % 2:
            w = words(rng.choice(items)[1])
            a = rng.randrange(0, max(1, len(w) - 8))
            parts.insert(1, ", ".join(w[a:a + rng.randrange(1, 25)]).upper())
        docs.append((i, " ".join(parts)))
    docs += [(200, "the " * 500), (201, None), (202, ""), (None, items[0][1]), (5, docs[5][1]), (5, "other text")]
    wanted = brute_force(docs, items)
    assert run(spark, docs, [(*i, 0) for i in items]) == sorted(
        (d is None, d or 0, *wanted[d, t]) for d, t in docs)
    assert sum(v[1] > 0 for v in wanted.values()) > 20


def test_nothing_to_find(spark):
    assert [r[3:5] for r in run(spark, [(1, "a b c")], [])] == [(0, 0)]
    assert run(spark, [], [(1, "a b c", 1)]) == []


def test_query_equals_brute_force(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    wanted = {d: v for (d, _), v in brute_force(docs, items).items()}
    rows = QUERIES["op5_winnowing"](spark, sf_dir).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows} == wanted


def test_odd_rows(spark, odd):
    items = spark.createDataFrame([(1, "brown fox jumps over"), (1, "brown fox jumps over")], "item_id int, text string")
    rows = decontam.contamination(odd, items).collect()
    assert len(rows) == odd.count()
    assert {r["_id"] for r in rows if r["contaminated"]} == {1, 2}
    assert {(r["n_hit"], r["n_items"]) for r in rows if r["_id"] == 1} == {(4, 1)}
