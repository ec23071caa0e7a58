from collections import Counter

import pytest

from tickloom.llm import phrases


def plain(rows, longest=4):
    """Counts of all phrases by language."""
    import re

    counts = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", low):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            counts[lang, ""] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, " ".join(words[i:i + k])] += 1
    return counts


def ranked(counts, min_count, top):
    known = {x: f for x, f in counts.items() if f >= min_count and x[1]}
    made = {}
    for (lang, phrase), a in known.items():
        words = phrase.split(" ")
        if len(words) < 2:
            continue
        longer = [f for (other, text), f in known.items()
                  if other == lang and f" {phrase} " in f" {text} " and text != phrase]
        if any(100 * f >= 80 * a for f in longer):
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = counts[lang, " ".join(words[:k])], counts[lang, " ".join(words[k:])]
            cuts.append((2_000_000 * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)
        made.setdefault(lang, []).append((-score, -a, phrase.encode(), l, r))
    return {(lang, rank, p.decode(), -a, l, r, counts[lang, ""], -s)
            for lang, found in made.items() for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)}


@pytest.mark.parametrize("sample", [1, 3, 1000])
def test_equals_brute_force_whatever_is_proposed(spark, sf_dir, sample):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = plain((r["lang"], r["text"]) for r in docs.collect())
    found = {tuple(r) for r in phrases.collocations(docs, 12, top=50, sample=sample).collect()}
    assert found == ranked(counts, 12, 50)
    every = {(r["lang"], r["phrase"]): r["f"] for r in phrases.frequent_phrases(docs, 12, sample=sample).collect()}
    assert every == {x: f for x, f in counts.items() if f >= 12 or not x[1]}


def test_a_full_set_of_bits_only_counts_more(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = plain((r["lang"], r["text"]) for r in docs.collect())
    every = {(r["lang"], r["phrase"]): r["f"] for r in phrases.frequent_phrases(docs, 12, bits=6).collect()}
    assert every == {x: f for x, f in counts.items() if f >= 12 or not x[1]}


def test_odd_rows(spark, odd, nothing):
    assert phrases.collocations(nothing).collect() == []
    found = {tuple(r) for r in phrases.collocations(odd.withColumnRenamed("score", "f"), 2).collect()}
    assert found == ranked(plain((r["lang"], r["text"]) for r in odd.select("lang", "text").collect()), 2, 2000)
    rows = [(None, "a b\tA  b. a b, a b c d\x0ba b"), ("und", "a b")] * 3
    docs = spark.createDataFrame(rows, "lang string, text string")
    found = phrases.collocations(docs, 3).collect()
    assert {tuple(r) for r in found} == ranked(plain(rows), 3, 2000)
    assert found[0]["lang"] == "und"
