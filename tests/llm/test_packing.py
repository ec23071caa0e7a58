import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from tickloom.llm import packing
from tickloom.llm.word_ids import WordIds

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def data():
    with open(WORDS, encoding="utf-8") as source:
        return source.read()


def library(coder, text):
    return coder.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library_on_mixed_signs(data):
    coder, rng = WordIds(data, cache=500), random.Random(3)
    letters = list(" \t\n\x0b\x0c\r\x1c\x85\xa0 abcEZtsSTÉéİıſẞßªºŉǅ'’.,-_=!?0123٣²½ΣσςΑ日本한ㄱힰ각̸̱́̇​") + [
        "'s", "'ll", "<|endoftext|>", "don't", "É", "H̱", "the", "and", "\U0001F600", "ﬁ"]
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 40)))
        assert coder.encode([text.encode()])[0].tolist() == library(coder.coder, text), text


def test_ids_equal_the_library_for_every_low_letter(data):
    coder = WordIds(data)
    for x in map(chr, range(33, 0x260)):
        texts = [x, "ab" + x, x + "ab", f"a{x}b,", f".{x}.", 2 * x, f"'{x}"]
        for text, ids in zip(texts, coder.encode([t.encode() for t in texts])):
            assert ids.tolist() == library(coder.coder, text), text


def plain_choice(lengths, capacity):
    """Sum of squares from its definition: the smallest total over all open sequences."""
    gaps, placed = [], []
    for size in lengths:
        def total(after):
            counts = {}
            for g in after:
                if 0 < g < capacity:
                    counts[g] = counts.get(g, 0) + 1
            return sum(n * n for n in counts.values())

        options = {}
        for i, gap in enumerate(gaps):
            if gap >= size:
                options.setdefault(gap, i)
        tries = [(total([*gaps[:i], g - size, *gaps[i + 1:]]), 0, g) for g, i in options.items()]
        tries.append((total([*gaps, capacity - size]), 1, capacity))
        _, new, gap = min(tries)
        placed.append(gap)
        if new:
            gaps.append(capacity - size)
        else:
            gaps[options[gap]] -= size
    return placed


def test_choice_is_the_smallest_sum_of_squares():
    rng = random.Random(7)
    for capacity in (5, 9, 30):
        for _ in range(60):
            lengths = [rng.randrange(1, capacity + 1) for _ in range(40)]
            number, offset, left = packing.choose(np.array(lengths), capacity)
            assert [capacity - o for o in offset.tolist()] == plain_choice(lengths, capacity)
            used = np.bincount(number, lengths)
            assert (used + left == capacity).all()


def check(rows, texts, coder, capacity, end=1):
    """Every document whole, in order, and sequences without gaps."""
    want = {}
    for doc_id, text in texts:
        ids = np.array([*library(coder, text), end], "<u4")
        cut = [ids[i:i + capacity] for i in range(0, len(ids), capacity)]
        for k, part in enumerate(cut):
            key = (doc_id, k, k * capacity, len(part), zlib.crc32(part.tobytes()))
            want[key] = want.get(key, 0) + 1
    found, by_sequence = {}, {}
    for r in rows:
        key = (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
        found[key] = found.get(key, 0) + 1
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert found == want
    for parts in by_sequence.values():
        end_of = 0
        for offset, length in sorted(parts):
            assert offset == end_of
            end_of += length
        assert end_of <= capacity
    return len(by_sequence)


def test_query_on_the_whole_table(spark, sf_dir, data):
    from tickloom.llm.queries import QUERIES

    rows = QUERIES["op11_sum_of_squares_packing"](spark, sf_dir).collect()
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    used = check(rows, texts, WordIds(data).coder, 4096)
    total = sum(r["length"] for r in rows)
    assert used <= -(-total // 4096) + 6


def test_groups_are_packed_again(spark, sf_dir, data):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    made = packing.pack(docs, WORDS, 1, capacity=700, group=40)
    used = check(made.collect(), texts, WordIds(data).coder, 700)
    alone = packing.pack(docs, WORDS, 1, capacity=700, group=10_000).select("sequence_id").distinct().count()
    assert used <= 1.05 * alone + 3
    for r in packing.sequences(made).collect():
        assert len(r["ids"]) == 4 * r["length"] == 4 * sum(d["length"] for d in r["documents"])


def test_odd_rows(spark, odd, nothing, data):
    made = packing.pack(odd.withColumnsRenamed({"lang": "row", "score": "ids"}), WORDS, 1, capacity=1000).collect()
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check(made, texts, WordIds(data).coder, 1000)
    assert [r["length"] for r in made if r["doc_id"] == 4] == [1]
    assert packing.pack(nothing, WORDS, 1).collect() == []
    # Documents that hardly fit together end, too.
    wide = spark.range(50).selectExpr("id as doc_id", "repeat('a ', 6) as text")
    assert packing.pack(wide, WORDS, 1, capacity=10, group=5).select("sequence_id").distinct().count() == 50
