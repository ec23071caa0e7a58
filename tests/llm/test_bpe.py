import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from tickloom.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def coder():
    with open(RANKS, "rb") as source:
        return bpe.encoding(source.read(), public_tokenizers.PATTERN)


def test_pieces_have_the_same_ids(coder):
    rng = random.Random(2)
    letters = list(" \t\n\r　ab'stréZ019२_-!​") + ["'ll", "  ", "日本", "́"]
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 80)))
        for size in (1, 3, 10):
            cut = list(bpe.pieces(text, size))
            assert "".join(cut) == text
            assert [i for p in cut for i in coder.encode_ordinary(p)] == coder.encode_ordinary(text), (text, cut)


def test_texts_without_safe_places(coder):
    text = "a" * 3000 + " " * 3000 + "\n" * 500
    assert "".join(bpe.pieces(text, 100)) == text
    assert [i for p in bpe.pieces(text, 100) for i in coder.encode_ordinary(p)] == coder.encode_ordinary(text)


def test_round_trip_equals_library(spark, sf_dir, coder):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN, keep=["doc_id"]).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = np.array(coder.encode_ordinary(texts[r["doc_id"]]), "<u4")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_encode_then_decode(odd, nothing):
    encoded = bpe.encode_texts(odd.withColumnsRenamed({"lang": "ids"}), RANKS, public_tokenizers.PATTERN)
    assert encoded.columns == ["doc_id", "text", "score", "_id", "n_tokens", "ids"]
    rows = bpe.decode_ids(encoded, RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == odd.count()
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in rows)
    assert all((r["n_tokens"] == 0) == (not r["text"]) for r in rows)
    checked = bpe.encode_texts(odd, RANKS, public_tokenizers.PATTERN, keep=["doc_id"], check=True)
    assert checked.count() == odd.count()
    assert bpe.round_trip(nothing, RANKS, public_tokenizers.PATTERN).collect() == []
