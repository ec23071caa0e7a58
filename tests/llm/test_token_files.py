import io
import zlib

import numpy as np
import public_tokenizers
import pytest

from tickloom.llm import token_files as tf
from tickloom.session import work_folder

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows):
    with open(TOKENIZER, encoding="utf-8") as source:
        coder = tf._tokenizer(source.read())
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*coder.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("ids", [
    [7], [0] * 5000, [2**32 - 1, 0, 65_536, 5] * 30, list(range(9000)), [50_256] * 4096 + [1]])
def test_blocks_round_trip(ids, monkeypatch):
    monkeypatch.setattr(tf, "LANES", 2)
    ids = np.array(ids, "<u4")
    data = b"".join(tf.pack(ids))
    assert (np.concatenate(list(tf.unpack(io.BytesIO(data), -(-len(ids) // tf.BLOCK)))) == ids).all()


def test_blocks_are_independent_and_checked():
    ids = (np.random.default_rng(3).zipf(1.4, 3 * tf.BLOCK) % 50_000).astype("<u4")
    data = b"".join(tf.pack(ids))
    assert len(data) < 1.2 * len(ids)           # under ten bits for an id of sixteen
    size, digits, words, _ = tf.BLOCK_HEAD.unpack_from(data)
    second = data[tf.BLOCK_HEAD.size + 2 * words:]
    assert (next(tf.unpack(io.BytesIO(second), 1)) == ids[size:2 * size]).all()
    for at in (10, tf.BLOCK_HEAD.size + 9):
        broken = bytearray(data)
        broken[at] ^= 4
        with pytest.raises((ValueError, IndexError)):
            list(tf.unpack(io.BytesIO(bytes(broken)), 1))


def test_files_equal_tokenizer(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(tf, "FILE_CHARS", 150_000)      # several files
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(120)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    folder = f"{work_folder(spark)}/ids"
    files = tf.write(docs, folder, TOKENIZER, 2)
    assert files.count() > 1
    found = sorted(tf.read(files, folder).collect(), key=lambda r: r["start"])
    assert [tuple(r) for r in found] == expected(rows)


def test_odd_rows(odd, nothing):
    odd = odd.filter("doc_id is null or doc_id <> 5")
    rows = sorted(tf.round_trip(odd, TOKENIZER, 2).collect(), key=lambda r: r["start"])
    assert [tuple(r) for r in rows] == expected([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert tf.round_trip(nothing, TOKENIZER, 2).collect() == []
