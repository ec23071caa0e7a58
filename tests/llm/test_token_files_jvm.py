"""The coder and the tokenizer of the JVM against numpy and the tokenizers library."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tickloom.llm import byte_level, jvm, token_files as tf
from tickloom.session import work_folder

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
OTHER = public_tokenizers.path("word_bpe_49k.json")


def text_of(path):
    with open(path, encoding="utf-8") as source:
        return source.read()


@pytest.mark.parametrize("digits", [4, 8])
def test_blocks_are_those_of_numpy(spark, digits):
    rng = np.random.default_rng(5)
    blocks = [rng.zipf(1.3, tf.BLOCK) % 50_257, np.zeros(tf.BLOCK), np.arange(tf.BLOCK) // 100,
              rng.integers(0, 1 << 4 * digits, tf.BLOCK), np.arange(900) * 7 % 31, np.array([65_535])]
    if digits == 8:
        blocks.insert(0, np.array([2**32 - 1, 0, 65_536, 5] * 1024))
    blocks = [b.astype("<u4") for b in blocks]
    words = tf.encode_blocks(blocks, digits)
    rows = spark.createDataFrame([(i, bytearray(b.tobytes()), digits, len(b)) for i, b in enumerate(blocks)],
                                 "i int, data binary, digits int, ids int").repartition(3)
    coder = jvm.function(spark, "IdBlocks")
    coded = rows.withColumn("words", coder("data", "digits", F.lit(None).cast("int")))
    for r in coded.withColumn("back", coder("words", "digits", "ids")).collect():
        assert bytes(r["words"]) == words[r["i"]]
        assert bytes(r["back"]) == blocks[r["i"]].tobytes()
    same = rows.select("i", "data", coder("data", F.lit(0), F.lit(7)).alias("kept")).collect()
    assert all(r["data"] == r["kept"] for r in same)


def some_texts():
    rng = random.Random(4)
    signs = list(" \t\n\x0b\x0c\r\x1c\x85\xa0 abcEZtsSTÉéİıſẞßªºŉǅ'’.,-_=!?0123٣²½ΣσςΑ日本한ㄱힰ각̸̱́̇​ ᠎ 　﻿") + [
        "'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "<|endoftext|>", "don't", "H̱", "the", "  ", "\U0001F600", "ﬁ", "\U000e0041"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(4000)]
    texts += ["".join(rng.choice("abcdeé") for _ in range(n)) for n in range(1, 400, 3)]
    texts += [" " * 500 + "x" + "\n" * 70, "!" * 3000, "a" * 70_000, "the quick " * 3000, "'", " '", "x'", "'r", " ", ""]
    return texts + [f"a{c}!{c}0 {c}{c}'{c}" for c in map(chr, [*range(0x2FF), *range(0x2000, 0x2070), 0xD7FF, 0xE000, 0x10FFFF])]


def test_texts_get_the_ids_of_the_library(spark):
    texts, coder = some_texts(), tf._tokenizer(text_of(TOKENIZER))
    of = jvm.function(spark, "TextIds", byte_level.tables(text_of(TOKENIZER), 2))
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(4)
    found = dict(rows.select("i", of(F.col("text").cast("binary"))).collect())
    for i, (text, made) in enumerate(zip(texts, coder.encode_batch(texts, add_special_tokens=False))):
        assert np.frombuffer(found[i], "<u4").tolist() == [*made.ids, 2], text


def test_a_text_that_is_not_utf8_is_an_error(spark):
    of = jvm.function(spark, "TextIds", byte_level.tables(text_of(TOKENIZER), 2))
    for wrong in ("61FF", "C3", "E28061", "C080", "EDA080", "F4908080", "80"):
        with pytest.raises(Exception, match="not UTF-8"):
            spark.range(1).select(of(F.expr(f"X'{wrong}'"))).collect()


def test_another_tokenizer_goes_to_the_library(spark):
    assert byte_level.tables(text_of(OTHER), 1) is None
    rows = [(2, "Another  Text, don't"), (1, None), (3, "ÉTÉ\n12")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    folder = f"{work_folder(spark)}/ids"
    found = tf.read(tf.write(docs, folder, OTHER, 1), folder, digest_only=False).orderBy("doc_id").collect()
    coder = tf._tokenizer(text_of(OTHER))
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in found] == [
        [*coder.encode(text or "", add_special_tokens=False).ids, 1] for _, text in sorted(rows)]


def test_files_are_coded_in_the_jvm_and_read_by_numpy(spark):
    docs = spark.createDataFrame([(i, f"text {i} " * (300 * i)) for i in range(9)] + [(None, "x")], "doc_id long, text string")
    folder = f"{work_folder(spark)}/ids"
    files = tf.write(docs, folder, TOKENIZER, 2)
    back = tf.read(files, folder, digest_only=False)
    assert "tickloom_IdBlocks" in back._jdf.queryExecution().toString()
    found = sorted((r["start"], r["doc_id"], bytes(r["ids"])) for r in back.collect())
    (name,), = files.select("file").collect()
    with open(f"{folder.removeprefix('file://')}/{name}", "rb") as source:
        plain = list(tf.read_file(source))
    assert [(d, ids) for _, d, ids in found] == [(d, ids.tobytes()) for d, ids in plain]


@pytest.mark.parametrize("place", [3, 40, -300])
def test_damaged_files_are_an_error(spark, place):
    docs = spark.createDataFrame([(i, f"text {i * i} " * 3000) for i in range(3)], "doc_id long, text string")
    folder = f"{work_folder(spark)}/ids"
    files = tf.write(docs, folder, TOKENIZER, 2)
    path = f"{folder.removeprefix('file://')}/{files.first()['file']}"
    with open(path, "rb") as source:
        data = bytearray(source.read())
    data[place] ^= 4
    with open(path, "wb") as sink:
        sink.write(data)
    with pytest.raises(Exception, match="damaged|checksum"):
        tf.read(files, folder).collect()
