"""A corpus pipeline: language, near duplicates, benchmark passages, credentials, token ids.

Every stage takes (spark, docs, sf_dir) and works on all documents that the stages before it
kept; its result is written as Parquet and read again as the next stage's documents. Documents
that a stage neither drops nor changes are not shuffled. All but the last return the columns of
documents. Null texts, repeated rows and further columns are
handled as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import bpe, credentials, decontam, langid, near_dedup
from tickloom.llm.common import parted, row_key
from tickloom.llm.queries import fold, table
from tickloom.session import materialize, ship, temporary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose language cannot be told: those without a letter. A text that switches
    between languages stays, however evenly; so does every text with a letter where no document
    has a language to learn from."""
    ship(spark)
    with temporary(spark):
        model = langid.fit(docs, F.coalesce(fold(4) != 2, F.lit(True)))
    if model is None:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return langid.label(docs, model).filter(F.col("lang_pred") != langid.UNDETERMINED).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id. Rows
    that repeat an id stay together, and so do copies without one."""
    ship(spark)
    with temporary(spark):
        gone = materialize(near_dedup.near_duplicates(docs).groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).filter(
            "not kept").select("doc_id"), keep=True)
    maybe, stay = parted(docs, [docs["doc_id"].cast("long")], gone, [F.col("doc_id")])
    return maybe.join(gone, maybe["doc_id"] == gone["doc_id"], "left_anti").union(stay)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item (or a shorter item) go."""
    ship(spark)
    with temporary(spark):
        found = materialize(decontam.contamination(docs, table(spark, sf_dir, "benchmark")).filter("contaminated").select(
            "_id", "_text").distinct(), keep=True)
    id_, text = row_key("doc_id", "text")
    maybe, stay = parted(docs, [id_, text], found, [F.col("_id"), F.col("_text")])
    return maybe.join(found, id_.eqNullSafe(found["_id"]) & (text == found["_text"]), "left_anti").union(stay)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Credentials in texts are masked; every document stays."""
    ship(spark)
    return credentials.redact(docs).select(*[
        F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text (little-endian unsigned 32-bit integers), checked by decoding."""
    ship(spark)
    return bpe.encode_texts(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                            keep=["doc_id", "lang", "source"], check=True)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("redact", redact), ("encode", encode)]
ORACLE_SQL = None       # language fields, hashed signatures and byte-pair merges are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        # What a stage stores on its way goes when its result is written.
        with temporary(spark):
            docs = materialize(stage(spark, docs, sf_dir), keep=True)
    return docs
