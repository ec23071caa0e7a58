"""Quality of documents: fixed rules, and a likelihood ratio of hashed n-grams.

Method: words and word pairs are hashed into `buckets`; one multinomial is counted over all
documents (raw corpus) and one over the trusted ones (target). A document's score is the mean
over its n-grams of ln(p_target / p_raw), both smoothed by one count per bucket. `judge` keeps
a document if the score reaches a given threshold and the fixed rules do not fail it.
`judge_held_out`, which the query uses, has no given threshold: documents fall into folds by
their id, a fold is scored with the trusted documents of the others, and the score and the
lowest window of a text are held against a low quantile of the trusted documents. The same
thresholds hold for every document.

Only DataFrame functions are used. The counts have one row per bucket; counting is combined in
every task before it is shuffled. The weights are made of them by Spark, as one stored row per
fold, and are one value per fold that every task reads. Trusted ids are broadcast while they
are small (checked) and joined by shuffle beyond.

Defined cases: null texts have no words and fail the fixed rules; without trusted documents
all ratios are zero; a null id is never trusted; repeated rows count and are judged each;
further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.lookups import attach
from tickloom.llm.common import SPACES, let, unused
from tickloom.session import materialize

BUCKETS = 1 << 14
THRESHOLD = -0.25
HELD_OUT_BUCKETS, FOLDS = 1 << 20, 5
WINDOW, QUANTILE = 3, 0.005             # words of a window; share of trusted documents below a threshold
UNROLLED = 8                            # windows up to this many words are summed one by one
LEAST_WORDS, MOST_REPEATED = 50, 50     # fixed rules: words, percent of words in repeated windows


def words_of(text: Column) -> Column:
    """The words of a text. All white space becomes blanks, and splitting at one character is
    much faster than matching a pattern."""
    for c in "\t\n\x0b\f\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def joined(hashes: Column, n: int) -> Column:
    """Hashes of all runs of n words."""
    return F.slice(F.transform(hashes, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + j) for j in range(1, n)])),
                   F.lit(1), F.greatest(F.size(hashes) - (n - 1), F.lit(0)))


def repeated_words(hashes: Column) -> Column:
    """Words that lie in a window of three words found at least twice in the text."""
    def covered(places: Column) -> Column:
        return F.aggregate(F.transform(places, lambda p, i: F.least(
            F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3)))), F.lit(0), lambda a, b: a + b)

    def places(order: Column) -> Column:
        again = F.filter(order, lambda x, i: F.coalesce(F.get(order, i - 1)["h"] == x["h"], F.lit(False))
                         | F.coalesce(F.get(order, i + 1)["h"] == x["h"], F.lit(False)))
        return let(F.sort_array(F.transform(again, lambda x: x["i"])), covered)

    def counted(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(ordered, places))

    return let(joined(hashes, 3), counted).cast("long")


def base(text: Column) -> dict[str, Column]:
    """n_symbols and n_dup_lines of a text."""
    lines = F.transform(F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(f"[^{SPACES}]"))),
                        lambda x: F.xxhash64(x))
    return {
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    }


def target_ids(trusted: DataFrame) -> DataFrame:
    """_id of the target documents, once each, with a column `target`."""
    return trusted.select(F.col(trusted.columns[0]).alias("_id")).filter("_id is not null").distinct().withColumn(
        "target", F.lit(1))


def fold_of(id_: Column, folds: int) -> Column:
    return F.pmod(F.xxhash64(id_), F.lit(folds)).cast("int")


def ratio_table(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str, buckets: int, folds: int = 1) -> DataFrame:
    """Per fold its `weights`, ln(p_target / p_raw) of every bucket, stored; `buckets` is a power
    of two. `trusted` has the ids of the target documents. With several folds, the target of a
    fold is counted without the documents whose id falls into it."""
    if buckets & (buckets - 1):
        raise ValueError("the number of buckets must be a power of two")
    text = F.coalesce(F.col("_text"), F.lit(""))
    rows = attach(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), target_ids(trusted), ["_id"], row_bytes=24)
    words = F.transform(words_of(text), lambda w: F.xxhash64(w))
    # The fold is told once per row, before its n-grams are dealt out.
    grams = rows.select(F.when(F.col("target").isNotNull(), fold_of(F.col("_id"), folds)).otherwise(-1).alias("home"), "_text").select(
        "home", F.explode(let(words, lambda h: F.concat(h, joined(h, 2)))).alias("gram"))
    held = [F.count(F.when(F.col("home") == k, 1)).alias(f"target{k}") for k in range(folds)]
    counted = materialize(grams.groupBy(F.col("gram").bitwiseAND(buckets - 1).alias("bucket")).agg(
        F.count("*").alias("raw"), *held))
    raw, *own = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in counted.columns[1:]]).first()
    every = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(counted, "bucket", "left").fillna(0)
    made = []
    for k in range(folds):
        # One count per bucket smooths both; a target without n-grams tells nothing.
        size = own[k] if folds == 1 else sum(own) - own[k]
        target = F.col(f"target{k}") if folds == 1 else sum(F.col(f"target{j}") for j in range(folds) if j != k)
        weight = F.log((target + 1) / (F.col("raw") + 1)) + math.log((raw + buckets) / (size + buckets))
        made.append(weight if size else F.lit(0.0))
    # Parts first, so that no task holds all values one by one.
    parts = every.select("bucket", F.posexplode(F.array(*made)).alias("fold", "w")).groupBy(
        "fold", F.shiftright("bucket", 10).alias("part")).agg(F.sort_array(F.collect_list(F.struct("bucket", "w")))["w"].alias("w"))
    return materialize(parts.groupBy("fold").agg(F.flatten(F.sort_array(F.collect_list(F.struct("part", "w")))["w"]).alias("weights")))


def ratios(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str, buckets: int, folds: int = 1) -> np.ndarray:
    """The weights of `ratio_table`, by fold and bucket."""
    return np.array([r["weights"] for r in ratio_table(docs, trusted, id_col, text_col, buckets, folds).sort("fold").collect()])


def scored(docs: DataFrame, weights: np.ndarray | DataFrame, id_col: str, text_col: str, window: int = 0) -> DataFrame:
    """doc_id, n_words, the counts of `base`, n_repeat_words, ratio and base_failed of every row;
    with `window`, also `lowest`. A row's weights are those of the fold of its id."""
    if isinstance(weights, np.ndarray):
        weights = materialize(docs.sparkSession.createDataFrame(pa.table(
            {"fold": pa.array(range(len(weights)), pa.int32()), "weights": pa.array(list(weights), pa.list_(pa.float64()))})))
    folds, buckets = weights.agg(F.count("*"), F.max(F.size("weights"))).first()
    text = F.coalesce(F.col(text_col), F.lit(""))

    def measured(hashes: Column, table: Column) -> Column:
        def weight(gram: Column) -> Column:
            return F.get(table, gram.bitwiseAND(buckets - 1).cast("int"))

        # The weight of a word and of the pair that it ends.
        each = F.transform(hashes, lambda h, i: weight(h) + F.when(
            i > 0, weight(F.xxhash64(F.get(hashes, i - 1), h))).otherwise(0.0))
        n = F.size(hashes)

        def total(part: Column) -> Column:
            return F.aggregate(part, F.lit(0.0), lambda a, x: a + x)

        def low(w: Column) -> Column:
            if window <= UNROLLED:
                # Sums that reach beyond the last word are null, which a minimum leaves out.
                sums = F.transform(w, lambda x, i: sum((F.get(w, i + j) for j in range(1, window)), x))
                return F.array_min(sums) / (2 * window)
            moved = F.aggregate(
                F.sequence(F.lit(window), n - 1),
                F.struct(total(F.slice(w, 1, window)).alias("sum"), F.lit(float("inf")).alias("low")),
                lambda a, i: F.struct((a["sum"] + F.get(w, i) - F.get(w, i - window)).alias("sum"),
                                      F.least(a["low"], a["sum"]).alias("low")),
                lambda a: F.least(a["low"], a["sum"]))
            return moved / (2 * window)

        def of_weights(w: Column) -> Column:
            ratio = total(w) / F.greatest(F.lit(1), 2 * n - 1)
            lowest = [F.when(n > window, low(w)).otherwise(ratio).alias("lowest")] if window else []
            return F.struct(n.cast("long").alias("n_words"), repeated_words(hashes).alias("n_repeat_words"),
                            ratio.alias("ratio"), *lowest)

        return let(each, of_weights)

    def of_words(words: Column, table: Column) -> Column:
        return F.struct(F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                        let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: measured(h, table)).alias("m"))

    # The weights of a fold are one value that every task reads where it lies; no row carries them.
    own, fold = unused(docs, "_weights"), fold_of(F.col(id_col), folds)
    found = F.coalesce(*[F.when(fold == k, weights.filter(F.col("fold") == k).select("weights").scalar()) for k in range(folds)])
    rows = docs.withColumn(own, found).select(
        F.col(id_col).alias("doc_id"), let(F.col(own), lambda t: let(
            words_of(text), lambda words: of_words(words, t))).alias("w"), *[c.alias(name) for name, c in base(text).items()])
    rows = rows.select("*", "w.word_chars", "w.m")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.select(
        "doc_id", F.col("m.n_words").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.col("m.n_repeat_words").alias("n_repeat_words"), *[F.round(f"m.{c}", 6).alias(c) for c in (
            ["ratio", "lowest"] if window else ["ratio"])]).withColumn("base_failed", failed)


def judge(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, the counts of `base`, n_repeat_words, ratio, base_failed and kept of every
    row, by a given threshold on the ratio of whole documents."""
    weights = ratio_table(docs, trusted, id_col, text_col, buckets)
    return scored(docs, weights, id_col, text_col).withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= threshold))


def judge_held_out(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   buckets: int = HELD_OUT_BUCKETS, quantile: float = QUANTILE, window: int = WINDOW,
                   folds: int = FOLDS) -> DataFrame:
    """As `judge`, with `lowest` as well, and with thresholds that the trusted documents set.

    Ratios are held out: no document, trusted or not, counts in its own target. A document is
    kept if neither its ratio nor its lowest window is below the `quantile` of the trusted
    documents that pass the fixed rules.
    """
    weights = ratio_table(docs, trusted, id_col, text_col, buckets, folds)
    rows = materialize(scored(docs, weights, id_col, text_col, window))
    known = attach(rows.filter(~F.col("base_failed")).withColumnRenamed("doc_id", "_id"), target_ids(trusted), ["_id"],
                   "inner", row_bytes=24)
    cuts = known.agg(*[F.percentile_approx(c, quantile, 100_000).alias(c) for c in ("ratio", "lowest")]).first()
    kept = ~F.col("base_failed")
    for c in ("ratio", "lowest"):
        if cuts[c] is not None:
            kept &= F.col(c) >= cuts[c]
    return rows.withColumn("kept", kept)
