"""Benchmark passages in documents, by winnowing.

Method: a text's k-grams of words are hashed, and of every window of w consecutive hashes the
minimum is kept, so that two texts that share w + k - 1 words share a kept hash. Documents'
and items' kept hashes are joined; a hit is extended to the whole windows of `SPAN` words
around it, which are compared in full (their first and last k-gram cover all their words).
Words are hashed once; a k-gram's hash is that of its words' hashes.
With k = 5 and w = 6 every shared span of ten words is found. An item of fewer words is one
window of its own length, with its own k and w.

Only DataFrame functions are used. All texts are split up once, for the number of words and the
kept hashes; hashes that no item has end in the first join, and what is left of a document is
one row before anything is shuffled (unless the items are too many to broadcast). Texts are
read again, and shuffled, for documents with a hit only (and few others, by a filter of bounded
size). Whether items are broadcast is left to Spark,
which knows their stored size.

Defined cases: null texts have no words; an empty benchmark hits nothing; items without words
occur nowhere; a null item_id counts as an empty string; equal item rows are one item;
documents are told apart by id (null allowed) and text, so repeated rows get the same result;
further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import let, lowered, parted, row_key, stored

SPAN = 10
KGRAM = 5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lowered(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def word_hashes(text: Column) -> Column:
    """One number per word, so that k-grams and windows never touch the words again."""
    return F.transform(words_of(text), lambda w: F.xxhash64(w))


def _steps(n: Column) -> Column:
    """1 to n; nothing if n is below 1."""
    return F.when(n >= 1, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def kgrams(words: Column, k: int) -> Column:
    return F.transform(_steps(F.size(words) - (k - 1)), lambda i: F.xxhash64(F.slice(words, i, k)))


def minima(grams: Column, w: int, span: int) -> Column:
    """For every window of w consecutive hashes its minimum, marked with the span's length."""
    return F.transform(_steps(F.size(grams) - (w - 1)),
                       lambda i: F.xxhash64(F.array_min(F.slice(grams, i, w)), F.lit(span)))


def _sizes(span: int) -> tuple[int, int]:
    k = min(KGRAM, span)
    return k, span - k + 1


def kept_hashes(words: Column, spans: list[int]) -> Column:
    """All kept hashes of a text, for all lengths of windows."""
    def of(span: int) -> Column:
        k, w = _sizes(span)
        return let(kgrams(words, k), lambda g: F.array_distinct(minima(g, w, span)))

    return F.flatten(F.array(*[of(s) for s in spans]))


def windows(words: Column, spans: list[int], wanted: Column | None = None) -> Column:
    """Windows as (start, span, kept, first, last); with `wanted` only those with such a hash."""
    def of(span: int) -> Column:
        k, w = _sizes(span)

        def made(grams: Column) -> Column:
            def with_minima(kept: Column) -> Column:
                at = F.sequence(F.lit(1), F.size(kept))
                if wanted is not None:
                    at = F.filter(at, lambda i: F.array_contains(wanted, F.get(kept, i - 1)))
                return F.transform(at, lambda i: F.struct(
                    i.alias("start"), F.lit(span).alias("span"), F.get(kept, i - 1).alias("kept"),
                    F.get(grams, i - 1).alias("first"), F.get(grams, i + (w - 2)).alias("last")))

            return let(minima(grams, w, span), lambda kept: F.when(F.size(kept) > 0, with_minima(kept)))

        return let(kgrams(words, k), made)

    return F.flatten(F.filter(F.array(*[of(s) for s in spans]), lambda x: x.isNotNull()))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", span: int = SPAN) -> DataFrame:
    """The key (_id, _text), n_words, n_hit, n_items, items_sha256 and contaminated of every row."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                             word_hashes(F.col(item_text_col)).alias("words")).filter(F.size("words") > 0)
    items = items.withColumn("length", F.least(F.size("words"), F.lit(span)))
    # At most `span` different lengths.
    spans = sorted(r["length"] for r in items.select("length").distinct().collect())
    nothing = {"n_hit": F.lit(0).cast("long"), "n_items": F.lit(0).cast("long"), "items_sha256": F.sha2(F.lit(""), 256)}
    if not spans:
        every = docs.select(*row_key(id_col, text_col), F.size(words_of(F.col(text_col))).cast("long").alias("n_words"))
        return every.withColumns({**nothing, "contaminated": F.lit(False)})
    parts = [items.filter(F.col("length") == s).select("item", F.explode(
        let(F.col("words"), lambda w: windows(w, [s]))).alias("x"))
             for s in spans]
    made = parts[0]
    for part in parts[1:]:
        made = made.union(part)
    known = stored(made.select("item", "x.span", "x.kept", "x.first", "x.last").distinct())
    every = stored(_looked_up(docs, known, spans, id_col, text_col))
    hits = _hits(docs, known, every.filter(F.size("wanted") > 0), spans, id_col, text_col)
    # Repeated rows of a document get a row each.
    e, h = every.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).alias("e"), hits.alias("h")
    joined = e.join(h, F.col("e._id").eqNullSafe(F.col("h._id")) & (F.col("e._text") == F.col("h._text")), "left")
    return joined.select("e._id", "e._text", "n_words", *[F.coalesce(c, v).alias(c) for c, v in nothing.items()],
                         F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


def _looked_up(docs: DataFrame, known: DataFrame, spans: list[int], id_col: str, text_col: str) -> DataFrame:
    """The key, n_words, number of copies and `wanted` (kept hashes that some item has) of every document."""
    read = docs.select(*row_key(id_col, text_col), let(word_hashes(F.col(text_col)), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), kept_hashes(w, spans).alias("kept"))).alias("x"))
    prints = read.select("_id", "_text", "x.n_words", F.posexplode_outer("x.kept").alias("at", "kept"))
    # A document without hashes gets one of its own, so that such rows do not meet in one task.
    prints = prints.withColumn("kept", F.coalesce("kept", F.xxhash64("_id", "_text", F.lit("none"))))
    found = prints.join(known.select("kept").distinct().withColumn("_known", F.lit(True)), "kept", "left")
    first = F.coalesce(F.col("at"), F.lit(0)) == 0
    return found.groupBy("_id", "_text").agg(
        F.max("n_words").alias("n_words"), F.count_if(first).alias("copies"),
        F.collect_set(F.when(F.col("_known"), F.col("kept"))).alias("wanted"))


def _hits(docs: DataFrame, known: DataFrame, flagged: DataFrame, spans: list[int], id_col: str, text_col: str) -> DataFrame:
    """n_hit, n_items and items_sha256 of documents that hold a window of an item."""
    key = ["_id", "_text"]
    texts = docs.select(*row_key(id_col, text_col), F.col(text_col).alias("text"))
    maybe, _ = parted(texts, [F.col(c) for c in key], flagged, [F.col(c) for c in key])
    again = maybe.alias("t").join(flagged.alias("f"), F.col("t._id").eqNullSafe(F.col("f._id")) & (F.col("t._text") == F.col("f._text")))
    found = again.select("t._id", "t._text", F.explode(let(
        word_hashes(F.col("text")), lambda w: windows(w, spans, F.col("wanted")))).alias("x")).select(*key, "x.*")
    same = ["span", "kept", "first", "last"]
    found = stored(found.join(known.select(*same).distinct(), same, "left_semi").distinct())

    # Words covered by windows: what a window adds after all that start before it.
    def cover(seen: Column, x: Column) -> Column:
        end = x["start"] + x["span"]
        return F.struct(F.greatest(seen["end"], end).alias("end"),
                        (seen["n"] + F.greatest(F.lit(0), end - F.greatest(seen["end"], x["start"]))).alias("n"))

    covered = found.groupBy(*key).agg(F.sort_array(F.collect_set(F.struct("start", "span"))).alias("at")).select(
        *key, F.aggregate("at", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), cover)["n"].cast("long").alias("n_hit"))
    named = found.select(*key, *same).distinct().join(known, same).groupBy(*key).agg(
        F.sort_array(F.collect_set("item")).alias("items")).select(
        *key, F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    c, n = covered.alias("c"), named.alias("n")
    return c.join(n, F.col("c._id").eqNullSafe(F.col("n._id")) & (F.col("c._text") == F.col("n._text"))).select(
        "c._id", "c._text", "n_hit", "n_items", "items_sha256")
