"""Hidden Markov language model over whole documents.

Method: Baum-Welch. A document's words become symbols of a bounded alphabet: the most frequent
training words have a symbol each, all others share one by a hash of their ending. A word's
probability is P(symbol | state) * P(word | symbol); the second factor comes from the corpus
counts of all words. Every iteration computes expected counts in all partitions, Spark adds
them up, and the driver receives one row per symbol. Scores are exact: the scaled forward
recursion sums over all state sequences.

Words are looked up by blocks of documents: a task numbers the words of its block, so the
shuffle carries every distinct word of a block once instead of every word of every text.

Defined cases: a null text is an empty one, which still has its end token; a null id is kept
as it is; repeated rows are scored (and counted) each; without training documents all counts
are zero and the model is uniform; further columns are ignored.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.llm.chains import likelihoods, posteriors
from tickloom.llm.common import raw, stored, utf8

BLOCK_WORDS = 300_000       # distinct words that a task numbers before it starts a new block
BLOCK_TOKENS = 4_000_000
SLICE = 500                 # texts that a task splits into words before it hands them on
END = 0                     # symbol of the end token


class _Numbers(dict):
    def __missing__(self, word):
        number = self[word] = len(self)
        return number


def number_words(docs: DataFrame, id_col: str, text_col: str, training: Column) -> DataFrame:
    """Documents as arrays of block-local word numbers, and the blocks' words with counts."""
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                         F.coalesce(training, F.lit(False)).alias("training"))
    kind = chosen.schema["doc_id"].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext

        task, seq, schema = TaskContext.get().partitionId(), 0, None
        numbers, counted, tokens = _Numbers(), [], 0

        def words():
            n = np.bincount(np.concatenate(counted), minlength=len(numbers)) if counted else np.zeros(len(numbers))
            every = list(numbers)
            for at in range(0, len(every), 50_000):
                some = every[at:at + 50_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([block] * len(some), pa.int64()), pa.nulls(len(some), schema),
                    pa.nulls(len(some), pa.bool_()), pa.nulls(len(some), pa.binary()), utf8(some),
                    pa.array(np.arange(at, at + len(some), dtype=np.int32)),
                    pa.array(n[at:at + len(some)].astype(np.int64))], names)

        names = ["block", "doc_id", "training", "ids", "word", "local_id", "n"]
        for batch in batches:
            schema = batch.column(0).type
            for at in range(0, batch.num_rows, SLICE):
                some, made = batch.slice(at, SLICE), []
                block = (task << 24) | seq
                for text, train in zip(raw(some.column(1)), some.column(2).to_pylist()):
                    found = (text or b"").lower().split()
                    ids = np.fromiter(map(numbers.__getitem__, found), np.uint32, len(found))
                    made.append(ids.tobytes())
                    tokens += len(ids)
                    if train:
                        counted.append(ids)
                rows = some.num_rows
                yield pa.RecordBatch.from_arrays([
                    pa.array([block] * rows, pa.int64()), some.column(0), some.column(2),
                    pa.array(made, pa.binary()), pa.nulls(rows, pa.string()), pa.nulls(rows, pa.int32()),
                    pa.nulls(rows, pa.int64())], names)
                if len(numbers) > BLOCK_WORDS or tokens > BLOCK_TOKENS:
                    yield from words()
                    numbers, counted, tokens, seq = _Numbers(), [], 0, seq + 1
        if schema is not None and numbers:
            yield from words()

    return chosen.mapInArrow(run, f"block long, doc_id {kind}, training boolean, ids binary, "
                                  "word string, local_id int, n long")


def encode(docs: DataFrame, id_col: str, text_col: str, training: Column, top_words: int,
           classes: int) -> tuple[DataFrame, np.ndarray, int]:
    """Documents as symbols with their base scores; symbol counts; number of training tokens."""
    spark = docs.sparkSession
    rows = stored(number_words(docs, id_col, text_col, training))
    kind = rows.schema["doc_id"].dataType.simpleString()
    by_word = Window.partitionBy("word")
    counted = stored(rows.filter("word is not null").select(
        "block", "local_id", "word", F.sum("n").over(by_word).alias("c"),
        (F.row_number().over(by_word.orderBy("block")) == 1).alias("once")))
    known = counted.filter("once and c > 0")
    n_train = rows.filter("word is null and training").count()
    totals = known.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    train_tokens, vocabulary = totals["n"] + n_train, totals["v"] + (n_train > 0)
    denominator = train_tokens + vocabulary + 1

    # Both tables are bounded by parameters: top_words and classes.
    top = known.orderBy(F.desc("c"), "word").limit(top_words).select("word", "c").collect()
    ranks = spark.createDataFrame([(r["word"], i + 1) for i, r in enumerate(top)], "word string, rank int")
    ending = F.pmod(F.xxhash64(F.right("word", F.lit(2))), F.lit(classes)).cast("int")
    shared = known.join(F.broadcast(ranks), "word", "left_anti").groupBy(ending.alias("ending")).agg(
        F.sum("c").alias("class_n"), F.count("*").alias("class_v")).collect()
    sizes = spark.createDataFrame([tuple(r) for r in shared], "ending int, class_n long, class_v long")
    counts = np.zeros(1 + len(top) + classes)
    counts[END] = n_train
    counts[1:1 + len(top)] = [r["c"] for r in top]
    for r in shared:
        counts[1 + len(top) + r["ending"]] = r["class_n"]

    places = (counted.join(F.broadcast(ranks), "word", "left").withColumn("ending", ending)
              .join(F.broadcast(sizes), "ending", "left")
              .select("block", "local_id", "c",
                      F.coalesce("rank", F.col("ending") + 1 + len(top)).alias("symbol"),
                      F.when(F.col("rank").isNotNull(), 0.0).otherwise(F.log10(
                          (F.col("c") + 1) / (F.coalesce("class_n", F.lit(0)) + F.coalesce("class_v", F.lit(0)) + 1)
                      )).alias("within")))
    kind_of_symbol = np.uint16 if len(counts) <= 1 << 16 else np.int32
    end_score = float(np.log10((n_train + 1) / denominator))

    def run(left, right):
        order = np.argsort(right.column("local_id").to_numpy())
        c = right.column("c").to_numpy()[order]
        symbol = right.column("symbol").to_numpy()[order].astype(kind_of_symbol)
        within = right.column("within").to_numpy()[order]
        base = np.log10((c + 1) / denominator)
        out = []
        for ids in left.column("ids"):
            ids = np.frombuffer(ids.as_buffer(), np.uint32)
            out.append((len(ids) + 1, int((c[ids] > 0).sum()) + (n_train > 0),
                        float(base[ids].sum()) + end_score, float(within[ids].sum()),
                        np.append(symbol[ids], kind_of_symbol(END)).tobytes()))
        columns = zip(*out)
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
        return pa.table([left.column("doc_id"), left.column("training"),
                         *(pa.array(x, t) for x, t in zip(columns, kinds))],
                        ["doc_id", "training", "n_tokens", "n_known", "base_score", "within", "symbols"])

    encoded = rows.filter("word is null").select("block", "doc_id", "training", "ids").groupBy("block").cogroup(
        places.groupBy("block")).applyInArrow(
        run, f"doc_id {kind}, training boolean, n_tokens long, n_known long, "
             "base_score double, within double, symbols binary")
    return stored(encoded), counts, train_tokens


def _sequences(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and symbols (of an alphabet of `size`) of a batch, without a copy."""
    kind = np.dtype(np.uint16 if size <= 1 << 16 else np.int32)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if not len(column) or data is None:
        return np.zeros(len(column), np.int64), np.zeros(0, kind)
    return np.diff(offsets) // kind.itemsize, np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]].view(kind)


def train(encoded: DataFrame, counts: np.ndarray, states: int, iterations: int, seed: int = 7):
    """Baum-Welch over all training documents: first, transition and emission probabilities."""
    spark, size = encoded.sparkSession, len(counts)
    unigram = (counts + 1) / (counts.sum() + size)
    rng = np.random.default_rng(seed)
    first = np.full(states, 1 / states)
    trans = np.full((states, states), 0.1 / max(1, states - 1)) if states > 1 else np.ones((1, 1))
    if states > 1:
        np.fill_diagonal(trans, 0.9)
    emit = unigram[:, None] * rng.uniform(0.5, 1.5, (size, states))
    emit /= emit.sum(axis=0)
    texts = encoded.filter("training").select("symbols")
    columns = [f"c{k}" for k in range(states)]

    for _ in range(iterations):
        # Single precision is enough for counts; scores are computed in double precision.
        model = spark.sparkContext.broadcast(tuple(x.astype(np.float32) for x in (first, trans, emit)))

        def expect(batches):
            first, trans, emit = model.value
            total = np.zeros((size + states + 1, states))
            for batch in batches:
                lengths, symbols = _sequences(batch.column(0), size)
                starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
                for at, sequence, gamma, moves, _ in posteriors(lengths, lambda p: emit[symbols[p]], first, trans):
                    seen = symbols[at]
                    for k in range(states):
                        total[:size, k] += np.bincount(seen, gamma[:, k], minlength=size)
                    total[size:size + states] += moves
                    total[-1] += gamma[at == starts[sequence]].sum(axis=0)
            used = np.flatnonzero(total.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), *(pa.array(total[used, k]) for k in range(states))],
                ["symbol", *columns])

        sums = texts.mapInArrow(expect, "symbol int, " + ", ".join(f"{c} double" for c in columns)) \
            .groupBy("symbol").agg(*[F.sum(c).alias(c) for c in columns]).collect()
        total = np.zeros((size + states + 1, states))
        for row in sums:
            total[row["symbol"]] = row[1:]
        model.unpersist()
        first = (total[-1] + 1) / (total[-1] + 1).sum()
        trans = total[size:size + states] + 1
        trans /= trans.sum(axis=1, keepdims=True)
        emit = total[:size] + SMOOTHING * unigram[:, None]
        emit /= emit.sum(axis=0)
    return first, trans, emit


SMOOTHING = 200.0           # training tokens that the corpus-wide distribution counts as in a state


def score_documents(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
                    states: int = 6, iterations: int = 6, top_words: int = 16_384,
                    classes: int = 1_024) -> DataFrame:
    """doc_id, training, n_tokens, n_known, train_tokens, base_score and score of every row.

    `training` says which rows the model learns from. score is log10 of the document's
    probability under the model, base_score under add-one smoothed word counts.
    """
    encoded, counts, train_tokens = encode(docs, id_col, text_col, training, top_words, classes)
    model = docs.sparkSession.sparkContext.broadcast(train(encoded, counts, states, iterations))
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def score(batches):
        first, trans, emit = model.value
        for batch in batches:
            lengths, symbols = _sequences(batch.column("symbols"), len(emit))
            logs = likelihoods(lengths, lambda p: emit[symbols[p]], first, trans) / np.log(10)
            kept = [batch.column(c) for c in NAMES[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(logs + batch.column("within").to_numpy())], list(NAMES))

    return encoded.mapInArrow(
        score, f"doc_id {kind}, training boolean, n_tokens long, n_known long, base_score double, score double"
    ).withColumn("train_tokens", F.lit(train_tokens).cast("long"))


NAMES = ("doc_id", "training", "n_tokens", "n_known", "base_score", "score")
