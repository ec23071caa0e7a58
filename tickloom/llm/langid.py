"""Language of documents and of their words, by a linear-chain conditional random field.

Method: a word's score for a language sums learned weights of its features (prefixes, endings,
letter n-grams, lexicon entries; hashed), neighbouring words are tied by learned transitions,
and forward-backward gives every word's language probabilities. A document's language has the
largest mean probability over its words, which is also the score. Switches of language inside
a text show in the word labels.

Fitting uses a bounded sample of labelled documents (`per_language`, the smallest hashes of
the id); its gradient is computed in all partitions and added up by Spark, so that the driver
only ever holds the weights. Prediction covers every word of every text.

Defined cases: a null text or one without a letter is `und` with score 0; without labelled
documents everything is `und`; ties go to the first language by name; a null id is allowed;
repeated rows are labelled each; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from tickloom.llm.chains import posteriors
from tickloom.llm.common import stored, unused

UNDETERMINED = "und"
WORD = re.compile(r"[^\W\d_]+")
SIZE = 1 << 14              # hashed features
LEXICON = 2_000             # words of a language that have a feature of their own
CACHED_WORDS = 100_000      # words whose scores a task keeps from one batch to the next
TOGETHER = 2_500            # texts that are labelled together
SLICE = 200                 # texts that are split into words together
STICKY = 3.0                # first guess of the gain of staying in a language
FIRM = 4.0                  # largest transition weight: whole documents carry one label, but texts do switch


def words_of(text: str | None) -> list[str]:
    """Runs of letters. `WORD` takes other numerals (fractions, Roman, raised ones) for letters as
    well; only where it has found one are its words cut again."""
    if not text:
        return []
    words = WORD.findall(text.lower())
    if "".join(words).isalpha():
        return words
    return ["".join(part) for word in words for letter, part in groupby(word, str.isalpha) if letter]


def features(word: str, lexicon: dict[str, int]) -> list[int]:
    """Hashed prefixes, endings and letter n-grams; lexicon entries as they are."""
    whole = f"^{word}$"
    n = len(whole)
    names = [f"p{whole[:k]}" for k in (2, 3, 4) if k < n]
    names += [f"s{whole[-k:]}" for k in (2, 3, 4) if k < n]
    names += [whole[i:i + 2] for i in range(n - 1)]
    names += [whole[i:i + 3] for i in range(n - 2)]
    found = [zlib.crc32(x.encode()) % SIZE for x in names]
    entry = lexicon.get(word)
    if entry is not None:
        found.append(SIZE + entry)
    return found


class Words:
    """Numbers of words with their scores, for a task; forgotten when there are too many."""

    def __init__(self, weights: np.ndarray, lexicon: dict[str, int]):
        self.weights, self.lexicon = weights, lexicon
        self.forget()

    def forget(self):
        self.numbers: dict[str, int] = {}
        self.potentials = np.zeros((0, self.weights.shape[1]), np.float32)

    def number(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and word numbers of the texts."""
        if len(self.numbers) > CACHED_WORDS:
            self.numbers = {}       # the scores stay, for texts that are numbered already
        numbers, new, known = self.numbers, [], len(self.potentials)
        for words in texts:
            for word in set(words).difference(numbers):
                numbers[word] = known + len(new)
                new.append(word)
        if new:
            found = [np.array(features(w, self.lexicon), np.int32) for w in new]
            starts = np.concatenate(([0], np.cumsum([len(f) for f in found])))[:-1]
            scores = np.add.reduceat(self.weights[np.concatenate(found)], starts, axis=0)
            self.potentials = np.concatenate((self.potentials, potentials(scores)))
        lengths = np.array([len(w) for w in texts], np.int64)
        flat = [np.fromiter(map(numbers.__getitem__, w), np.int32, len(w)) for w in texts]
        return lengths, np.concatenate(flat) if flat else np.zeros(0, np.int32)


def potentials(scores: np.ndarray) -> np.ndarray:
    """exp, relative to the best label; a floor keeps impossible labels from becoming zero."""
    return np.maximum(np.exp(scores - scores.max(axis=1, keepdims=True)), 1e-12).astype(np.float32)


def fit(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", per_language: int = 400, iterations: int = 10) -> dict | None:
    """Weights of the field, learned from a bounded sample of the labelled rows; None if none."""
    spark = docs.sparkSession
    rows = docs.filter(F.coalesce(training, F.lit(False)) & F.col(lang_col).isNotNull()
                       & F.col(text_col).rlike(r"\p{L}"))
    hashed = rows.select(F.col(lang_col).cast("string").alias("lang"),
                         F.xxhash64(F.col(id_col), F.lit("langid")).alias("h"), F.col(text_col).alias("text"))
    # The order needs the hash alone; texts of the chosen rows are read again afterwards.
    chosen = hashed.select("lang", "h").withColumn(
        "rn", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(
        F.col("rn") <= per_language).select("lang", "h").distinct().collect()
    if not chosen:
        return None
    languages = sorted({r["lang"] for r in chosen})
    picked = spark.createDataFrame([tuple(r) for r in chosen], "lang string, h long")
    sample = stored(hashed.join(F.broadcast(picked), ["lang", "h"], "left_semi").select("lang", "text")
                    .repartition(max(2, spark.sparkContext.defaultParallelism)))

    def count(batches):
        seen: dict[tuple[str, str], int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word in words_of(text):
                    seen[lang, word] = seen.get((lang, word), 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen], pa.string()),
                                          pa.array([k[1] for k in seen], pa.string()),
                                          pa.array(list(seen.values()), pa.int64())], ["lang", "word", "n"])

    counted = sample.select("lang", "text").mapInArrow(count, "lang string, word string, n long").groupBy(
        "lang", "word").agg(F.sum("n").alias("n"))
    entries = counted.withColumn("rn", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.desc("n"), "word"))).filter(F.col("rn") <= LEXICON).select("word")
    lexicon = {w: i for i, w in enumerate(sorted({r["word"] for r in entries.collect()}))}
    label = {x: i for i, x in enumerate(languages)}
    k, size = len(languages), SIZE + len(lexicon)

    def encode(batches):
        for batch in batches:
            texts = [words_of(t) for t in batch.column(1).to_pylist()]
            every = sorted({w for t in texts for w in t})
            at = {w: i for i, w in enumerate(every)}
            found = [features(w, lexicon) for w in every]
            columns = [np.array([len(f) for f in found], np.int32),
                       np.array([x for f in found for x in f], np.int32),
                       np.array([at[w] for t in texts for w in t], np.int32),
                       np.array([len(t) for t in texts], np.int64),
                       np.array([label[x] for x in batch.column(0).to_pylist()], np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns],
                                             ["widths", "features", "words", "lengths", "labels"])

    blocks = stored(sample.select("lang", "text").mapInArrow(
        encode, "widths binary, features binary, words binary, lengths binary, labels binary"))
    weights, moves = np.zeros((size, k)), np.zeros((k, k)) + STICKY * np.eye(k)
    step = {"weights": np.full(weights.shape, 0.1), "moves": np.full(moves.shape, 0.1)}
    last = {"weights": np.zeros(weights.shape), "moves": np.zeros(moves.shape)}
    columns = [f"c{i}" for i in range(k)]

    for _ in range(iterations):
        model = spark.sparkContext.broadcast((weights, moves))

        def slope(batches):
            weights, moves = model.value
            total, first = np.zeros((size + k, k)), np.full(k, 1 / k, np.float32)
            trans = np.exp(moves - moves.max(axis=1, keepdims=True)).astype(np.float32)
            for batch in batches:
                for row in batch.to_pylist():
                    widths = np.frombuffer(row["widths"], np.int32)
                    found = np.frombuffer(row["features"], np.int32)
                    words = np.frombuffer(row["words"], np.int32)
                    lengths = np.frombuffer(row["lengths"], np.int64)
                    labels = np.frombuffer(row["labels"], np.int32)
                    starts = np.cumsum(widths) - widths
                    emit = potentials(np.add.reduceat(weights[found], starts, axis=0))
                    slopes = np.zeros((len(widths), k))
                    for at, sequence, gamma, expected, _ in posteriors(lengths, lambda p: emit[words[p]], first, trans):
                        gamma = -gamma.astype(np.float64)
                        gamma[np.arange(len(at)), labels[sequence]] += 1
                        for i in range(k):
                            slopes[:, i] += np.bincount(words[at], gamma[:, i], minlength=len(widths))
                        total[size:] -= expected
                    np.add.at(total[size:], (labels, labels), np.maximum(lengths - 1, 0))
                    owner = np.repeat(np.arange(len(widths)), widths)
                    for i in range(k):
                        total[:size, i] += np.bincount(found, slopes[owner, i], minlength=size)
            used = np.flatnonzero(total.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)),
                                              *(pa.array(total[used, i]) for i in range(k))], ["row", *columns])

        made = blocks.mapInArrow(slope, "row int, " + ", ".join(f"{c} double" for c in columns)).groupBy("row").agg(
            *[F.sum(c).alias(c) for c in columns]).collect()
        total = np.zeros((size + k, k))
        for r in made:
            total[r["row"]] = r[1:]
        model.unpersist()
        n = max(1.0, float(np.abs(total).sum()))
        slopes = {"weights": total[:size] - 1e-4 * n / size * weights, "moves": total[size:]}
        for name, value in (("weights", weights), ("moves", moves)):
            # Steps grow while the slope keeps its sign and shrink when it changes.
            same = np.sign(slopes[name]) * last[name]
            step[name] = np.clip(np.where(same > 0, step[name] * 1.2, np.where(same < 0, step[name] * 0.5, step[name])),
                                 1e-4, 1.0)
            last[name] = np.where(same < 0, 0, np.sign(slopes[name]))
            value += last[name] * step[name]
        np.clip(moves, -FIRM, FIRM, out=moves)
    return {"languages": languages, "weights": weights.astype(np.float32), "moves": moves, "lexicon": lexicon}


def label(docs: DataFrame, model: dict | None, text_col: str = "text", spans: bool = False,
          keep: list[str] | None = None) -> DataFrame:
    """The kept columns of `docs` (default: all) with lang_pred and score; with `spans` also lang_spans: the runs of
    words of one language, as (lang, words)."""
    added = "lang_pred string, score double" + (", lang_spans array<struct<lang:string,words:int>>" if spans else "")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score", "lang_spans")]
    rows, place = docs.select(*kept), len(kept)
    if model is None:
        made = docs.select(*kept).withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})
        return made.withColumn("lang_spans", F.expr("cast(array() as array<struct<lang:string,words:int>>)")) if spans else made
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    if text_col in kept and rows.schema[text_col].dataType == StringType():
        place = kept.index(text_col)        # a kept text travels once
    else:
        rows = docs.select(*kept, F.col(text_col).cast("string").alias(unused(docs, "text")))

    def run(batches):
        model = shared.value
        languages, k = model["languages"], len(model["languages"])
        words = Words(model["weights"], model["lexicon"])
        first = np.full(k, 1 / k, np.float32)
        trans = np.exp(model["moves"] - model["moves"].max(axis=1, keepdims=True)).astype(np.float32)
        for whole in batches:
            for start in range(0, whole.num_rows, TOGETHER):
                yield labelled(whole.slice(start, TOGETHER), words, first, trans, languages)
                if len(words.potentials) > CACHED_WORDS:
                    words.forget()
            del whole       # what the batch and the words took goes back to the system
            pa.default_memory_pool().release_unused()
        words.forget()

    def labelled(batch, words, first, trans, languages):
        k = len(languages)
        # Words of a few texts at a time, as numbers from there on.
        parts = [words.number([words_of(t) for t in batch.column(place).slice(at, SLICE).to_pylist()])
                 for at in range(0, batch.num_rows, SLICE)]
        lengths, flat = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        del parts
        sums, runs = np.zeros((len(lengths), k)), {}
        for at, sequence, gamma, _, _ in posteriors(lengths, lambda p: words.potentials[flat[p]], first, trans):
            for i in range(k):
                sums[:, i] += np.bincount(sequence, gamma[:, i], minlength=len(lengths))
            if spans:
                runs.update(zip(at.tolist(), gamma.argmax(axis=1).tolist()))
        share = sums / np.maximum(lengths, 1)[:, None]
        best = share.argmax(axis=1)
        out = [pa.array([languages[b] if n else UNDETERMINED for b, n in zip(best, lengths)], pa.string()),
               pa.array(np.clip(np.where(lengths > 0, share[np.arange(len(best)), best], 0.0), 0, 1))]
        if spans:
            out.append(_runs(lengths, runs, languages))
        return pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], *out],
                                          [*kept, "lang_pred", "score", "lang_spans"][:len(kept) + len(out)])

    return rows.mapInArrow(run, f"{schema}, {added}" if schema else added)


def _runs(lengths, labels, languages):
    at, out = 0, []
    for n in lengths:
        row: list[dict] = []
        for i in range(at, at + n):
            name = languages[labels[i]]
            if row and row[-1]["lang"] == name:
                row[-1]["words"] += 1
            else:
                row.append({"lang": name, "words": 1})
        out.append(row)
        at += n
    return pa.array(out, pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32())])))
