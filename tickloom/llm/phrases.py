"""Phrases whose words come together more often than apart, mined per language by Toivonen's method.

Method: a hash sample of the documents proposes the phrases (1 to `longest` words) that reach a
lowered count there. One pass over all documents then counts exactly, by text, the proposed
phrases and their negative border: phrases of which both parts, without the last and without
the first word, are proposed (single words have no parts and are all counted). If a phrase of
the border turns out frequent, phrases that hold it may have been missed: it joins the proposed
ones, and a further pass counts what this adds to the border, taking in the same pass every
phrase that it counts anew for proposed as well, so that longer phrases are counted along with
their their parts. One such pass closes the search: a frequent phrase has frequent parts only, the
single words are all known, and from there on both parts of a phrase are proposed or counted
along with it.

The sample's counts are kept by 64-bit fingerprint, since they only propose. Proposed phrases
travel to the tasks as a set of 2^`BITS` bits by fingerprint (8 MB whatever the corpus; it is the
only thing that is broadcast): a phrase taken for a proposed one by accident is counted as well
and does no harm. Counting is by the phrases' own words; tasks add up what some `WORDS` words
hold before Spark does. Scores are exact decimals.

Defined cases: a null text has no words, a null language is `und`; repeated rows count each;
ties in score go by count, then by the phrase's bytes; an empty table has no phrases; very long
texts are split up whole but counted with the others of their batch; no column but the language
and the text is read, so ids may be null or missing and other names may clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tickloom.llm.common import Numbers, mixed, raw, stored, utf8

BITS = 26
WORDS = 400_000             # words that are counted together in a task
TEXTS = 256                 # texts that are taken from a batch at a time
SAMPLE = 8                  # one document of so many proposes
BREAK = b"."                # any of the signs that end a piece
SIGNS = b".,;:!?\n\x0b\x0c\r"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + SIGNS + b"\t", b"abcdefghijklmnopqrstuvwxyz" + BREAK * len(SIGNS) + b" ")


def split(text: bytes) -> list[bytes]:
    """The words in order, and `BREAK` between pieces."""
    return text.translate(LOWER).replace(BREAK, b" . ").split()


class _Words:
    """Words of some texts as numbers, by language; 0 stands between pieces and texts."""

    def __init__(self):
        self.numbers, self.codes, self.held = Numbers(), {}, 0
        self.numbers[BREAK]

    def add(self, lang: str, text: bytes) -> None:
        words = split(text)
        codes = self.codes.setdefault(lang, [])
        codes.append(np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words)))
        codes.append(np.zeros(1, np.int64))
        self.held += len(words) + 1

    def languages(self) -> Iterator[tuple[str, np.ndarray, np.ndarray, list[bytes]]]:
        """Language, word numbers in order, fingerprints of the numbered words there, words."""
        import xxhash

        words = list(self.numbers)
        for lang, codes in self.codes.items():
            codes = np.concatenate(codes)
            prints = np.zeros(len(words), np.uint64)
            present = np.flatnonzero(np.bincount(codes, minlength=len(words)))
            seed = xxhash.xxh32_intdigest(lang.encode())
            prints[present] = np.fromiter((xxhash.xxh64_intdigest(words[i], seed) for i in present.tolist()),
                                          np.uint64, len(present))
            yield lang, codes, prints, words


def _batched(batches) -> Iterator[_Words]:
    held = _Words()
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS):
            some = batch.slice(at, TEXTS)
            for lang, text in zip(some.column("lang").to_pylist(), raw(some.column("text"))):
                held.add(lang, text)
                if held.held >= WORDS:
                    yield held
                    held = _Words()
    if held.held:
        yield held


def _prints(codes: np.ndarray, prints: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 1 to `longest` words: fingerprints of the phrases from each place, and which exist."""
    ones = prints[codes]
    there = inside = codes > 0
    made = ones
    for size in range(1, longest + 1):
        if size > 1:
            n = max(len(codes) - size + 1, 0)
            made = mixed(made[:n], ones[size - 1:])
            there = there[:n] & inside[size - 1:]
        yield made, there


def _slots(prints: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a fingerprint is in a set of `slots` (a power of two) times 64 bits."""
    at = prints & np.uint64(64 * slots - 1)
    return (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))


def _held(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    slot, bit = _slots(prints, len(bits))
    return (bits[slot] & bit) != 0


def _bits(marked: DataFrame, slots: int) -> np.ndarray:
    """The set of (slot, bits) rows: at most `slots` of them come to the driver."""
    made = np.zeros(slots, np.uint64)
    rows = marked.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    made[rows.column("slot").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return made


def _marks(prints: np.ndarray, slots: int) -> pa.RecordBatch:
    slot, bit = _slots(prints, slots)
    return pa.RecordBatch.from_arrays([pa.array(slot), pa.array(bit.view(np.int64))], ["slot", "bits"])


def _propose(rows: DataFrame, longest: int, lowered: int, slots: int) -> np.ndarray:
    def sampled(batches):
        for held in _batched(batches):
            for _, codes, prints, _ in held.languages():
                for made, there in _prints(codes, prints, longest):
                    found, count = np.unique(made[there], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(count)], ["print", "f"])

    def marks(batches):
        for batch in batches:
            yield _marks(batch.column("print").to_numpy().view(np.uint64), slots)

    counted = rows.mapInArrow(sampled, "print long, f long").groupBy("print").agg(F.sum("f").alias("f"))
    often = counted.filter(F.col("f") >= lowered).select("print")
    return _bits(often.mapInArrow(marks, "slot long, bits long"), slots)


def _phrases(codes, prints, words, longest, proposed, counted_before) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Phrases of two or more words whose two parts are proposed (but were not both in
    `counted_before`), with their counts. In a further pass what is counted is proposed, too."""
    n_words, texts = len(words), utf8(words)
    parts, anew = None, None
    for size, (made, there) in enumerate(_prints(codes, prints, longest), 1):
        if size > 1:
            new, old = parts
            wanted = there & new[:-1] & new[1:]
            if old is not None:
                wanted &= ~(old[:-1] & old[1:])
            anew = None if old is None else wanted
            at = np.flatnonzero(wanted)
            # Names for the phrases, word after word: exact, unlike fingerprints.
            name, firsts = codes[at], None
            for k in range(1, size):
                key = name * n_words + codes[at + k]
                _, firsts, name, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            if len(at):
                start = at[firsts]
                columns = [texts.take(pa.array(codes[start + k])) for k in range(size)]
                yield pc.binary_join_element_wise(*columns, " "), count
        if size < longest:
            held = there & _held(proposed, made)
            if anew is not None:
                held |= anew
            parts = held, None if counted_before is None else there & _held(counted_before, made)


def _count(rows: DataFrame, longest: int, proposed: np.ndarray, before: np.ndarray | None) -> DataFrame:
    """lang, phrase and f of the proposed phrases and their border; the first pass counts single
    words too, and all words together as the phrase without words."""
    context = rows.sparkSession.sparkContext
    sets = context.broadcast((proposed, before))

    def counted(batches):
        proposed, before = sets.value
        for held in _batched(batches):
            for lang, codes, prints, words in held.languages():
                made = []
                if before is None:
                    count = np.bincount(codes, minlength=len(words))[1:]
                    present = np.flatnonzero(count)
                    made = [(pa.array([""]), np.array([count.sum()])),
                            (utf8(words).take(pa.array(present + 1)), count[present])]
                made += _phrases(codes, prints, words, longest, proposed, before)
                for phrase, count in made:
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(pa.scalar(lang), len(phrase)), phrase, pa.array(count, pa.int64())], ["lang", "phrase", "f"])

    return rows.mapInArrow(counted, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _missed(frequent: DataFrame, longest: int, proposed: np.ndarray) -> np.ndarray:
    """Frequent phrases, short enough to be a part of others, that were not proposed."""
    shared = frequent.sparkSession.sparkContext.broadcast(proposed)

    def marks(batches):
        import xxhash

        for batch in batches:
            prints = []
            for lang, phrase in zip(batch.column("lang").to_pylist(), raw(batch.column("phrase"))):
                seed = xxhash.xxh32_intdigest(lang.encode())
                words = np.array([xxhash.xxh64_intdigest(w, seed) for w in phrase.split(b" ")], np.uint64)
                made = words[:1]
                for k in range(1, len(words)):
                    made = mixed(made, words[k:k + 1])
                prints.append(made)
            prints = np.concatenate([np.zeros(0, np.uint64), *prints])
            yield _marks(prints[~_held(shared.value, prints)], len(shared.value))

    short = frequent.filter((F.col("phrase") != "") & (F.size(F.split("phrase", " ")) < longest))
    return _bits(short.select("lang", "phrase").mapInArrow(marks, "slot long, bits long"), len(proposed))


def frequent_phrases(docs: DataFrame, min_count: int = 30, longest: int = 4, sample: int = SAMPLE,
                     bits: int = BITS, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, phrase and f: every phrase of 1 to `longest` words that occurs `min_count` times in
    its language, counted exactly; the phrase without words has the number of all words."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    lowered = max(2, 4 * min_count // (5 * sample))
    chosen = rows.filter(F.pmod(F.xxhash64("lang", "text", F.monotonically_increasing_id()), F.lit(sample)) == 0)
    proposed = _propose(chosen, longest, lowered, 1 << (bits - 6))

    def counted(proposed: np.ndarray, before: np.ndarray | None) -> DataFrame:
        made = _count(rows, longest, proposed, before)
        return stored(made.filter((F.col("f") >= min_count) | (F.col("phrase") == "")))

    first = counted(proposed, None)
    missed = _missed(first, longest, proposed)
    if not missed.any():
        return first
    # Leaves out what the first pass has counted.
    return first.union(counted(proposed | missed, proposed))


def collocations(docs: DataFrame, min_count: int = 30, longest: int = 4, top: int = 2000, sample: int = SAMPLE,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The first `top` phrases of each language: lang, rank, phrase, a, l, r, n and score."""
    found = frequent_phrases(docs, min_count, longest, sample, lang_col=lang_col, text_col=text_col)
    totals = found.filter(F.col("phrase") == "").select("lang", F.col("f").alias("n"))
    known = found.filter(F.col("phrase") != "")
    words = known.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words")).filter(F.size("words") > 1)

    def part(first, size):
        return F.array_join(F.slice("words", first, size), " ")

    cuts = words.withColumn("cut", F.explode(F.sequence(F.lit(1), F.size("words") - 1))).select(
        "lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("first"),
        part(F.col("cut") + 1, F.size("words") - F.col("cut")).alias("rest"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr("cast((cast(a as decimal(20, 0)) * 2000000) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0))) as long)")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "a", "l", "r")).alias("x")).select("lang", "phrase", "x.*")
    # A part of a phrase is as frequent as the phrase, so looking one word further is enough.
    longer = words.filter(F.size("words") > 2).select("lang", "a", F.explode(F.array(
        part(F.lit(1), F.size("words") - 1), part(F.lit(2), F.size("words") - 1))).alias("phrase"))
    inside = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < 80 * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
