"""Periodic runs of words, by online dyadic square catching.

Method: words arrive one after the other. For every power of two L, each completed aligned
block of L words becomes a catcher: it waits for its words to come again q words later, where
2 L <= q < 4 L (for L = 1 also q = 1). The first half of any square of period q holds a whole
block of the L that belongs to q, so some catcher meets every square. A word that completes a
window of L words is compared with the two blocks that wait for that window at this moment; a
match is a catch (place, q). Comparing suffixes before it and, as words arrive, words after it
gives the longest stretch with period q; from 2 q words on that is a square, and all squares
that share a stretch merge into one run. Stretches found with several periods have the smallest.

Windows are compared by fingerprints of 64 bits, made for L from those for L / 2. Comparisons of
suffixes go by halving lengths. A run is then compared word by word, and measured anew so if a
fingerprint has misled. A catch that lies in a run whose period divides q is that run again and
is left out. Words are added in groups of any size with the same outcome: all words of a group
are compared at once with array operations, some 2 n comparisons for each L.

A task holds the words of some texts at a time, one text at least.

Defined cases: a null or empty text has no words and no runs; a text of one word repeated is
one run of period 1; overlapping runs of different periods are all returned; equal texts and
repeated rows are searched each; an empty table gives no rows; a null id is kept; further
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import Numbers, mixed, raw

CHARS = 2_000_000           # bytes of text searched at a time


class SquareCatcher:
    """Runs (squares merged) of a growing sequence of word numbers of at least 0.

    `longest` bounds the stretches that can repeat at all (the longest text, where texts follow
    one another); it only saves levels. Negative numbers never equal anything, so they part texts.
    """

    def __init__(self, longest: int | None = None):
        self.words, self.n = np.zeros(0, np.int64), 0
        self.longest = longest
        self.prints: list[np.ndarray] = []              # fingerprints of L = 1, 2, 4, ...
        self.cover = np.zeros(0, np.int64)              # a known run that covers a place, or -1
        self.start, self.stop, self.period = [], [], []
        self.open: dict[tuple[int, int], int] = {}      # (place, q) of catches that may still grow
        self.open_runs: dict[tuple[int, int], int] = {}     # runs that reach the last word

    def append(self, words: np.ndarray) -> None:
        """The next words."""
        words = np.asarray(words, np.int64)
        if not len(words):
            return
        before, self.n = self.n, self.n + len(words)
        self.words = np.concatenate([self.words, words])
        self.cover = np.concatenate([self.cover, np.full(len(words), -1)])
        apart = np.flatnonzero(words < 0) + before
        ones = mixed(words.astype(np.uint64), np.ones(len(words), np.uint64))
        ones[apart - before] = mixed(apart.astype(np.uint64), np.zeros(len(apart), np.uint64))
        self._fingerprints(ones)
        self._grow_runs(before)
        waiting = sorted(self.open)
        self.open = {}
        self._catch(np.array([x for x, _ in waiting], np.int64), np.array([q for _, q in waiting], np.int64))
        for level in range(len(self.prints)):
            self._match(level, before)

    def _fingerprints(self, ones: np.ndarray) -> None:
        if not self.prints:
            self.prints.append(np.zeros(0, np.uint64))
        self.prints[0] = np.concatenate([self.prints[0], ones])
        level, most = 1, self.n if self.longest is None else min(self.n, self.longest)
        while (1 << level) <= most:
            if level == len(self.prints):
                self.prints.append(np.zeros(0, np.uint64))
            half, lower, made = 1 << (level - 1), self.prints[level - 1], self.prints[level]
            have, want = len(made), self.n - 2 * half + 1
            if want > have:
                new = mixed(lower[have:want], lower[have + half:want + half])
                self.prints[level] = np.concatenate([made, new]) if have else new
            level += 1

    def _match(self, level: int, before: int) -> None:
        """Windows completed since `before` words against the blocks that wait for them."""
        size, prints = 1 << level, self.prints[level]
        for steps in (1, 2, 3) if level == 0 else (2, 3):
            first = max(before - size + 1, steps * size, 0)
            if first >= len(prints):
                continue
            low, high = first >> level, (len(prints) - 1) >> level
            blocks = np.repeat(prints[(low - steps) << level:(high - steps + 1) << level:size], size)
            skip = first - (low << level)
            at = np.flatnonzero(prints[first:] == blocks[skip:skip + len(prints) - first]) + first
            if len(at):
                place = ((at >> level) - steps) << level
                self._catch(place, at - place, level)

    def _forward(self, a: np.ndarray, b: np.ndarray, top: int) -> np.ndarray:
        """How many words from b on equal those from a on, up to 2^(top + 1) - 1."""
        done = np.zeros(len(a), np.int64)
        for level in range(min(top, len(self.prints) - 1), -1, -1):
            prints = self.prints[level]
            x, y = a + done, b + done
            inside = y < len(prints)
            same = inside.copy()
            same[inside] = prints[x[inside]] == prints[y[inside]]
            done += same.astype(np.int64) << level
        return done

    def _backward(self, a: np.ndarray, b: np.ndarray, top: int) -> np.ndarray:
        """How many words before b equal those before a."""
        done = np.zeros(len(a), np.int64)
        for level in range(min(top, len(self.prints) - 1), -1, -1):
            prints = self.prints[level]
            x, y = a - done - (1 << level), b - done - (1 << level)
            inside = x >= 0
            same = inside.copy()
            same[inside] = prints[x[inside]] == prints[y[inside]]
            done += same.astype(np.int64) << level
        return done

    def _catch(self, place: np.ndarray, q: np.ndarray, level: int | None = None) -> None:
        """Extend matches (place, place + q); keep runs, and what the end of the words cut off."""
        if len(place) and self.period:
            run = self.cover[place]
            start, stop, period = (np.array(x) for x in (self.start, self.stop, self.period))
            known = (run >= 0) & (start[run] <= place) & (stop[run] > place + q) & (q % period[run] == 0)
            place, q = place[~known], q[~known]
        if not len(place):
            return
        top = len(self.prints) - 1
        if level is not None:
            # Lengths up to 4 L tell whether there is a square.
            near = level + 2
            back, ahead = self._backward(place, place + q, near), self._forward(place, place + q, near)
            worth = (back + ahead >= q) | (place + q + ahead >= self.n)
            place, q = place[worth], q[worth]
        back, ahead = self._backward(place, place + q, top), self._forward(place, place + q, top)
        # Beyond the largest power of two the longest stretch is walked again from its end.
        more = np.flatnonzero(ahead + 1 >= 1 << (top + 1))
        while len(more):
            step = self._forward(place[more] + ahead[more], place[more] + q[more] + ahead[more], top)
            ahead[more] += step
            more = more[step > 0]
        more = np.flatnonzero(back + 1 >= 1 << (top + 1))
        while len(more):
            step = self._backward(place[more] - back[more], place[more] + q[more] - back[more], top)
            back[more] += step
            more = more[step > 0]
        start, stop = place - back, place + q + ahead
        square = stop - start >= 2 * q
        for x, p in zip(place[~square & (stop == self.n)].tolist(), q[~square & (stop == self.n)].tolist()):
            self.open[x, p] = x
        found = np.unique(np.stack([start[square], stop[square], q[square]], 1), axis=0)
        for i, (a, b, p) in enumerate(found.tolist()):
            if i and found[i - 1, 0] == a and found[i - 1, 1] == b:
                continue            # the same stretch with its smaller period came before
            self._run(a, b, p)

    def _run(self, a: int, b: int, p: int) -> None:
        a, b = self._exact(a, b, p)
        if b - a < 2 * p:
            return
        known = self.cover[a]
        if known >= 0 and self.start[known] == a and self.stop[known] == b and p % self.period[known] == 0:
            return
        if b == self.n:
            if (a, p) in self.open_runs:
                return
            self.open_runs[a, p] = len(self.start)
        self.cover[a:b] = len(self.start)
        self.start.append(a)
        self.stop.append(b)
        self.period.append(p)

    def _exact(self, a: int, b: int, p: int) -> tuple[int, int]:
        """The stretch word by word; only a misleading fingerprint changes it."""
        w = self.words
        same = (w[a:b - p] == w[a + p:b]) & (w[a:b - p] >= 0)
        if not same.all():
            # The longest part that holds; parts beyond it have catchers of their own.
            edges = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
            starts, stops = edges[::2], edges[1::2]
            if not len(starts):
                return a, a
            best = int((stops - starts).argmax())
            a, b = a + int(starts[best]), a + int(stops[best]) + p
        return a, b

    def _grow_runs(self, before: int) -> None:
        """Runs that reached the last word go on as long as the new words fit."""
        runs, self.open_runs = self.open_runs, {}
        for (a, p), number in runs.items():
            w = self.words
            differs = np.flatnonzero(w[before:self.n] != w[before - p:self.n - p])
            stop = before + int(differs[0]) if len(differs) else self.n
            self.cover[before:stop] = number
            self.stop[number] = stop
            if stop == self.n:
                self.open_runs[a, p] = number

    def runs(self, min_length: int = 0, min_exponent: int = 2) -> np.ndarray:
        """(start, length, period) of the runs so far, by start and period, each stretch once."""
        found = np.array([self.start, self.stop, self.period], np.int64).reshape(3, -1).T
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        first = np.ones(len(found), bool)
        first[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
        start, stop, period = found[first].T
        length = stop - start
        wanted = (length >= min_length) & (length >= min_exponent * period)
        made = np.stack([start, length, period], 1)[wanted]
        return made[np.lexsort((made[:, 2], made[:, 0]))]


def find_runs(texts: list[np.ndarray], min_length: int, min_exponent: int) -> list[np.ndarray]:
    """The runs of each sequence of word numbers."""
    parted = [x for words in texts for x in (words, np.full(1, -1))]
    catcher = SquareCatcher(max((len(t) for t in texts), default=0))
    catcher.append(np.concatenate([np.zeros(0, np.int64), *parted]))
    found = catcher.runs(min_length, min_exponent)
    starts = np.concatenate([np.zeros(1, np.int64), np.cumsum([len(t) + 1 for t in texts])])
    cuts = np.searchsorted(found[:, 0], starts)
    return [found[a:b] - [s, 0, 0] for a, b, s in zip(cuts, cuts[1:], starts)]


def collapse(words: list, runs: np.ndarray) -> list:
    """The words without those that a run repeats: all of a run after its first period."""
    if not len(runs):
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return list(compress(words, (np.cumsum(edge[:-1]) == 0).tolist()))


def _groups(texts: list[bytes | None]):
    """Ranges of texts that are searched together."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or b"")
        if held >= CHARS:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def periodic_runs(docs: DataFrame, min_length: int = 24, min_exponent: int = 3, id_col: str = "doc_id",
                  text_col: str = "text", order: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """doc_id with `runs`, an array of (start, length, period) in words by start and period, and
    `collapsed`, the words without what runs repeat, joined by one space.

    `order(doc_id, n)` may give, for a text of n words, which of its words stands at each place.
    """
    def work(batches):
        for ids, texts, found in _searched(batches, min_length, min_exponent, order):
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([[dict(zip(("start", "length", "period"), r)) for r in runs.tolist()] for runs in found],
                               pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
                 pa.array([b" ".join(collapse(w, r)) for w, r in zip(texts, found)], pa.binary()).cast(pa.string())],
                ["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        work, f"doc_id {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def _searched(batches, min_length, min_exponent, order):
    """doc_ids, words and runs of some texts at a time."""
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        whole = raw(batch.column("text"))
        for first, last in _groups(whole):
            numbers = Numbers()
            texts, coded = [], []
            for doc_id, text in zip(ids[first:last], whole[first:last]):
                words = (text or b"").split()           # ASCII white space only
                code = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
                at = order(doc_id, len(words)) if order else None
                if at is not None:
                    words, code = [words[i] for i in at.tolist()], code[at]
                texts.append(words)
                coded.append(code)
            yield batch.column("doc_id").slice(first, last - first), texts, find_runs(coded, min_length, min_exponent)


def dealt_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which texts are made periodic, and how, by the crc32 of their id; others stay as they are."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def _highest(runs: list[list[int]]) -> list[int] | None:
    """The run with the greatest length / period; the first one on ties."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def run_digests(docs: DataFrame, min_length: int = 24, min_exponent: int = 3, id_col: str = "doc_id",
                text_col: str = "text", order: Callable[[int | None, int], np.ndarray | None] | None = dealt_order) -> DataFrame:
    """Per document: n_runs, the run of the highest exponent, and digests of runs and kept words.
    What `periodic_runs` returns, with only digests leaving the task."""
    def work(batches):
        for ids, texts, found in _searched(batches, min_length, min_exponent, order):
            rows = []
            for words, runs in zip(texts, found):
                listed = runs.tolist()
                best = _highest(listed)
                text = "".join(f"{s},{n},{p}\n" for s, n, p in listed)
                rows.append((len(listed), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                             hashlib.sha256(text.encode()).hexdigest(),
                             hashlib.sha256(b" ".join(collapse(words, runs))).hexdigest()))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [ids, *[pa.array(c, k) for c, k in zip(zip(*rows), kinds)]],
                ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, "
                                 "runs_sha256 string, collapsed_sha256 string")
