"""Exact forward and backward recursions over many sequences at once.

Sequences of a batch advance in step, longest first, so that one array operation serves all
of them. Groups of sequences are limited in length, and a long group keeps the forward values
of one segment at a time (the others are computed again from the segment's first value), so
memory does not grow with the length of a text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

GROUP = 300_000         # positions that advance together
SEGMENT = 300_000       # positions whose forward values are kept


def groups(lengths: np.ndarray, size: int = GROUP) -> Iterator[np.ndarray]:
    """Indices of sequences with at least one position, longest first, in bounded groups."""
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    total, start = 0, 0
    for i, length in enumerate(lengths[order]):
        if total and total + length > size:
            yield order[start:i]
            total, start = 0, i
        total += length
    if start < len(order):
        yield order[start:]


class Layout:
    """Positions of a group by step: step t holds the first counts[t] sequences."""

    def __init__(self, offsets: np.ndarray, lengths: np.ndarray):
        self.steps = int(lengths[0])
        self.counts = np.searchsorted(-lengths, -np.arange(self.steps), side="left")
        self.starts = np.concatenate(([0], np.cumsum(self.counts)))
        self.offsets = offsets

    def positions(self, t0: int, t1: int) -> tuple[np.ndarray, np.ndarray]:
        """Of steps t0 to t1: position in the batch, and which sequence it belongs to."""
        counts = self.counts[t0:t1]
        step = np.repeat(np.arange(t0, t1), counts)
        sequence = np.arange(len(step)) - np.repeat(self.starts[t0:t1] - self.starts[t0], counts)
        return self.offsets[sequence] + step, sequence


def _forward(emit, counts, trans, first, before):
    """Scaled forward values and scales; `before` is the value at the step before, or None."""
    values, scales = np.empty_like(emit), np.empty((len(emit), 1), emit.dtype)
    ones, at = np.ones((emit.shape[1], 1), emit.dtype), 0
    for n in counts.tolist():
        now = values[at:at + n]
        np.multiply(first if before is None else before[:n] @ trans, emit[at:at + n], out=now)
        now /= np.matmul(now, ones, out=scales[at:at + n])
        before, at = now, at + n
    return values, scales, before.copy()


def segments(layout: Layout, size: int = SEGMENT) -> list[tuple[int, int]]:
    cuts, t0 = [], 0
    while t0 < layout.steps:
        t1 = int(np.searchsorted(layout.starts, layout.starts[t0] + size, side="right")) - 1
        t1 = min(max(t1, t0 + 1), layout.steps)
        cuts.append((t0, t1))
        t0 = t1
    return cuts


def likelihoods(lengths: np.ndarray, emission: Callable[[np.ndarray], np.ndarray],
                first: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Natural log of each sequence's likelihood, by the scaled forward recursion.

    `emission(positions)` gives the emission values (positions x states) of batch positions.
    """
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    result = np.zeros(len(lengths))
    for chosen in groups(lengths):
        layout, before = Layout(offsets[chosen], lengths[chosen]), None
        for t0, t1 in segments(layout):
            at, sequence = layout.positions(t0, t1)
            _, scales, before = _forward(emission(at), layout.counts[t0:t1], trans, first, before)
            result[chosen] += np.bincount(sequence, np.log(scales[:, 0]), minlength=len(chosen))
    return result


def posteriors(lengths: np.ndarray, emission: Callable[[np.ndarray], np.ndarray],
               first: np.ndarray, trans: np.ndarray):
    """Forward-backward. Yields (positions, sequences, gamma, moves, log likelihoods).

    gamma: state probabilities of the positions; moves: expected transitions of the segment
    (states x states); sequences: which sequence a position belongs to; the likelihoods come
    with the first segment of a group and are None in the others.
    """
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    for chosen in groups(lengths):
        layout = Layout(offsets[chosen], lengths[chosen])
        cuts, entries, before = segments(layout), [], None
        logs = np.zeros(len(chosen))
        for t0, t1 in cuts:
            entries.append(before)
            at, sequence = layout.positions(t0, t1)
            emit = emission(at)
            values, scales, before = _forward(emit, layout.counts[t0:t1], trans, first, before)
            logs += np.bincount(sequence, np.log(scales[:, 0]), minlength=len(chosen))
        found = np.zeros(len(lengths))
        found[chosen] = logs
        later = np.ones((len(chosen), len(first)), trans.dtype)
        after = None        # emission over scale of the step after this segment
        for (t0, t1), entry in zip(reversed(cuts), reversed(entries)):
            if t1 != layout.steps:
                at, sequence = layout.positions(t0, t1)
                emit = emission(at)
                values, scales, _ = _forward(emit, layout.counts[t0:t1], trans, first, entry)
            ratio = emit / scales
            moves = np.zeros(trans.shape)
            base = layout.starts[t0]
            for t in range(t1 - 1, t0 - 1, -1):
                a, n = layout.starts[t] - base, layout.counts[t]
                if t + 1 < layout.steps:
                    m = layout.counts[t + 1]
                    coming = (ratio[a + n:a + n + m] if t + 1 < t1 else after) * later[:m]
                    moves += values[a:a + m].T @ coming
                    later[:m] = coming @ trans.T
                values[a:a + n] *= later[:n]
            after = ratio[:layout.counts[t0]]
            yield at, chosen[sequence], values, moves * trans, found
            found = None
