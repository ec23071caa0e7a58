import collections
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import chains, hmm
from tickloom.llm.queries import QUERIES, fold


def test_recursions_equal_sums_over_all_paths(monkeypatch):
    rng = np.random.default_rng(1)
    k, size = 3, 5
    first, trans, emit = rng.random(k), rng.random((k, k)), rng.random((size, k))
    sequences = [rng.integers(0, size, n) for n in (0, 1, 4, 6, 2, 6)]
    lengths, flat = np.array([len(s) for s in sequences]), np.concatenate(sequences)

    def paths(seq):
        total, gamma, moves = 0.0, np.zeros((len(seq), k)), np.zeros((k, k))
        for path in itertools.product(range(k), repeat=len(seq)):
            p = first[path[0]] * emit[seq[0], path[0]]
            for t in range(1, len(seq)):
                p *= trans[path[t - 1], path[t]] * emit[seq[t], path[t]]
            total += p
            for t, s in enumerate(path):
                gamma[t, s] += p
            for a, b in zip(path, path[1:]):
                moves[a, b] += p
        return total, gamma / total, moves / total

    for segment in (10**6, 3):      # in one piece, and with segments computed again
        monkeypatch.setattr(chains.segments, "__defaults__", (segment,))
        logs = chains.likelihoods(lengths, lambda p: emit[flat[p]], first, trans)
        gammas, moves = np.zeros((len(flat), k)), np.zeros((k, k))
        for at, _, gamma, expected, _ in chains.posteriors(lengths, lambda p: emit[flat[p]], first, trans):
            gammas[at] += gamma
            moves += expected
        offsets, wanted = np.concatenate(([0], np.cumsum(lengths))), np.zeros((k, k))
        for i, seq in enumerate(sequences):
            if len(seq):
                total, gamma, steps = paths(seq)
                assert math.isclose(logs[i], math.log(total), rel_tol=1e-12)
                np.testing.assert_allclose(gammas[offsets[i]:offsets[i + 1]], gamma, rtol=1e-9)
                wanted += steps
            else:
                assert logs[i] == 0
        np.testing.assert_allclose(moves, wanted, rtol=1e-9)


def test_counts_and_base_score(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: (r["text"].encode().lower().split(), r["t"])
             for r in docs.select("doc_id", "text", (fold(7) != 2).alias("t")).collect()}
    counts = collections.Counter(w for words, train in texts.values() if train for w in [*words, None])
    n, v = sum(counts.values()), len(counts)
    rows = QUERIES["op1_hidden_markov_score"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words, train = texts[r["doc_id"]]
        tokens = [*words, None]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (not train, len(tokens), n)
        assert r["n_known"] == sum(counts[w] > 0 for w in tokens)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens), rel_tol=1e-9)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_probabilities_add_up_to_one(spark):
    """Over all texts of up to two words, with every word outside the corpus as one kind."""
    words = ["aa", "bb", "ca", "da"]
    texts = ["aa bb", "bb", "aa aa ca", "da"]
    every = [" ".join(w) for n in range(3) for w in itertools.product([*words, "xxxa", "yyyb"], repeat=n)]
    docs = spark.createDataFrame([*[(i, t, True) for i, t in enumerate(texts)],
                                  *[(100 + i, t, False) for i, t in enumerate(every)]], "doc_id long, text string, t boolean")
    rows = hmm.score_documents(docs, F.col("t"), states=2, iterations=3, top_words=2, classes=2).filter("doc_id >= 100").collect()
    score = {every[r["doc_id"] - 100]: 10 ** r["score"] for r in rows}
    assert sum(score.values()) <= 1 + 1e-9
    # Without its end token a text is as likely as all its continuations.
    assert score[""] > 0 and all(p > 0 for p in score.values())


def test_training_helps(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    encoded, counts, _ = hmm.encode(docs, "doc_id", "text", F.lit(True), 2000, 64)
    totals = []
    for rounds in (1, 3):
        first, trans, emit = hmm.train(encoded, counts, 4, rounds)
        lengths, symbols = hmm._sequences(encoded.select("symbols").toArrow().column(0).combine_chunks(), len(counts))
        totals.append(chains.likelihoods(lengths, lambda p: emit[symbols[p]], first, trans).sum())
    assert totals[1] > totals[0]


def test_odd_rows(spark, odd, nothing):
    rows = hmm.score_documents(odd, F.col("doc_id") > 0, states=2, iterations=1).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[3]["n_tokens"] == by_id[4]["n_tokens"] == 1 and by_id[5]["n_tokens"] == 90_001
    assert by_id[None]["training"] is False
    twice = [r["score"] for r in rows if r["doc_id"] == 1]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert hmm.score_documents(nothing, F.lit(True)).collect() == []
    untrained = hmm.score_documents(odd, F.lit(False), states=2, iterations=1).collect()
    assert {r["train_tokens"] for r in untrained} == {0} and all(np.isfinite(r["score"]) for r in untrained)


@pytest.mark.parametrize("sizes", [[], [0, 0], [3, 0, 5]])
def test_groups_hold_every_sequence_once(sizes):
    found = [int(i) for g in chains.groups(np.array(sizes, np.int64), 4) for i in g]
    assert sorted(found) == [i for i, n in enumerate(sizes) if n]
