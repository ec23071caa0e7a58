import collections
import random

import numpy as np

from tickloom.llm import near_dedup as nd


def sets_of(rows):
    made = {}
    for doc_id, text in rows:
        w = (text or "").encode().lower().split()
        made[doc_id] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    return made


def brute_force(rows):
    """Component of every document, by comparing all that share a shingle."""
    sets, up, index = sets_of(rows), {}, collections.defaultdict(list)
    up = {k: k for k in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, own in sets.items():
        common = collections.Counter(o for g in own for o in index[g])
        for g in own:
            index[g].append(k)
        for o, n in common.items():
            if 100 * n >= 75 * (len(own) + len(sets[o]) - n):
                a, b = top(k), top(o)
                up[max(a, b)] = min(a, b)
    return {k: top(k) for k in sets}, {k: len(v) for k, v in sets.items()}


def families():
    """Chains of edits (ends unlike each other), copies, shared passages and short texts."""
    rng, rows = random.Random(3), []
    vocabulary = [f"w{i}" for i in range(500)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    for family in range(12):
        words = [rng.choice(vocabulary) for _ in range(120)]
        for step in range(15):
            rows.append((len(rows), " ".join(words)))
            at = rng.randrange(len(words))
            words = [*words[:at], rng.choice(vocabulary), *words[at + 1:]]
            if step % 4 == 0:
                rows.append((len(rows), rows[-1][1].upper()))
    for _ in range(40):
        rows.append((len(rows), " ".join([*passage, *[rng.choice(vocabulary) for _ in range(rng.randrange(5, 60))]])))
    return rows + [(len(rows) + i, t) for i, t in enumerate(["a", "A", "a b", "b a", "a b c d", "a b c d e", "", None])]


def test_equals_brute_force(spark):
    rows = families()
    components, sizes = brute_force(rows)
    found = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == components
    assert {r["doc_id"]: r["n_shingles"] for r in found} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[500:2500])
    one, two = nd.signatures([a, b], 2048)
    assert abs((one == two).mean() - 1500 / 2500) < 0.05
    assert (nd.signatures([a], 64)[0] == nd.signatures([b, a], 64)[1]).all()


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200), (200, 150)], "a long, b long")
    found = {r["id"]: r["component"] for r in nd.components(links).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 150: 100, 200: 100}


def test_odd_rows(odd, nothing):
    rows = nd.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[2]["component_id"] == 1 and not by_id[2]["kept"]
    assert by_id[3]["n_shingles"] == by_id[4]["n_shingles"] == 0 and by_id[3]["component_id"] == 3
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    assert sum(r["doc_id"] == 1 and r["kept"] for r in rows) == 2
    assert nd.near_duplicates(nothing).collect() == []
