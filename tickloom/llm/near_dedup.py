"""Near-duplicate groups of documents by circulant MinHash.

Method: a document is the set of its distinct five-word shingles. One permutation spreads the
shingles over a ring of 2**32 places; a second one, turned by 0, 1, 2, ... places, gives all
signature coordinates by its minimum over the set. The first coordinates are cut into bands;
documents that share a band are candidates, and every link is confirmed on the full sets
(Jaccard of at least `percent` %). With 32 bands of 3 a pair at 75 % is missed with probability
2.4e-8. Two bits of all 256 coordinates give an estimate that leaves out candidates five
standard deviations below `percent` (a pair at 75 % is left out with probability 3e-7).

A group of copies does not cause all its pairs:

1. Documents with equal sets are one node (their smallest id).
2. In every band, and in every two and three neighbouring bands together (whose members are
   more alike), the members are confirmed against one leader only.
3. Links are contracted to components. Of a band that still holds several components, members
   outside its largest one are compared with all others in the band that lie in another
   component, by samples of their sets (whole ones up to 255 shingles) where they meet, and
   confirmed if the samples allow. So every candidate pair is confirmed, already joined, or
   left out by an estimate.

A node's texts travel to its leader in parts of bounded size, so a leader with very many
members is many tasks. Texts, samples and bands that no pair asks for stay where they are, by a
filter of bounded size. Nothing else is collected on the driver but counts.

Defined cases: a document without words (or with a null text) has no shingles and is linked
with nothing; with fewer than five words the whole sequence is its one shingle; a null id has
no component and is kept; repeated rows of an id are one node and all name it; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import maybe_among, raw, stored

WORDS = 5                   # words of a shingle
ROWS, BANDS = 3, 32         # coordinates of a band, bands
COORDINATES = 256           # all coordinates; a multiple of 64
SAMPLE = 256                # smallest shingle hashes kept as a sample; below that, the whole set
DEVIATIONS = 5              # how far below `percent` an estimate may lie
CACHED_WORDS = 500_000      # word hashes that a task keeps
PART_SHINGLES = 400_000     # shingles that are compared with one leader in one part
CHUNK = 1 << 16             # shingles that are hashed together, to stay in the cache

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                 0x85EBCA77C2B2AE63], np.uint64)


def _mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class _Hashes(dict):
    def __missing__(self, word):
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: bytes | None, hashes: dict[bytes, int]) -> np.ndarray:
    """The sorted distinct shingles of a text, as 64-bit hashes."""
    words = (text or b"").lower().split()
    if len(hashes) > CACHED_WORDS:
        hashes.clear()
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if len(w) < WORDS:
        if not len(w):
            return w
        return _mix64((w * _ODD[:len(w)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(w)))
    n = len(w) - WORDS + 1
    total = w[:n] * _ODD[0]
    for i in range(1, WORDS):
        total += w[i:i + n] * _ODD[i]
    return np.unique(_mix64(total))


def signatures(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """Circulant MinHash of non-empty sets: (sets x coordinates) unsigned 32-bit integers."""
    out = np.empty((len(sets), coordinates), np.uint32)
    first = 0
    while first < len(sets):
        last, size = first, 0
        while last < len(sets) and (last == first or size + len(sets[last]) <= CHUNK):
            size += len(sets[last])
            last += 1
        some = sets[first:last]
        starts = np.cumsum([0, *map(len, some[:-1])])
        # The first permutation: a shingle's place on the ring.
        place = (_mix64(np.concatenate(some) ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)
        x, y = np.empty_like(place), np.empty_like(place)
        for k in range(coordinates):
            # The second permutation, turned by k places (sums wrap around the ring).
            np.add(place, np.uint32(k), out=x)
            for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
                np.right_shift(x, np.uint32(shift), out=y)
                np.bitwise_xor(x, y, out=x)
                if factor > 1:
                    np.multiply(x, np.uint32(factor), out=x)
            out[first:last, k] = np.minimum.reduceat(x, starts)
        first = last
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    parts = signature[:, :ROWS * BANDS].reshape(len(signature), BANDS, ROWS).astype(np.uint64)
    keys = np.arange(parts.shape[1], dtype=np.uint64)[None, :] * _ODD[4]
    for i in range(ROWS):
        keys = _mix64(keys + parts[:, :, i] * _ODD[i] + np.uint64(1))
    return keys.view(np.int64)


def bits(signature: np.ndarray) -> np.ndarray:
    """The two lowest bits of every coordinate: the first ones packed in 64-bit integers, then the second ones."""
    planes = [np.packbits((signature >> np.uint32(i)) & np.uint32(1), axis=1) for i in (0, 1)]
    return np.concatenate(planes, axis=1).view(np.int64)


def alike(x: Column, y: Column, percent: int) -> Column:
    """Whether the estimate from two rows' bits does not rule out `percent` %."""
    half = COORDINATES // 64
    differ = None
    for i in range(half):
        n = F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i))).bitwiseOR(
            F.get(x, F.lit(i + half)).bitwiseXOR(F.get(y, F.lit(i + half)))))
        differ = n if differ is None else differ + n
    # Unequal coordinates have equal bits in one of four cases.
    share = percent / 100 + (1 - percent / 100) / 4
    least = COORDINATES * share - DEVIATIONS * (COORDINATES * share * (1 - share)) ** 0.5
    return F.lit(COORDINATES) - differ >= least


def sample(shingle: np.ndarray) -> np.ndarray:
    """The SAMPLE smallest of the shingles' 32-bit hashes, in order."""
    return np.unique((_mix64(shingle) >> np.uint64(32)).astype(np.uint32).view(np.int32))[:SAMPLE]


def overlap(x: Column, y: Column, percent: int) -> Column:
    """Whether two samples do not rule out `percent` %. Whole sets are compared as they are, but
    for one shingle that may share its hash with another; else the smallest hashes of both
    together are a random part of the union."""
    both, union = F.array_intersect(x, y), F.sort_array(F.array_union(x, y))
    share = percent / 100
    least = SAMPLE * share - DEVIATIONS * (SAMPLE * share * (1 - share)) ** 0.5
    return F.when((F.size(x) < SAMPLE) & (F.size(y) < SAMPLE), 100 * F.size(both) >= percent * F.size(union) - 100).otherwise(
        F.size(F.array_intersect(both, F.slice(union, 1, SAMPLE))) >= least)


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, digest of the set (null if empty), band keys, bits and sample of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        hashes = _Hashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                sets = [shingles(t, hashes) for t in raw(some.column(1))]
                full = [s for s in sets if len(s)]
                made = signatures(full) if full else np.zeros((0, COORDINATES), np.uint32)
                there = np.array([len(s) > 0 for s in sets])

                def lists(values: np.ndarray) -> pa.Array:
                    offsets = np.concatenate(([0], np.cumsum(there * values.shape[1]))).astype(np.int32)
                    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1)))

                yield pa.RecordBatch.from_arrays([
                    some.column(0), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                              for s in sets], pa.binary()), lists(bands(made)), lists(bits(made)),
                    pa.array([sample(s) for s in sets], pa.list_(pa.int32()))],
                    ["doc_id", "n_shingles", "digest", "bands", "bits", "sample"])
            batch = some = None     # what the batch took goes back to the system
            pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, "doc_id long, n_shingles long, digest binary, bands array<long>, bits array<long>, "
                                "sample array<int>")


def confirm(pairs: DataFrame, docs: DataFrame, sizes: DataFrame, percent: int, id_col: str,
            text_col: str) -> DataFrame:
    """Pairs (a, b) whose full sets agree in at least `percent` %. `sizes`: id, n_shingles."""
    sized = pairs.join(sizes.select(F.col("id").alias("b"), "n_shingles"), "b")
    parts = sized.groupBy("a").agg(F.ceil(F.sum("n_shingles") / PART_SHINGLES).cast("int").alias("parts"))
    members = sized.join(parts, "a").select(
        "a", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"), F.col("b").alias("id"), F.lit(1).alias("role"))
    leaders = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                           F.col("a").alias("id"), F.lit(0).alias("role"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    wanted = members.unionByName(leaders)
    asked = maybe_among(pairs.select(F.explode(F.array("a", "b")).alias("id")))
    # Repeated rows of an id only repeat its comparisons.
    dealt = wanted.join(texts.filter(asked("id")), "id").repartition("a", "part").sortWithinPartitions("a", "part", "role", "id")

    def run(batches):
        hashes, leader, own = _Hashes(), None, None
        for batch in batches:
            a, b = [], []
            columns = [batch.column(c).to_pylist() for c in ("a", "part", "id", "role")]
            for x, part, y, role, text in zip(*columns, raw(batch.column("text"))):
                if role == 0:
                    if leader != (x, part):
                        leader, own = (x, part), shingles(text, hashes)
                    continue
                if leader != (x, part):
                    continue
                other = shingles(text, hashes)
                both = len(np.intersect1d(own, other, assume_unique=True))
                if 100 * both >= percent * (len(own) + len(other) - both):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
            batch = columns = text = None
            pa.default_memory_pool().release_unused()

    return dealt.select("a", "part", "id", "role", "text").mapInArrow(run, "a long, b long").distinct()


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """id and component (its smallest id) of all ids in `links` (a, b), by star contraction."""
    def both(e: DataFrame) -> DataFrame:
        return e.union(e.select("b", "a"))

    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct())
    last = None
    for _ in range(rounds):
        # Larger neighbours move to the smallest one of a node, then a node's smaller ones do.
        around = both(edges)
        smallest = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = around.filter("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter(
            "a > b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").union(
            least.select("a", F.col("m").alias("b"))).distinct()
        edges = stored(small)
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == last:
            break
        last = state
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def _near(n: Column, m: Column, percent: int) -> Column:
    """Whether sets of these sizes can agree in `percent` %."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    rows = stored(sketch(docs, id_col, text_col))
    known = rows.filter("digest is not null and doc_id is not null")
    firsts = known.groupBy("digest").agg(F.min("doc_id").alias("first"))
    nodes = stored(known.join(firsts.withColumnRenamed("first", "doc_id"), ["digest", "doc_id"]).select(
        F.col("doc_id").alias("id"), "n_shingles", "bands", "bits").dropDuplicates(["id"]))
    sizes = nodes.select("id", "n_shingles")
    nodes_of = {side: nodes.select(F.col("id").alias(side), F.col("n_shingles").alias(f"n_{side}"),
                                   F.col("bits").alias(f"bits_{side}")) for side in ("a", "b")}

    def possible(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sizes and bits do not rule them out."""
        both = pairs.join(nodes_of["b"], "b").join(nodes_of["a"], "a")
        return both.filter(_near(F.col("n_a"), F.col("n_b"), percent)
                           & alike(F.col("bits_a"), F.col("bits_b"), percent)).select("a", "b")

    # Bands with several members.
    keyed = nodes.select("id", F.explode("bands").alias("band"))
    leaders = keyed.groupBy("band").agg(F.min("id").alias("leader"), F.count("*").alias("n")).filter("n > 1")
    members = stored(keyed.join(leaders.select("band", "leader"), "band"))
    stars = members.select(F.col("leader").alias("a"), F.col("id").alias("b"))
    shared = nodes.select("id", "bands").join(members.select("id").distinct(), "id")
    for width in (2, 3):
        several = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(
            i, *[F.get("bands", F.pmod(i + j, F.lit(BANDS))) for j in range(width)]))
        deep = shared.select("id", F.explode(several).alias("band"))
        first = deep.groupBy("band").agg(F.min_by("id", F.xxhash64("id", F.lit(width))).alias("leader"),
                                         F.count("*").alias("n")).filter("n > 1").drop("n")
        stars = stars.union(deep.join(first, "band").select(F.least("leader", "id"), F.greatest("leader", "id")))
    stars = stored(possible(stars.filter("a <> b").distinct()))
    links = stored(confirm(stars, docs, sizes, percent, id_col, text_col))
    placed = components(links)

    # Bands whose members are not in one component yet; the rows outside the largest component
    # meet all rows of the band.
    located = members.join(placed, "id", "left").select("band", "id", F.coalesce("component", "id").alias("component"))
    held = located.groupBy("band", "component").agg(F.count("*").alias("n"))
    mixed = held.groupBy("band").agg(F.max_by("component", F.struct("n", "component")).alias("largest"),
                                     F.count("*").alias("parts")).filter("parts > 1").drop("parts")
    unsettled = stored(located.join(mixed, "band"))
    asked = maybe_among(unsettled)
    samples = rows.select(F.col("doc_id").alias("id"), "sample").filter(asked("id")).join(
        unsettled.select("id").distinct(), "id").dropDuplicates(["id"])
    known_of = stored(samples.join(nodes.filter(asked("id")), "id"))
    open_ = unsettled.join(known_of, "id")
    few, all_ = open_.filter("component <> largest").alias("x"), open_.alias("y")
    # A pair that shares several bands comes out of the first of them.
    first_band = F.get(F.col("x.bands"), F.array_position(F.zip_with(
        "x.bands", "y.bands", lambda p, q: p == q), True).cast("int") - 1)
    met = few.join(all_, (F.col("x.band") == F.col("y.band")) & (F.col("x.component") != F.col("y.component"))
                   & ((F.col("x.id") < F.col("y.id")) | (F.col("y.component") == F.col("y.largest")))
                   & _near(F.col("x.n_shingles"), F.col("y.n_shingles"), percent)
                   & alike(F.col("x.bits"), F.col("y.bits"), percent) & (first_band == F.col("x.band"))
                   & overlap(F.col("x.sample"), F.col("y.sample"), percent))
    rest = stored(met.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct().join(
        stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"))
    if not rest.isEmpty():
        more = stored(confirm(rest, docs, sizes, percent, id_col, text_col))
        if not more.isEmpty():
            placed = components(links.union(more))

    # Rows meet a table with one row per set, and those without words none.
    named = firsts.join(placed.withColumnRenamed("id", "first"), "first", "left")
    wordless = rows.filter("digest is null").select("*", *[F.lit(None).cast("long").alias(c) for c in ("first", "component")])
    result = rows.filter("digest is not null").join(named, "digest", "left").unionByName(wordless)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "first", "doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
