"""Documents packed into sequences of token ids, by sum of squares.

Method: an open sequence is known by its gap, the tokens that it still lacks. Each document in
turn goes where the sum over gaps of (open sequences with that gap)^2 becomes smallest: into an
open sequence of one of the gaps it fits, or into a new one; the smallest such gap on ties, an
open sequence before a new one. Only counts per gap are needed to choose.

Documents with more tokens than a sequence holds are cut into whole sequences and a rest. Rests
and shorter documents are dealt by hash to groups of about `GROUP`, packed in each group from
the longest to the shortest; what lies in sequences that stayed open is dealt to fewer groups
and packed anew, as long as that at least halves the groups. So no task holds more than a group
(lengths only), no key can be hot, and one group's worth of open sequences remains in the end
unless documents hardly fit together at all.

Defined cases: a null or empty text has the end id alone; equal documents, repeated rows and
null ids are documents each; ties in length are ordered by a number of the row; very long texts
are encoded whole; an empty table gives no pieces; further columns are ignored, whatever their
names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import raw, stored
from tickloom.llm.word_ids import WordIds

CAPACITY = 4096
GROUP = 16_384          # documents packed by one task
TEXTS = 256             # texts encoded at a time

_CODERS: dict[str, WordIds] = {}


def _coder(data: str) -> WordIds:
    """The coder and what it remembers, once per worker."""
    if data not in _CODERS:
        _CODERS.clear()
        _CODERS[data] = WordIds(data)
    return _CODERS[data]


def pieces(docs: DataFrame, tokenizer_file: str, end_id: int, capacity: int = CAPACITY,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, doc_id, piece, start, length and ids (little-endian unsigned 32-bit) of every piece."""
    with open(tokenizer_file, encoding="utf-8") as source:
        shared = docs.sparkSession.sparkContext.broadcast(source.read())
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        coder = _coder(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                some, index, cuts, data = batch.slice(at, TEXTS), [], [], []
                for i, ids in enumerate(coder.encode(raw(some.column("text")))):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start:start + capacity]
                        index.append(i)
                        cuts.append((piece, start, len(part)))
                        data.append(part.tobytes())
                index = pa.array(index, pa.int64())
                numbers = [pa.array(c, pa.int64()) for c in zip(*cuts)] if cuts else [pa.array([], pa.int64())] * 3
                yield pa.RecordBatch.from_arrays(
                    [some.column("row").take(index), some.column("doc_id").take(index), *numbers,
                     pa.array(data, pa.binary())], ["row", "doc_id", "piece", "start", "length", "ids"])

    return rows.mapInArrow(run, f"row long, doc_id {kind}, piece long, start long, length long, ids binary")


def choose(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For lengths in the order of packing (1 to `capacity`): the sequence of each (numbered as
    opened), its offset there, and the gap that each sequence keeps."""
    count = np.zeros(capacity + 1, np.int64)            # open sequences by gap
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    placed, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened, never = 0, np.iinfo(np.int64).max
    for k, size in enumerate(lengths.tolist()):
        # What (count + 1)^2 - count^2 adds at the gap left, and the other way at the gap taken.
        fits = count[size:capacity]                     # gaps size, size + 1, ... below capacity
        gap = 0
        if len(fits):
            change = 2 * (count[:capacity - size] - fits) + 2
            change[0] = 1 - 2 * fits[0]                 # a full sequence has no gap to count
            change[fits == 0] = never
            best = int(change.argmin())
            if change[best] < never and change[best] <= 2 * count[capacity - size] + 1:
                gap = size + best
        if gap:
            number = waiting[gap].pop()
            count[gap] -= 1
        else:
            gap, number, opened = capacity, opened, opened + 1
        placed[k], offset[k] = number, capacity - gap
        if gap > size:
            waiting[gap - size].append(number)
            count[gap - size] += 1
    left = np.zeros(opened, np.int64)
    for gap, numbers in enumerate(waiting):
        left[numbers] = gap
    return placed, offset, left


def _pack(items: DataFrame, groups: int, level: int, capacity: int) -> DataFrame:
    """row, piece, length with sequence_id, offset and whether that sequence is still open."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("row", "ascending"), ("piece", "ascending")])
        placed, offset, left = choose(table.column("length").to_numpy(), capacity)
        base = (level << 56) | (int(table.column("pool")[0].as_py()) << 24)
        return pa.table({"row": table.column("row"), "piece": table.column("piece"), "length": table.column("length"),
                         "sequence_id": pa.array(base + placed), "offset": pa.array(offset),
                         "unfilled": pa.array(left[placed] > 0)})

    # Another deal on every level, so that what was together is spread.
    pool = F.pmod(F.xxhash64("row", "piece", F.lit(level)), F.lit(groups))
    return items.select("row", "piece", "length", pool.alias("pool")).groupBy("pool").applyInArrow(
        run, "row long, piece long, length long, sequence_id long, offset long, unfilled boolean")


def place(made: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """row, piece, sequence_id and offset of every piece of a stored table of pieces."""
    columns = ["row", "piece", "sequence_id", "offset"]
    # Whole sequences need no packing; their numbers are negative, the others' are not.
    result = stored(made.filter(F.col("length") == capacity).select(
        "row", "piece", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    items, level = made.filter(F.col("length") < capacity), 0
    groups = -(-items.count() // group)
    while groups:
        placed = stored(_pack(items, groups, level, capacity))
        still = placed.filter("unfilled")
        fewer = -(-still.count() // group)
        if groups == 1 or 2 * fewer > groups:
            result, groups = result.union(placed.select(*columns)), 0
        else:
            result = result.union(placed.filter("not unfilled").select(*columns))
            items, groups, level = still, fewer, level + 1
    return result


def pack(docs: DataFrame, tokenizer_file: str, end_id: int, capacity: int = CAPACITY, group: int = GROUP,
         id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids, ids_crc32, sequence_id and offset of every piece;
    without `keep_ids` the ids themselves stay where they were stored."""
    made = stored(pieces(docs, tokenizer_file, end_id, capacity, id_col, text_col))
    kept = ["doc_id", "piece", "start", "length", *(["ids"] if keep_ids else []), "ids_crc32"]
    p = made.withColumn("ids_crc32", F.crc32("ids")).select("row", *kept)
    return p.join(place(made, capacity, group), ["row", "piece"]).select(*kept, "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, length, their ids as bytes and the documents in order."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids")))
    ids = F.aggregate("parts", F.lit(b""), lambda seen, x: F.concat(seen, x["ids"]))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate("parts", F.lit(0).cast("long"), lambda n, x: n + x["length"]).alias("length"),
        ids.alias("ids"), F.transform("parts", lambda x: F.struct(x["doc_id"], x["piece"], x["offset"], x["length"])).alias("documents"))
