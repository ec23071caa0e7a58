"""Token ids in compressed binary files, written in ascending order of the documents.

Method: blocks of ids are coded independently by an adaptive context-mixing range coder. An id
is four hexadecimal digits (eight above 65,535); the counts of each digit after no, one and two
preceding ids (order 0 to 2) are mixed with weights that follow how well each order predicted
lately, and the mixed frequencies drive a carry-less range coder in 64-bit integers. Everything
is integer arithmetic, so a block decodes alike on every machine. `write` and `read` code blocks
in the JVM (`IdBlocks.java`), and tokenize there where the tokenizer is a byte-level one
(`byte_level`); else the tokenizers library does. `pack` and `unpack` are the same coder in numpy,
for files without Spark and to test against: one array operation codes a digit of up to LANES blocks.

File: documents (ids and token counts, deflated) and blocks, each with a length and a CRC-32:

    file   := "CMID" version:u16 documents:u32 blocks:u32 size:u32 crc:u32 deflated(doc_id:i64*, valid:u8*, n:u32*) block*
    block  := ids:u32 digits:u16 words:u32 crc:u32 word:u16*          (crc of the ids as u32)

Documents are dealt out by ranges of doc_id; a task sorts, tokenizes and writes its range as
one file, and positions come from the files' counts. Files have names of their own for each
attempt, and only those named by the stored list are read.

Defined cases: a null or empty text is its end id alone; a null id sorts first; repeated rows
are written each; an empty table gives no file and an empty result; further columns are ignored.
"""

from __future__ import annotations

import io
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tickloom.llm import byte_level, jvm
from tickloom.llm.common import stored
from tickloom.session import work_folder

BLOCK = 4096                # ids of a block; every block starts with fresh counts
LANES = 512                 # blocks that are coded in step
SLOTS = 4096                # contexts of an order (hashed)
STEP, LIMIT = 16, 240       # what a seen digit gains; counts above the limit are halved
FILE_CHARS = 8_000_000      # characters of text that a file should hold
TOP, BOTTOM = np.uint64(1 << 48), np.uint64(1 << 32)
HEAD, BLOCK_HEAD = struct.Struct("<4sHIIII"), struct.Struct("<IHII")
WORD = np.uint64(16)


class Mixer:
    """Digit frequencies of order 0 to 2 for every lane, and their mixture."""

    def __init__(self, lanes: int):
        self.lanes = np.arange(lanes)
        self.counts = np.zeros((lanes * 3 * SLOTS, 16), np.uint8)
        self.base = self.lanes * (3 * SLOTS)
        self.trust = np.full((3, lanes), 1 << 14, np.int32)
        self.last = np.zeros((2, lanes), np.int64)

    def mixed(self, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Frequencies of the 16 digits and their running sums."""
        one, two = self.last
        self.places = np.stack((
            self.base + (node & (SLOTS - 1)),
            self.base + SLOTS + ((one * 40_503 + node * 2_971 >> 3) & (SLOTS - 1)),
            self.base + 2 * SLOTS + ((one * 40_503 + two * 30_011 + node * 2_971 >> 3) & (SLOTS - 1))))
        self.rows = self.counts.take(self.places, axis=0)
        weight = (1 + (self.trust >> 14)).astype(np.uint16)[:, :, None]
        mix = self.rows[0] * weight[0]
        mix += self.rows[1] * weight[1]
        mix += self.rows[2] * weight[2]
        mix += 1
        return mix, np.cumsum(mix, axis=1, dtype=np.uint32)

    def learn(self, digit: np.ndarray) -> None:
        seen = self.rows[:, self.lanes, digit].astype(np.int32)
        share = (seen << 16) // (self.rows.sum(axis=2, dtype=np.int32) + 1)
        self.trust += (share - self.trust) >> 5
        grown = seen + STEP
        self.counts[self.places, digit] = grown
        full = self.places[grown > LIMIT]
        if len(full):
            self.counts[full] = self.counts[full] >> 1

    def passed(self, ids: np.ndarray) -> None:
        self.last[1] = self.last[0]
        self.last[0] = ids


def _narrow(low, span):
    """Lanes that have settled their first 16 bits, or are forced to."""
    settled = (low ^ (low + span)) < TOP
    tight = (span < BOTTOM) & ~settled
    if tight.any():
        span[tight] = (np.uint64(0) - low[tight]) & (BOTTOM - np.uint64(1))
    return np.flatnonzero(settled | tight)


def encode_blocks(ids: list[np.ndarray], digits: int) -> list[bytes]:
    """Code blocks in step; `ids` has the longest first."""
    lanes, steps = len(ids), len(ids[0])
    padded = np.zeros((lanes, steps), np.int64)
    for i, block in enumerate(ids):
        padded[i, :len(block)] = block
    out = np.zeros((lanes, 4 * steps + 64), np.uint16)
    at = np.zeros(lanes, np.int64)
    ends = np.zeros(lanes, np.int64)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, np.iinfo(np.uint64).max, np.uint64)
    model, lengths = Mixer(lanes), np.array([len(b) for b in ids])

    def put(which):
        nonlocal out
        if at.max(initial=0) >= out.shape[1] - 8:
            out = np.concatenate((out, np.zeros_like(out)), axis=1)
        out[which, at[which]] = (low[which] >> TOP_SHIFT).astype(np.uint16)
        at[which] += 1
        low[which] <<= WORD

    for t in range(steps):
        now, node = padded[:, t], np.ones(lanes, np.int64)
        for d in range(digits - 1, -1, -1):
            digit = (now >> (4 * d)) & 15
            mix, sums = model.mixed(node)
            part = span // sums[:, -1].astype(np.uint64)
            wide = mix[model.lanes, digit]
            low += part * (sums[model.lanes, digit] - wide).astype(np.uint64)
            span = part * wide.astype(np.uint64)
            while len(which := _narrow(low, span)):
                put(which)
                span[which] <<= WORD
            model.learn(digit)
            node = (node << 4) | digit
        model.passed(now)
        done = np.flatnonzero(lengths == t + 1)
        if len(done):
            for _ in range(4):
                put(done)
            ends[done] = at[done]
    return [out[i, :ends[i]].astype("<u2").tobytes() for i in range(lanes)]


TOP_SHIFT = np.uint64(48)


def decode_blocks(words: list[bytes], lengths: list[int], digits: int) -> list[np.ndarray]:
    lanes, steps = len(words), max(lengths)
    data = np.zeros((lanes, max(map(len, words)) // 2 + 8 + 4 * steps), np.uint64)
    for i, w in enumerate(words):
        data[i, :len(w) // 2] = np.frombuffer(w, "<u2")
    at = np.full(lanes, 4, np.int64)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, np.iinfo(np.uint64).max, np.uint64)
    code = np.zeros(lanes, np.uint64)
    for i in range(4):
        code = (code << WORD) | data[:, i]
    model, out = Mixer(lanes), np.zeros((lanes, steps), np.int64)
    for t in range(steps):
        node = np.ones(lanes, np.int64)
        for _ in range(digits):
            mix, sums = model.mixed(node)
            total = sums[:, -1].astype(np.uint64)
            part = span // total
            value = np.minimum((code - low) // part, total - np.uint64(1)).astype(np.int64)
            digit = (sums <= value[:, None]).sum(axis=1)
            wide = mix[model.lanes, digit]
            low += part * (sums[model.lanes, digit] - wide).astype(np.uint64)
            span = part * wide.astype(np.uint64)
            while len(which := _narrow(low, span)):
                code[which] = (code[which] << WORD) | data[which, np.minimum(at[which], data.shape[1] - 1)]
                at[which] += 1
                low[which] <<= WORD
                span[which] <<= WORD
            model.learn(digit)
            node = (node << 4) | digit
        now = node & ((1 << (4 * digits)) - 1)
        out[:, t] = now
        model.passed(now)
    return [out[i, :n].astype("<u4") for i, n in enumerate(lengths)]


def pack(ids: np.ndarray) -> Iterator[bytes]:
    """Blocks with their headers, in order."""
    for at in range(0, len(ids), BLOCK * LANES):
        some = ids[at:at + BLOCK * LANES]
        blocks = [some[i:i + BLOCK] for i in range(0, len(some), BLOCK)]
        digits = 4 if some.max() < 1 << 16 else 8
        for block, words in zip(blocks, encode_blocks(blocks, digits)):
            yield BLOCK_HEAD.pack(len(block), digits, len(words) // 2, zlib.crc32(block.astype("<u4").tobytes())) + words


def unpack(source, blocks: int) -> Iterator[np.ndarray]:
    """The ids of the blocks that `source` holds, in order; damaged ones raise an error."""
    done = 0
    while done < blocks:
        heads, words = [], []
        while len(heads) < LANES and done < blocks:
            heads.append(BLOCK_HEAD.unpack(source.read(BLOCK_HEAD.size)))
            words.append(source.read(2 * heads[-1][2]))
            done += 1
        for digits in sorted({h[1] for h in heads}):
            if any(h[1] != digits for h in heads):
                raise ValueError("blocks of one group differ in digits")
            for head, ids in zip(heads, decode_blocks(words, [h[0] for h in heads], digits)):
                if zlib.crc32(ids.tobytes()) != head[3]:
                    raise ValueError("a block does not agree with its checksum")
                yield ids


def header(doc_ids: list[int | None], lengths: list[int]) -> bytes:
    """What comes before the blocks."""
    table = zlib.compress(np.array([d or 0 for d in doc_ids], "<i8").tobytes()
                          + np.array([d is not None for d in doc_ids], "u1").tobytes()
                          + np.array(lengths, "<u4").tobytes())
    return HEAD.pack(b"CMID", 1, len(lengths), -(-sum(lengths) // BLOCK), len(table), zlib.crc32(table)) + table


def read_header(source) -> tuple[list[int | None], list[int], int]:
    """doc_id and length of the documents, and the number of blocks that follow."""
    magic, version, documents, blocks, size, crc = HEAD.unpack(source.read(HEAD.size))
    table = source.read(size)
    if (magic, version) != (b"CMID", 1) or zlib.crc32(table) != crc:
        raise ValueError("not a token file, or a damaged one")
    table = zlib.decompress(table)
    valid = np.frombuffer(table, "u1", documents, 8 * documents).tolist()
    doc_ids = [d if ok else None for d, ok in zip(np.frombuffer(table, "<i8", documents).tolist(), valid)]
    return doc_ids, np.frombuffer(table, "<u4", documents, 9 * documents).tolist(), blocks


def split(doc_ids: list[int | None], lengths: list[int], blocks: Iterator) -> Iterator[tuple[int | None, memoryview]]:
    """doc_id and ids, as bytes, of the documents whose blocks of ids come in order."""
    whole, at = memoryview(b""), 0
    for doc_id, n in zip(doc_ids, lengths):
        if len(whole) - at < 4 * n:
            held, have = [whole[at:]], len(whole) - at
            while have < 4 * n:
                held.append(next(blocks))
                have += len(held[-1])
            whole, at = memoryview(b"".join(held)), 0
        yield doc_id, whole[at:at + 4 * n]
        at += 4 * n


def read_file(source) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of the documents, in order, holding one group of blocks at a time."""
    doc_ids, lengths, blocks = read_header(source)
    for doc_id, ids in split(doc_ids, lengths, (ids.tobytes() for ids in unpack(source, blocks))):
        yield doc_id, np.frombuffer(ids, "<u4")


def _tokenizer(data: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_str(data)
    made.encode_special_tokens = True       # their strings in a text are ordinary text
    return made


#: Between the workers and the coder: first what comes before the blocks (documents, and ids of all),
#: without digits and left as it is; then the blocks.
CODED = "documents long, ids long, digits int, crc long, data binary"
LISTED = "part long, file string, documents long, ids long"


def _coded(spark: SparkSession, rows: DataFrame, decode: bool) -> DataFrame:
    """`data` of the rows with digits as words, or as ids again."""
    ids = F.col("ids").cast("int") if decode else F.lit(None).cast("int")
    coder = jvm.function(spark, "IdBlocks")
    return rows.withColumn("data", coder(F.col("data"), F.col("digits"), ids))


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    names, types = zip(*(f.split() for f in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(zip(*rows), types)], list(names))


def _batches(rows: Iterator[tuple], schema: str, size: int = 256) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, size)):
        yield _batch(some, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _blocks(doc_ids: list[int | None], texts: list[bytes]) -> Iterator[tuple]:
    """Rows of CODED for the ids of texts."""
    lengths, ids = [len(t) // 4 for t in texts], np.frombuffer(b"".join(texts), "<u4")
    yield len(lengths), len(ids), 0, 0, header(doc_ids, lengths)
    for at in range(0, len(ids), BLOCK * LANES):
        some = ids[at:at + BLOCK * LANES]
        digits = 4 if some.max() < 1 << 16 else 8
        for i in range(0, len(some), BLOCK):
            data = some[i:i + BLOCK].tobytes()
            yield None, len(data) // 4, digits, zlib.crc32(data), data


def _packed(_, ids: int, digits: int, crc: int, words: bytes) -> bytes:
    return BLOCK_HEAD.pack(ids, digits, len(words) // 2, crc) + words


def write(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Write token files below `folder`; returns the stored list of files in order, with counts."""
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as source:
        data = source.read()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    chars = rows.agg(F.coalesce(F.sum(F.length("text") + 64), F.lit(0))).first()[0]
    files_wanted = max(1, -(-chars // FILE_CHARS))
    dealt = rows.repartitionByRange(files_wanted, "doc_id", F.xxhash64("text")).sortWithinPartitions(
        "doc_id", F.xxhash64("text"))
    tables = byte_level.tables(data, end_id)
    if tables is None:
        shared = spark.sparkContext.broadcast(data)
    else:
        dealt = dealt.select("doc_id", jvm.function(spark, "TextIds", tables)(F.col("text").cast("binary")).alias("ids"))

    ready = tables is not None      # the workers need no tables

    def tokenized(texts: pa.Array) -> list[bytes]:
        if ready:
            return texts.to_pylist()
        coder = _tokenizer(shared.value)
        return [np.array([*x.ids, end_id], "<u4").tobytes() for at in range(0, len(texts), 256)
                for x in coder.encode_batch(texts.slice(at, 256).to_pylist(), add_special_tokens=False)]

    def cut(batches):
        doc_ids, texts = [], []
        for batch in batches:
            doc_ids += batch.column(0).to_pylist()
            texts += tokenized(batch.column(1))
        if texts:
            yield from _batches(_blocks(doc_ids, texts), CODED)

    def put(batches):
        from pyarrow.fs import FileSystem
        from pyspark import TaskContext

        rows = _rows(batches)
        for documents, ids, _, _, before in rows:
            files, base = FileSystem.from_uri(folder)
            name = f"{uuid.uuid4().hex}.cmid"
            with files.open_output_stream(f"{base}/{name}", compression=None) as sink:
                sink.write(before)
                for row in rows:
                    sink.write(_packed(*row))
            yield _batch([(TaskContext.get().partitionId(), name, documents, ids)], LISTED)

    from pyarrow.fs import FileSystem

    files, base = FileSystem.from_uri(folder)
    files.create_dir(base, recursive=True)
    return stored(_coded(spark, dealt.mapInArrow(cut, CODED), False).mapInArrow(put, LISTED))


def _stored_blocks(source, start: int) -> Iterator[tuple]:
    """Rows of `start` and CODED for a file."""
    before = source.read(HEAD.size)
    _, _, documents, blocks, size, _ = HEAD.unpack(before)
    yield start, documents, None, 0, 0, before + source.read(size)
    for _ in range(blocks):
        n, digits, words, crc = BLOCK_HEAD.unpack(source.read(BLOCK_HEAD.size))
        if digits not in (4, 8) or n > BLOCK:
            raise ValueError("not a token file, or a damaged one")
        yield start, None, n, digits, crc, source.read(2 * words)


def _checked(rows: Iterator[tuple], blocks: int) -> Iterator[bytes]:
    for _, _, _, digits, crc, ids in islice(rows, blocks):
        if not digits or zlib.crc32(ids) != crc:
            raise ValueError("a block does not agree with its checksum")
        yield ids


def _documents(rows: Iterator[tuple], digest_only: bool) -> Iterator[tuple]:
    for start, _, _, _, _, before in rows:
        doc_ids, lengths, blocks = read_header(io.BytesIO(before))
        for doc_id, ids in split(doc_ids, lengths, _checked(rows, blocks)):
            yield doc_id, start, len(ids) // 4, zlib.crc32(ids) if digest_only else bytes(ids)
            start += len(ids) // 4


def read(files: DataFrame, folder: str, digest_only: bool = True) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (or the ids as bytes) of every document."""
    # One row per file: their number is the number of writing tasks.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("part", "file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))
    made = f"doc_id long, start long, n_tokens long, {'ids_crc32 long' if digest_only else 'ids binary'}"
    schema = f"start long, {CODED}"

    def get(batches):
        from pyarrow.fs import FileSystem

        disk, base = FileSystem.from_uri(folder)
        for _, name, start in _rows(batches):
            with disk.open_input_stream(f"{base}/{name}", compression=None) as source:
                yield from _batches(_stored_blocks(source, start), schema)

    def join(batches):
        yield from _batches(_documents(_rows(batches), digest_only), made, 1000)

    # In rounds, not by a key: as many tasks as files get one each.
    dealt = placed.repartition(max(1, files.count()))
    return _coded(files.sparkSession, dealt.mapInArrow(get, schema), True).mapInArrow(join, made)


def round_trip(docs: DataFrame, tokenizer_file: str, end_id: int, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Write the documents' ids to files and read them back."""
    folder = f"{work_folder(docs.sparkSession)}/ids"
    return read(write(docs, folder, tokenizer_file, end_id, id_col, text_col), folder)
