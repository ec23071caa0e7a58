"""Byte-level BPE encoding and decoding by a local rank file.

Method: the tiktoken library encodes with the given ranks and split pattern. Long texts are
cut first, at places where the pattern cannot match across: before white space that follows
something else, and between letters and digits. No match looks back over such a place, and
`\\s+(?!\\S)` looks ahead only from white space, which never ends a piece; so the pieces' ids,
one after the other, are the ids of the whole text. Decoding joins the ids' bytes.

Tasks hold one text at a time besides the batch; the rank file (about 1 MB) is read by the
driver and broadcast, so workers need no copy of it.

Defined cases: a null or empty text has no ids; other rows keep all their columns, also with
clashing names (the operator's replace them); repeated rows are encoded each.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import unused

PIECE = 100_000             # characters after which the next safe place is taken
SAFE = re.compile(r"(?<=\S)(?=\s)|(?<=[^\W\d_])(?=[0-9])")


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in order, cut at safe places at least `size` characters apart."""
    start = 0
    while len(text) - start > size:
        place = SAFE.search(text, start + size)
        if place is None or place.start() >= len(text):
            break
        yield text[start:place.start()]
        start = place.start()
    yield text[start:] if start else text


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


def encoding(data: bytes, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(data), special_tokens={})


def encode(coder, text: str | None) -> np.ndarray:
    """Ids of one text as unsigned 32-bit integers, little-endian."""
    if not text:
        return np.zeros(0, "<u4")
    if len(text) <= PIECE:
        return np.array(coder.encode_ordinary(text), "<u4")
    return np.concatenate([np.array(coder.encode_ordinary(p), "<u4") for p in pieces(text)])


def decode(table: list[bytes], ids: np.ndarray) -> bytes:
    return b"".join(map(table.__getitem__, ids.tolist()))


_CODERS: dict[tuple[str, str], tuple] = {}


def _coder(data: bytes, pattern: str):
    """The coder and its id table, once per worker."""
    key = (hashlib.sha256(data).hexdigest(), pattern)
    if key not in _CODERS:
        ranks = read_ranks(data)
        table = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        _CODERS[key] = encoding(data, pattern), table
    return _CODERS[key]


def _shared(df: DataFrame, rank_file: str):
    with open(rank_file, "rb") as source:
        return df.sparkSession.sparkContext.broadcast(source.read())


def _schema(df: DataFrame, kept: list[str]) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.select(*kept).schema)


def encode_texts(docs: DataFrame, rank_file: str, pattern: str, text_col: str = "text",
                 keep: list[str] | None = None, check: bool = False) -> DataFrame:
    """The kept columns (default: all) with n_tokens and `ids`: little-endian unsigned 32-bit
    integers as bytes. With `check` an error is raised where decoding does not give the text."""
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("ids", "n_tokens")]
    shared, schema = _shared(docs, rank_file), _schema(docs, kept)
    rows = docs.select(*kept, F.col(text_col).cast("string").alias(unused(docs, "text")))

    def run(batches):
        coder, table = _coder(shared.value, pattern)
        for batch in batches:
            n, data = [], []
            for text in batch.column(len(kept)):
                text = text.as_py()
                ids = encode(coder, text)
                if check and decode(table, ids) != (text or "").encode():
                    raise ValueError("decoded bytes differ from the text")
                n.append(len(ids))
                data.append(ids.tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array(n, pa.int64()), pa.array(data, pa.binary())],
                [*kept, "n_tokens", "ids"])

    return rows.mapInArrow(run, f"{schema}n_tokens long, ids binary")


def decode_ids(encoded: DataFrame, rank_file: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """The other columns with `decoded`: the raw bytes that the ids stand for."""
    kept = [c for c in encoded.columns if c not in (ids_col, "decoded")]
    shared, schema = _shared(encoded, rank_file), _schema(encoded, kept)
    rows = encoded.select(*kept, F.col(ids_col).alias(unused(encoded, "ids")))

    def run(batches):
        _, table = _coder(shared.value, pattern)
        for batch in batches:
            data = [decode(table, np.frombuffer(x.as_py() or b"", "<u4")) for x in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(data, pa.binary())],
                                             [*kept, "decoded"])

    return rows.mapInArrow(run, f"{schema}decoded binary")


def round_trip(docs: DataFrame, rank_file: str, pattern: str, text_col: str = "text",
               keep: list[str] | None = None) -> DataFrame:
    """The kept columns with n_tokens, ids_sha256 and decoded_sha256, in one pass: ids are
    decoded where they were made and only digests leave the task."""
    made = ("n_tokens", "ids_sha256", "decoded_sha256")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in made]
    shared, schema = _shared(docs, rank_file), _schema(docs, kept)
    rows = docs.select(*kept, F.col(text_col).cast("string").alias(unused(docs, "text")))

    def run(batches):
        coder, table = _coder(shared.value, pattern)
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in batch.column(len(kept)):
                ids = encode(coder, text.as_py())
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                text_sha.append(hashlib.sha256(decode(table, ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string())], [*kept, *made])

    return rows.mapInArrow(run, f"{schema}n_tokens long, ids_sha256 string, decoded_sha256 string")
