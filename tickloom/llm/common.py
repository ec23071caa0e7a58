"""Shared by the operators: stored steps, raw texts, row keys."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.session import materialize

#: Words are separated by these characters; everything else belongs to a word.
SPACES = r"\x20\x09-\x0D"


def stored(df: DataFrame) -> DataFrame:
    """`df` as a Parquet table in the cluster's shared folder: computed once, no lineage."""
    return materialize(df)


def raw(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a text column."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def utf8(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


class Numbers(dict):
    """Numbers things in the order of their first look-up; `new` holds them until emptied."""

    def __init__(self):
        super().__init__()
        self.new = []

    def __missing__(self, key):
        self[key] = n = len(self)
        self.new.append(key)
        return n

    def taken(self) -> list:
        new, self.new = self.new, []
        return new


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fingerprints of pairs of 64-bit fingerprints, in this order; arrays of one length."""
    x = b * np.uint64(0x9E3779B97F4A7C15)
    x += a
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def unused(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front as long as `df` has such a column."""
    while name in df.columns:
        name = f"_{name}"
    return name


def lowered(column: Column) -> Column:
    """A-Z in lower case; other letters stay as they are."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def row_key(id_col: str, text_col: str) -> list[Column]:
    """What tells rows apart: the id and a hash of the text. Rows equal in both are repeated
    rows and get the same results."""
    return [F.col(id_col).alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_text")]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once per row, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def maybe_among(ids: DataFrame, id_col: str = "id") -> Callable[[str], Column]:
    """A filter that passes the rows whose id is in `ids`, and some others, ahead of a join that
    would shuffle all rows. The ids travel as 2**26 bits (8 MB) however many there are: with
    three millions of them one other id in twenty passes, with very many all do."""
    slots = 1 << 20

    def print_of(c: str) -> Column:
        return F.xxhash64(F.col(c).cast("long"))

    hashed = ids.select(print_of(id_col).alias("h"))
    marks = hashed.groupBy(F.shiftrightunsigned("h", 44).alias("slot")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(h & 63 AS INT))")).alias("bits")).toArrow()
    made = np.zeros(slots, np.uint64)
    made[marks.column("slot").to_numpy()] = marks.column("bits").to_numpy().view(np.uint64)
    sent = ids.sparkSession.sparkContext.broadcast(made)

    @F.pandas_udf("boolean")
    def held(prints: pd.Series) -> pd.Series:
        h = prints.to_numpy().view(np.uint64)
        return pd.Series((sent.value[h >> np.uint64(44)] >> (h & np.uint64(63))) & np.uint64(1) == 1)

    return lambda c: held(print_of(c))


def parted(rows: DataFrame, key: list[Column], wanted: DataFrame, wanted_key: list[Column]) -> tuple[DataFrame, DataFrame]:
    """The rows whose key may be in `wanted`, and those whose key is not: only the former have to
    meet it in a join, which would shuffle all rows. `wanted` (stored, as it is read again) travels
    as up to 2**26 bits in a table of at most 2**20 rows, without Python; the more it holds, the
    more other rows are among the former. Keys are of one type, nulls are values of theirs."""
    slot, bits = unused(rows, "_slot"), unused(rows, "_bits")
    marks = wanted.select(F.xxhash64(*wanted_key).alias("h")).groupBy(F.shiftrightunsigned("h", 44).alias(slot)).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(h & 63 AS INT))")).alias(bits))
    h = F.xxhash64(*key)
    met = rows.withColumn(slot, F.shiftrightunsigned(h, 44)).join(F.broadcast(marks), slot, "left")
    held = F.coalesce(F.getbit(bits, h.bitwiseAND(F.lit(63)).cast("int")) == 1, F.lit(False))
    columns = [F.col(f"`{c}`") for c in rows.columns]
    return met.filter(held).select(*columns), met.filter(~held).select(*columns)
