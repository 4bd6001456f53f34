"""Byte-level text helpers that work on whole Arrow batches with numpy.

Words are runs of bytes other than space and TAB..CR (``[^\\x20\\x09-\\x0D]+``);
only A-Z is ever lower-cased, so all of it is exact on UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Text bytes that one numpy step works on; a longer text is one step of its own.
STEP_BYTES = 4 << 20

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x20\x09-\x0D]+"

U = np.uint64
_MULT = 0x9E3779B97F4A7C15          # odd, so it has an inverse modulo 2**64
_GRAM = 0xD6E8FEB86659FD93


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_az(col: Column) -> Column:
    """A-Z lower-cased, every other character as it is; null as empty."""
    return F.translate(F.coalesce(col, F.lit("")), UPPER, UPPER.lower())


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (wraps modulo 2**64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, U)
    if n:
        p[0] = 1
    return np.multiply.accumulate(p)


def steps(batch: pa.RecordBatch, text: str, max_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have at most ``max_bytes`` (or one row)."""
    col = batch.column(batch.schema.get_field_index(text))
    sizes = np.cumsum(_lengths(col))
    start = 0
    while start < batch.num_rows:
        base = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, base + max_bytes, "right")))
        yield batch.slice(start, end - start)
        start = end


def _lengths(col: pa.Array) -> np.ndarray:
    return np.diff(_offsets(col))


def _offsets(col: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    raw = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)
    return raw[col.offset:col.offset + len(col) + 1].astype(np.int64)


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; null counts as empty."""
    if len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    offs = _offsets(col)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BYTE = mix(np.arange(1, 257, dtype=U) * U(_MULT))


class Words:
    """Words of the texts of one column slice.

    ``start``/``end`` are byte positions, ``doc`` the row of each word,
    ``first`` the index of each row's first word (length rows + 1), ``hash`` a
    64-bit hash of the word's bytes.
    """

    def __init__(self, col: pa.Array, fold: bool = False, hashes: bool = True):
        buf, offs = utf8(col)
        if fold:
            buf = _FOLD[buf]
        self.buf, self.offs, self.rows = buf, offs, len(col)
        solid = ~_SPACE[buf]
        prev = np.empty_like(solid)
        prev[1:] = solid[:-1]
        if len(prev):
            prev[0] = False
            prev[offs[:-1][offs[:-1] < len(buf)]] = False
        self.start = np.flatnonzero(solid & ~prev)
        nxt = np.empty_like(solid)
        nxt[:-1] = solid[1:]
        if len(nxt):
            nxt[-1] = False
            ends = offs[1:][(offs[1:] > 0) & (offs[1:] <= len(buf))]
            nxt[ends - 1] = False
        self.end = np.flatnonzero(solid & ~nxt) + 1
        self.first = np.searchsorted(self.start, offs)
        self.doc = np.repeat(np.arange(self.rows), np.diff(self.first))
        self.hash = self._hashes() if hashes else None

    def __len__(self):
        return len(self.start)

    def _hashes(self) -> np.ndarray:
        n = len(self.buf)
        if not n:
            return np.empty(0, U)
        total = np.empty(n + 1, U)
        total[0] = 0
        np.cumsum(_BYTE[self.buf] * _powers(_MULT, n), out=total[1:])
        back = _powers(pow(_MULT, -1, 1 << 64), n)
        h = (total[self.end] - total[self.start]) * back[self.start]
        return mix(h + (self.end - self.start).astype(U))


def grams(words: Words, n: int) -> np.ndarray:
    """Hash of the ``n`` words that start at each word (valid where they are in one row)."""
    h = words.hash
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, U)
    out = np.zeros(m, U)
    f = 1
    for j in range(n):
        out += h[j:j + m] * U(f)
        f = f * _GRAM % (1 << 64)
    return mix(out)


def counted_rows(df: DataFrame) -> Column:
    """Number of words of a text column as SQL (null: 0)."""
    return F.size(F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(f"({WORD})"), 1))
