"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs: its lines, and long lines further after words
that their own hash selects (about every ``PIECE_WORDS``-th), so an edit moves
no other cut. Each paragraph's digest (the n-th repetition of one counts as a
digest of its own) goes into three cells of the sketch; a cell keeps a count,
the xor of its digests and the xor of their checks. The fingerprint is the
sketch of ``CELLS`` cells in base64: a function of the text alone.

Two versions are compared by subtracting cells and peeling: a cell that holds
one digest gives it up, which empties its other cells. If that gets stuck, both
versions are sketched again in four times the cells, until the difference comes
out whole. All pairs of a batch are peeled together with numpy.

Likeness is shared digests over all digests of both (1 for two texts without
any). Null counts as empty. Rows are independent; an empty table gives no rows.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from eventide.llm.passages import range_hash
from eventide.llm.shared import ship
from eventide.llm.textops import U, Words, mix, steps

CELLS = 24
PIECE_WORDS = 8
HASHES = 3
_PIECE = 0x27D4EB2F165667C5
_AGAIN = 0x9FB21C651E98DF25


def digests(col: pa.Array, piece_words: int = PIECE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """``(row, digest)`` of the paragraphs of a column, sorted by both; no two alike."""
    w = Words(col)
    n = len(w)
    if not n:
        return np.empty(0, np.int64), np.empty(0, U)
    lines = np.concatenate([[0], np.cumsum(w.buf == 0x0A)])
    last = np.ones(n, bool)
    last[:-1] = (w.doc[1:] != w.doc[:-1]) | (lines[w.start[1:]] > lines[w.end[:-1]]) | (w.hash[:-1] % U(piece_words) == 0)
    end = np.flatnonzero(last) + 1
    start = np.concatenate([[0], end[:-1]])
    row, d = w.doc[start], range_hash(w.hash, start, end, _PIECE)
    order = np.lexsort((d, row))
    row, d = row[order], d[order]
    new = np.ones(len(d), bool)
    new[1:] = (row[1:] != row[:-1]) | (d[1:] != d[:-1])
    first = np.flatnonzero(new)
    repeat = np.arange(len(d)) - np.repeat(first, np.diff(np.append(first, len(d))))
    d = np.where(repeat == 0, d, mix(d + repeat.astype(U) * U(_AGAIN)))
    return row, d


def _check(d: np.ndarray) -> np.ndarray:
    return (mix(d ^ U(_PIECE)) >> U(32)).astype(np.uint32)


def _cells(row: np.ndarray, d: np.ndarray, cells: int) -> np.ndarray:
    """The cells of each digest, one in each third of its row's sketch."""
    third = cells // HASHES
    salt = U(cells)
    return np.stack([row * cells + j * third + (mix(d + salt * U(2 * j + 1)) % U(third)).astype(np.int64) for j in range(HASHES)])


class Sketches:
    """Sketches of ``rows`` texts side by side."""

    def __init__(self, rows: int, cells: int):
        self.cells, self.rows = cells, rows
        self.count = np.zeros(rows * cells, np.int32)
        self.key = np.zeros(rows * cells, U)
        self.check = np.zeros(rows * cells, np.uint32)

    def add(self, row: np.ndarray, d: np.ndarray, sign) -> None:
        c = _check(d)
        for at in _cells(row, d, self.cells):
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.key, at, d)
            np.bitwise_xor.at(self.check, at, c)

    def strings(self) -> list[str]:
        cell = np.zeros(len(self.count), [("n", "<i4"), ("key", "<u8"), ("check", "<u4")])
        cell["n"], cell["key"], cell["check"] = self.count, self.key, self.check
        raw, width = cell.tobytes(), 16 * self.cells
        return [base64.b64encode(raw[i * width:(i + 1) * width]).decode() for i in range(self.rows)]

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(row, digest, sign)`` of what comes out, and whether each row came out whole."""
        rows, keys, signs = [], [], []
        at = np.flatnonzero(np.abs(self.count) == 1)
        while len(at):
            at = at[(np.abs(self.count[at]) == 1) & (self.check[at] == _check(self.key[at]))]
            if not len(at):
                break
            row, d, sign = at // self.cells, self.key[at], self.count[at]
            _, one = np.unique(np.stack([row.astype(U), d]), axis=1, return_index=True)
            row, d, sign = row[one], d[one], sign[one]
            rows.append(row), keys.append(d), signs.append(sign)
            self.add(row, d, -sign)
            at = np.unique(_cells(row, d, self.cells))
        empty = ((self.count == 0) & (self.key == 0) & (self.check == 0)).reshape(self.rows, self.cells).all(1)
        none = np.empty(0, np.int64)
        return (np.concatenate([none, *rows]), np.concatenate([np.empty(0, U), *keys]), np.concatenate([none, *signs]), empty)


def difference(a, b, rows: int, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, digest, sign)``: digests that only the first (1) or only the second (-1)
    version of each row has. ``a``/``b``: ``(row, digest)`` as :func:`digests` gives them."""
    found = []
    todo = np.arange(rows)
    while len(todo):
        place = np.full(rows, -1)
        place[todo] = np.arange(len(todo))
        s = Sketches(len(todo), cells)
        for (row, d), sign in ((a, 1), (b, -1)):
            mine = place[row] >= 0
            s.add(place[row[mine]], d[mine], sign)
        row, d, sign, whole = s.peel()
        good = whole[row]
        found.append((todo[row[good]], d[good], sign[good]))
        todo = todo[~whole]
        cells *= 4                                          # the next try is larger
    if not found:
        none = np.empty(0, np.int64)
        return none, none.astype(U), none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def likeness(a, b, rows: int, cells: int = CELLS) -> np.ndarray:
    row, _, sign = difference(a, b, rows, cells)
    na, nb = np.bincount(a[0], minlength=rows), np.bincount(b[0], minlength=rows)
    shared = na - np.bincount(row[sign > 0], minlength=rows)
    every = na + nb - shared
    return np.where(every == 0, 1.0, shared / np.maximum(every, 1))


def compared(versions: DataFrame, text_col: str, others: dict[str, tuple[str | None, str]], cells: int = CELLS,
             fingerprint_col: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint of ``text_col``; for each other version's column its
    fingerprint (unless ``None``) and likeness columns."""
    ship(versions.sparkSession)
    made = [fingerprint_col, *(c for pair in others.values() for c in pair if c)]
    versions = versions.drop(*made)               # older columns of these names are replaced
    names = versions.columns
    new = [T.StructField(fingerprint_col, T.StringType())]
    for fp, near in others.values():
        new += ([T.StructField(fp, T.StringType())] if fp else []) + [T.StructField(near, T.DoubleType())]
    out = T.StructType([*versions.schema.fields, *new])

    def sketch(row, d, n):
        s = Sketches(n, cells)
        s.add(row, d, 1)
        return pa.array(s.strings(), pa.string())

    def run(batches):
        for batch in batches:
            for part in steps(batch, text_col, 1 << 20):
                n = part.num_rows
                own = digests(part.column(names.index(text_col)))
                cols = [sketch(*own, n)]
                for name, (fp, near) in others.items():
                    other = digests(part.column(names.index(name)))
                    cols += ([sketch(*other, n)] if fp else []) + [pa.array(likeness(own, other, n, cells))]
                yield pa.RecordBatch.from_arrays([*part.columns, *cols], out.names)

    return versions.mapInArrow(run, out)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """``id, text, edited, next_text``: each text with the next document's (in
    ascending id, null first, then text; after the last the first) and its
    edited form: the last ``n // 2`` code points replaced by as many (or all) of
    the next document's first ones.

    Rows are dealt into ranges of ids; the first row of each range also goes to
    the range before, so texts are shuffled once and no task sees more than its
    range. The driver holds the bounds and first ids of the ranges only; their
    number follows ``spark.sql.shuffle.partitions``, not the rows."""
    spark = docs.sparkSession
    ship(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = buckets or 4 * parts
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(-2**63)).alias("_o"))
    cuts = sorted({int(x) for x in rows.select(F.col("_o").cast("double").alias("o")).approxQuantile("o", [i / n for i in range(1, n)], 0.2 / n)}) if n > 1 else []
    bounds = np.array(cuts, np.int64)

    @F.pandas_udf("int")
    def bucket(o):
        import pandas as pd
        return pd.Series(np.searchsorted(bounds, o.to_numpy(), "right").astype(np.int32))

    firsts = {r["b"]: r["o"] for r in rows.select("_o").groupBy(bucket("_o").alias("b")).agg(F.min("_o").alias("o")).collect()}
    used = sorted(firsts)
    before = {b: used[i - 1] for i, b in enumerate(used)}

    @F.pandas_udf("array<int>")
    def places(o):
        import pandas as pd
        home = np.searchsorted(bounds, o.to_numpy(), "right").tolist()
        return pd.Series([[b, before[b]] if firsts[b] == v else [b] for b, v in zip(home, o.tolist(), strict=True)])

    dealt = (rows.select("*", F.posexplode(places("_o")).alias("_ahead", "_bucket"))
             .repartition(parts, "_bucket").sortWithinPartitions("_bucket", "_ahead", "_o", "_text"))
    schema = T.StructType([docs.schema[id_col], *[T.StructField(c, T.StringType()) for c in (text_col, "edited", "next_text")]])

    def paired(batches):
        waiting = None                                       # the row whose next one has not come yet
        for batch in batches:
            for part in steps(batch, "_text", 1 << 20):
                out = []
                for key, text, ahead, b in zip(*(part.column(part.schema.get_field_index(c)).to_pylist() for c in ("_id", "_text", "_ahead", "_bucket")), strict=True):
                    if waiting and waiting[2] == b:
                        mine = waiting[1]
                        half = len(mine) // 2
                        out.append((waiting[0], mine, mine[:len(mine) - half] + text[:half], text))
                    waiting = None if ahead else (key, text, b)
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema.names)

    from pyspark.sql.pandas.types import to_arrow_type
    arrow = [to_arrow_type(f.dataType) for f in schema]
    return dealt.mapInArrow(paired, schema)
