"""Repeated word sequences by compressed FM-indexes.

The segments that :mod:`eventide.llm.passages` brings together are indexed
shard by shard: the Burrows-Wheeler transform of a shard's words, kept as a
wavelet matrix of packed bits with rank counts. Every document's segments are
streamed through their shard's index by backward search, all of them in step;
the matching statistics - how many words match from here, and the interval of
suffixes that have them - report each interval at the threshold of
``min_words``. A match that has reached the threshold is shortened by one word
on the right (its interval widens to the suffixes that share the rest) before
it is extended to the left, so the search costs two ranks per word.

Result: every word covered by a window of ``min_words`` consecutive words whose
sequence also starts in a document with a smaller id is removed; windows are
judged on the input. Words are runs without space and TAB..CR, unchanged. Null
and empty texts have no words; rows with a null id count as last. Rows equal in
id and text are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from eventide.llm import passages
from eventide.llm.shared import ship
from eventide.llm.textops import U, Words, steps


class BitRank:
    """Packed bits with a count per 64."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.packbits(np.concatenate([bits, np.zeros(-n % 64 + 64, bool)]), bitorder="little")
        self.blocks = packed.view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.blocks))]).astype(np.int64)
        self.zeros = n - int(self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        block = at >> 6
        below = (U(1) << (at & 63).astype(U)) - U(1)
        return self.before[block] + np.bitwise_count(self.blocks[block] & below)


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit plane per level."""

    def __init__(self, seq: np.ndarray, symbols: int):
        self.levels = []
        self.depth = max(1, int(symbols).bit_length())
        for level in reversed(range(self.depth)):
            bit = (seq >> level) & 1 == 1
            self.levels.append(BitRank(bit))
            seq = np.concatenate([seq[~bit], seq[bit]])

    def walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits in zip(reversed(range(self.depth)), self.levels, strict=True):
            one = bits.ones(at)
            at = np.where((symbol >> level) & 1 == 1, bits.zeros + one, at - one)
        return at


class FMIndex:
    """Index of word sequences (as numbers from 1); each ends in a separator of its own."""

    def __init__(self, seqs: list[np.ndarray], symbols: int, depth: int):
        size = np.array([len(s) for s in seqs], np.int64)
        n = int(size.sum()) + len(seqs)
        text = np.zeros(n, np.int64)
        self.owner = np.repeat(np.arange(len(seqs)), size + 1)
        ends = np.cumsum(size + 1) - 1
        body = np.ones(n, bool)
        body[ends] = False
        text[body] = np.concatenate(seqs) if seqs else []
        # prefix doubling; a separator sorts by the sequence it ends, so all suffixes differ
        rank = np.where(body, text + len(seqs), self.owner)
        rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
        self.same: dict[int, np.ndarray] = {}
        have = 1
        by_words = {1: rank}
        while int(rank.max(initial=-1)) < n - 1 or have < depth:
            shifted = np.concatenate([rank[have:], np.full(min(have, n), -1)])[:n] + 1
            rank = np.unique(rank * (n + 1) + shifted, return_inverse=True)[1].astype(np.int64)
            have *= 2
            by_words[have] = rank
        order = self.order = np.argsort(rank)
        for length in (depth - 1, depth):
            # suffixes that share their first `length` words, from two overlapping powers of two
            half = max(p for p in by_words if p <= max(1, length))
            r = by_words[half]
            rest = np.concatenate([r[length - half:], np.full(min(length - half, n), -1)])[:n] + 1
            cls = (r * (n + 1) + rest)[order]
            self.same[length] = np.flatnonzero(np.concatenate([[True], cls[1:] != cls[:-1], [True]]))
        bwt = text[order - 1]
        self.wavelet = WaveletMatrix(bwt, symbols)
        count = np.bincount(bwt, minlength=symbols + 1)
        self.first = np.concatenate([[0], np.cumsum(count)])     # separators are symbol 0
        every = np.arange(symbols + 1)
        self.base = self.wavelet.walk(every, np.zeros(symbols + 1, np.int64))
        self.n = n

    def extend(self, symbol, lo, hi):
        """Interval of the match with one more word on its left."""
        base, first = self.base[symbol], self.first[symbol]
        return first + self.wavelet.walk(symbol, lo) - base, first + self.wavelet.walk(symbol, hi) - base

    def widen(self, length: int, lo):
        """Interval of all suffixes that share ``length`` words with the one at ``lo``."""
        marks = self.same[length]
        at = np.searchsorted(marks, lo, "right")
        return marks[at - 1], marks[at]


def judge(words: list[np.ndarray], count: np.ndarray, anchor: np.ndarray, doc: np.ndarray, places: np.ndarray,
          min_words: int = passages.MIN_WORDS) -> tuple[list, list]:
    """For each window of each content: smallest document and number of places
    (see :func:`passages.judged_windows`)."""
    m = len(words)
    if not m:
        return [], []
    size = np.array([len(w) for w in words])
    known, number = np.unique(np.concatenate(words), return_inverse=True)
    seqs = np.split(number.astype(np.int64) + 1, np.cumsum(size)[:-1])
    index = FMIndex(seqs, len(known), min_words)
    owner = index.owner[index.order]
    width = int(size.max())
    table = np.zeros((m, width), np.int64)                 # the streamed words, last word in column 0
    for i, s in enumerate(seqs):
        table[i, :len(s)] = s[::-1]
    lo, hi = np.zeros(m, np.int64), np.full(m, index.n)
    first = np.zeros((m, int(count.max())), np.int64)
    total = np.zeros_like(first)
    for step in range(width):
        live = np.flatnonzero(size > step)
        if step >= min_words:
            lo[live], hi[live] = index.widen(min_words - 1, lo[live])
        lo[live], hi[live] = index.extend(table[live, step], lo[live], hi[live])
        if step >= min_words - 1:                          # at the threshold: report the interval
            starts, back = np.unique(lo[live], return_inverse=True)
            stops = np.zeros_like(starts)
            stops[back] = hi[live]
            low, n = _over_intervals(doc[owner], places[owner], starts, stops)
            at = size[live] - 1 - step
            first[live, at], total[live, at] = low[back], n[back]
    return [first[i, :c] for i, c in enumerate(count)], [total[i, :c] for i, c in enumerate(count)]


def _over_intervals(doc, places, starts, stops):
    """Smallest document and number of places in disjoint intervals of suffixes."""
    marks = np.column_stack([starts, stops]).ravel()
    pad_doc, pad_n = np.append(doc, 2**63 - 1), np.append(places, 0)
    return np.minimum.reduceat(pad_doc, marks)[::2], np.add.reduceat(pad_n, marks)[::2]


def removed_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_words: int = passages.MIN_WORDS) -> DataFrame:
    """``id, n_words, n_removed, kept_text`` of every row."""
    spark = docs.sparkSession
    ship(spark)
    rows = passages.prepared(docs, id_col, text_col)
    segs = passages.repeated_segments(rows, across=True, min_words=min_words)

    def one_shard(*args):
        return judge(*args, min_words=min_words)

    judged = passages.judged_windows(passages.contents(rows, segs, min_words), one_shard, min_words)
    last = F.coalesce(F.col("doc"), F.lit(2**63 - 1))
    own = segs.select("key", "content", "doc", "rid", "start").distinct()       # of rows equal in id and text once
    marked = (own.join(judged.select("key", "content", "first_docs"), ["key", "content"])
              .withColumn("hits", F.transform("first_docs", lambda x: x < last))
              .where(F.array_contains("hits", True))
              .groupBy(F.col("doc").alias("_doc"), F.col("rid").alias("_rid"))
              .agg(F.collect_list(F.struct("start", "hits")).alias("segs")))
    joined = rows.join(marked, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("rid") == F.col("_rid")), "left").select("doc", "text", "segs")
    out = T.StructType([T.StructField(id_col, T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                        T.StructField("kept_text", T.StringType())])

    def cut(batches):
        for batch in batches:
            for part in steps(batch, "text"):
                w = Words(part.column(1), hashes=False)
                n = np.diff(w.first)
                cover = np.zeros(len(w) + 1, np.int64)
                for i, found in enumerate(part.column(2).to_pylist()):
                    for s in found or ():
                        at = w.first[i] + s["start"] + np.flatnonzero(s["hits"])
                        np.add.at(cover, at, 1)
                        np.add.at(cover, at + min_words, -1)
                gone = np.cumsum(cover)[:-1] > 0
                raw = w.buf.tobytes()
                start, end = w.start.tolist(), w.end.tolist()
                kept = [b" ".join([raw[start[j]:end[j]] for j in (np.flatnonzero(~gone[a:b]) + a).tolist()]).decode("utf-8", "surrogatepass")
                        for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
                dropped = np.bincount(w.doc, weights=gone, minlength=part.num_rows).astype(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n.astype(np.int64)), pa.array(dropped), pa.array(kept, pa.string())], out.names)

    return joined.mapInArrow(cut, out)
