"""Routing of repeated passages by content-selected anchors.

Every window of ``min_words`` consecutive words picks an anchor: the smallest
hash among its runs of ``ANCHOR_WORDS`` words. Windows with equal words pick
the same anchor at the same place, whatever surrounds them, so all occurrences
of a window meet under its anchor's key. Consecutive windows of a document
that pick the same anchor form a segment (about 70 words for 20 windows).

Only segments whose key occurs more than once go on; equal segments are
combined to one *content* before anything is shuffled by key, which also takes
care of groups of copies. Rows equal in id and text give their contents once,
with all their places counted. A key with more than ``HOT_CONTENTS`` different
contents (a common line in ever different surroundings) is not given to one
task: its windows are compared singly, by a grouping on their digests.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from eventide.llm.shared import saved, ship
from eventide.llm.textops import U, Words, _powers, grams, mix, steps

MIN_WORDS = 50
ANCHOR_WORDS = 12
HOT_CONTENTS = 20_000
SHARD_WORDS = 1_500_000        # words of one shard, about
_SEG = 0xC2B2AE3D27D4EB4F
_SEG2 = 0x165667B19E3779F9


def sliding_argmin(x: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest value (leftmost of equals) of each run of ``width`` values."""
    n = len(x) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    val, idx, have = x, np.arange(len(x)), 1
    while have < width:
        step = min(have, width - have)
        m = len(val) - step
        left = val[:m] <= val[step:]
        val, idx = np.where(left, val[:m], val[step:]), np.where(left, idx[:m], idx[step:])
        have += step
    return idx[:n]


def range_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of each run ``h[start:end]``."""
    total = np.zeros(len(h) + 1, U)
    np.cumsum(h * _powers(base, len(h)), out=total[1:])
    back = _powers(pow(base, -1, 1 << 64), len(h))
    return mix((total[end] - total[start]) * back[start] + (end - start).astype(U))


@dataclass
class Segments:
    doc: np.ndarray       # row of the batch
    start: np.ndarray     # first word, counted in the row
    count: np.ndarray     # windows
    anchor: np.ndarray    # words before the anchor
    key: np.ndarray
    content: np.ndarray


def segments(words: Words, min_words: int = MIN_WORDS, k: int = ANCHOR_WORDS) -> Segments:
    n = len(words) - min_words + 1
    if n <= 0:
        none = np.empty(0, np.int64)
        return Segments(none, none, none, none, none.astype(U), none.astype(U))
    g = grams(words, k)
    at = sliding_argmin(g, min_words - k + 1)
    valid = words.doc[:n] == words.doc[min_words - 1:]
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (at[1:] != at[:-1])
    first = np.flatnonzero(new)
    # a segment ends where the next begins or the windows of its row end
    marks = np.flatnonzero(new | ~valid)
    stop = np.append(marks, n)[np.searchsorted(marks, first, "right")]
    doc = words.doc[first]
    return Segments(doc, first - words.first[doc], stop - first, at[first] - first, g[at[first]],
                    range_hash(words.hash, first, stop + min_words - 1, _SEG))


def row_id() -> Column:
    """Tells rows with the same id but another text apart (rows equal in both are one)."""
    return F.xxhash64("doc", "text")


def prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return (docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .withColumn("rid", row_id()))


_SEGMENT = "doc long, rid long, start int, count int, anchor int, key long, content long"


def _emit(min_words: int, k: int):
    def run(batches):
        for batch in batches:
            for part in steps(batch, "text"):
                s = segments(Words(part.column(1)), min_words, k)
                row = pa.array(s.doc)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(row), part.column(2).take(row), pa.array(s.start.astype(np.int32)), pa.array(s.count.astype(np.int32)),
                     pa.array(s.anchor.astype(np.int32)), pa.array(s.key.view(np.int64)), pa.array(s.content.view(np.int64))],
                    ["doc", "rid", "start", "count", "anchor", "key", "content"])
    return run


def repeated_segments(rows: DataFrame, across: bool, min_words: int = MIN_WORDS, k: int = ANCHOR_WORDS) -> DataFrame:
    """Segments (of :func:`prepared` rows) whose key has more than one occurrence,
    or with ``across`` occurrences in more than one document."""
    ship(rows.sparkSession)
    found = rows.mapInArrow(_emit(min_words, k), _SEGMENT)
    last = F.coalesce(F.col("doc"), F.lit(2**63 - 1))
    stats = found.groupBy("key").agg(F.min(last).alias("_lo"), F.max(last).alias("_hi"), F.count("*").alias("_n"))
    # written first: a join of two plain shuffles can be split where one key is hot
    many = saved(stats.where(F.col("_lo") < F.col("_hi") if across else F.col("_n") > 1).select("key"), "passage-keys")
    return saved(found.join(many, "key"), "passage-segments")


def contents(rows: DataFrame, segs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Different segments with their words: ``key, content, first_doc, n,
    count, anchor, words`` (64-bit word hashes), fetched from the first
    document that has each. Rows equal in id and text give a content once per
    task that reads them; :func:`judged_windows` drops those repeats."""
    last = F.coalesce(F.col("doc"), F.lit(2**63 - 1))
    different = (segs.groupBy("key", "content")
                 .agg(F.min(F.struct(last.alias("last"), "doc", "rid", "start", "count", "anchor")).alias("at"), F.count("*").alias("n")))
    wanted = (different.select("at.doc", "at.rid", F.struct("at.start", "at.count", "at.anchor", "key", "content", "n").alias("seg"))
              .groupBy("doc", "rid").agg(F.collect_list("seg").alias("segs")))   # at most the document's own segments
    texts = rows.join(wanted.withColumnRenamed("doc", "_doc").withColumnRenamed("rid", "_rid"),
                      F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("rid") == F.col("_rid"))).select("doc", "text", "segs", "rid")
    return texts.mapInArrow(_fetch(min_words), "key long, content long, first_doc long, n long, count int, anchor int, words binary")


def _fetch(min_words: int):
    def run(batches):
        seen = set()
        for batch in batches:
            for part in steps(batch, "text"):
                rows = list(zip(part.column(0).to_pylist(), part.column(3).to_pylist(), strict=True))
                new = [i for i, r in enumerate(rows) if not (r in seen or seen.add(r))]
                if not new:
                    continue
                part = part if len(new) == len(rows) else part.take(pa.array(new))
                w = Words(part.column(1))
                lists = part.column(2)
                seg = lists.flatten()
                f = {name: seg.field(name).to_numpy(zero_copy_only=False) for name in ("start", "count", "anchor", "key", "content", "n")}
                row = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
                lo = w.first[row] + f["start"]
                hi = lo + f["count"] + min_words - 1
                size = hi - lo
                ends = np.concatenate([[0], np.cumsum(size)])
                flat = w.hash[np.repeat(lo - ends[:-1], size) + np.arange(ends[-1])]
                words = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer((ends * 8).astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())])
                docs = part.column(0).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f["key"]), pa.array(f["content"]), docs, pa.array(f["n"]), pa.array(f["count"].astype(np.int32)),
                     pa.array(f["anchor"].astype(np.int32)), words],
                    ["key", "content", "first_doc", "n", "count", "anchor", "words"])
    return run


def judged_windows(found: DataFrame, judge, min_words: int = MIN_WORDS, hot_contents: int = HOT_CONTENTS,
                   shard_words: int = SHARD_WORDS) -> DataFrame:
    """``key, content, first_docs, places``: for every window of every content
    the smallest document with these words (null id last: ``2**63 - 1``) and the
    number of places that have them.

    ``judge(contents)`` does it for one shard, ``contents`` being lists of word
    arrays, window counts, anchors, documents and numbers of places."""
    import pandas as pd

    found = saved(found, "passage-contents")
    sizes = found.groupBy("key").agg(F.count("*").alias("_m"), F.sum("count").alias("_w"))
    total = sizes.agg(F.sum("_w"), F.max("_m")).first()
    shards = max(1, int((total[0] or 0) * 3.5 // shard_words))
    hot = found.sparkSession.range(0).select(F.col("id").alias("key"))
    calm = found
    if (total[1] or 0) > hot_contents:
        hot = sizes.where(F.col("_m") > hot_contents).select("key")
        calm = found.join(hot, "key", "left_anti")
    out = "key long, content long, first_docs array<long>, places array<long>"

    def shard(pdf):
        pdf = pdf.drop_duplicates(["key", "content"])
        words = [np.frombuffer(x, U) for x in pdf["words"]]
        docs = pdf["first_doc"].fillna(2**63 - 1).astype("int64") if pdf["first_doc"].isna().any() else pdf["first_doc"].astype("int64")
        first, places = judge(words, pdf["count"].to_numpy(np.int64), pdf["anchor"].to_numpy(np.int64), docs.to_numpy(), pdf["n"].to_numpy(np.int64))
        return pd.DataFrame({"key": pdf["key"], "content": pdf["content"], "first_docs": first, "places": places})

    done = (calm.withColumn("_shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
            .groupBy("_shard").applyInPandas(shard, out))
    if (total[1] or 0) <= hot_contents:
        return done
    single = found.join(hot, "key").dropDuplicates(["key", "content"]).mapInArrow(_windows(min_words), "key long, content long, no int, w1 long, w2 long, doc long, n long")
    known = single.groupBy("w1", "w2").agg(F.min("doc").alias("first_doc"), F.sum("n").alias("places"))
    rest = (single.join(known, ["w1", "w2"]).groupBy("key", "content")
            .agg(F.sort_array(F.collect_list(F.struct("no", "first_doc", "places"))).alias("w"))   # the windows of one segment
            .select("key", "content", F.col("w.first_doc").alias("first_docs"), F.col("w.places").alias("places")))
    return done.unionByName(rest)


def _windows(min_words: int):
    def run(batches):
        for batch in batches:
            cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for i in range(0, batch.num_rows, 2048):
                part = {n: c.slice(i, 2048) for n, c in cols.items()}
                count = part["count"].to_numpy()
                flat = np.concatenate([np.frombuffer(x.as_py(), U) for x in part["words"]])
                base = np.cumsum(count + min_words - 1) - (count + min_words - 1)
                row = np.repeat(np.arange(len(count)), count)
                no = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                lo = base[row] + no
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part["key"].take(at), part["content"].take(at), pa.array(no.astype(np.int32)),
                     *[pa.array(range_hash(flat, lo, lo + min_words, b).view(np.int64)) for b in (_SEG, _SEG2)],
                     part["first_doc"].fill_null(2**63 - 1).take(at), part["n"].take(at)],
                    ["key", "content", "no", "w1", "w2", "doc", "n"])
    return run


def spans(mask: np.ndarray) -> list[tuple[int, int]]:
    """Runs of true values as (start, end)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))
