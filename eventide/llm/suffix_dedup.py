"""Repeated passages by sparse suffix arrays.

Of all suffixes (in words) only those that start at content-selected minimiser
positions are retained (:mod:`eventide.llm.passages` selects them and brings
equal ones together). Per shard they are sorted by the words to the right of
the anchor and, reversed, by the words to its left; comparing neighbours gives
the lengths that they share. A window of ``min_words`` words that lies ``o``
words left of an anchor is repeated if two retained suffixes share ``min_words
- o`` words to the right and ``o`` to the left, so matches are extended in both
directions up to the full window.

Result: maximal runs of words covered by windows that occur at two or more
places of the table (other documents, or elsewhere in the same one). Words are
runs without space and TAB..CR, unchanged. Null and empty texts and texts with
fewer than ``min_words`` words have none; very long texts go through whole, a
bounded number of segments at a time. Columns of other names are not read. Rows equal in id and text count as
two places and give their runs once; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from eventide.llm import passages
from eventide.llm.textops import U


def shared_lengths(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of a word matrix, and how many leading words each
    shares with the one before it in that order."""
    order = np.lexsort(rows.T[::-1])
    s = rows[order]
    same = s[1:] == s[:-1]
    lcp = np.where(same.all(1), rows.shape[1], np.argmin(same, 1))
    return order, np.concatenate([[0], lcp])


def classes(order: np.ndarray, lcp: np.ndarray, length: int) -> np.ndarray:
    """Number of each row's group of rows that share their first ``length`` words."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(lcp < length)
    return out


def judge(words: list[np.ndarray], count: np.ndarray, anchor: np.ndarray, doc: np.ndarray, places: np.ndarray,
          min_words: int = passages.MIN_WORDS) -> tuple[list, list]:
    """For each window of each content: smallest document and number of places
    (see :func:`passages.judged_windows`)."""
    m = len(words)
    size = np.array([len(w) for w in words])
    base = np.concatenate([[0], np.cumsum(size)])
    # one extra word that no text has stands for "past the end"
    flat = np.concatenate([*words, np.zeros(1, U)])
    col = np.arange(min_words)

    def context(step: int, first: np.ndarray, room: np.ndarray) -> np.ndarray:
        at = first[:, None] + step * col
        return flat[np.where(col < room[:, None], at, len(flat) - 1)]

    pos = base[:-1] + anchor
    right = shared_lengths(context(1, pos, size - anchor))
    left = shared_lengths(context(-1, pos - 1, anchor))
    first = [np.zeros(c, np.int64) for c in count]
    total = [np.zeros(c, np.int64) for c in count]
    for o in range(int(anchor.max(initial=-1)) + 1):
        j = anchor - o                                        # the window that starts o words before the anchor
        has = np.flatnonzero((j >= 0) & (j < count))
        if not len(has):
            continue
        pair = classes(*right, min_words - o)[has] * (m + 1) + classes(*left, o)[has]
        _, group = np.unique(pair, return_inverse=True)
        low = np.full(group.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(low, group, doc[has])
        n = np.bincount(group, weights=places[has]).astype(np.int64)
        for i, g in zip(has.tolist(), group.tolist(), strict=True):
            first[i][j[i]], total[i][j[i]] = low[g], n[g]
    return first, total


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_words: int = passages.MIN_WORDS) -> DataFrame:
    """``id, start, end, n_words, first_id, places``: maximal runs of repeated
    words (word positions, end exclusive), the smallest document that has the
    run's first window, and the largest number of places of its windows."""
    rows = passages.prepared(docs, id_col, text_col)
    segs = passages.repeated_segments(rows, across=False, min_words=min_words)
    found = passages.contents(rows, segs, min_words)

    def one_shard(*args):
        return judge(*args, min_words=min_words)

    judged = passages.judged_windows(found, one_shard, min_words)
    twice = F.exists("places", lambda n: n > 1)
    own = segs.select("doc", "rid", "start", "key", "content").distinct()       # of rows equal in id and text once
    marked = (own.join(judged.where(twice), ["key", "content"])
              .groupBy("doc", "rid").agg(F.collect_list(F.struct("start", "first_docs", "places")).alias("segs")))

    names = [id_col, "start", "end", "n_words", "first_id", "places"]

    def runs(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):       # a document may have many segments
                part = batch.slice(at, 256)
                yield _runs(part.column(0), part.column(1), min_words, names)

    return marked.select("doc", "segs").mapInArrow(
        runs, f"`{id_col}` long, start int, end int, n_words int, first_id long, places long")


def _runs(doc: pa.Array, segs: pa.ListArray, min_words: int, names: list[str]) -> pa.RecordBatch:
    """Maximal runs of repeated words from each document's judged segments."""
    seg = segs.flatten()
    low, places = seg.field("first_docs"), seg.field("places")
    count = pc.list_value_length(places).to_numpy()
    row = np.repeat(np.repeat(np.arange(len(doc)), np.diff(segs.offsets.to_numpy())), count)
    start = np.repeat(seg.field("start").to_numpy(), count) + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    low, places = low.flatten().to_numpy(), places.flatten().to_numpy()
    twice = np.flatnonzero(places > 1)
    order = twice[np.lexsort((start[twice], row[twice]))]
    row, start, low, places = row[order], start[order].astype(np.int64), low[order], places[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] > start[:-1] + min_words)     # not even touching
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row))[:len(first)] - 1
    end = start[last] + min_words
    most = np.maximum.reduceat(places, first) if len(first) else places
    none = low[first] == 2**63 - 1
    return pa.RecordBatch.from_arrays(
        [doc.take(pa.array(row[first])), *[pa.array(x.astype(np.int32)) for x in (start[first], end, end - start[first])],
         pa.array(low[first], pa.int64(), mask=none), pa.array(most)], names)
