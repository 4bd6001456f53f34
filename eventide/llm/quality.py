"""Quality by importance resampling: hashed n-gram models, Gumbel top-k.

Words and word pairs are hashed into ``BUCKETS`` features. The target model is
fitted on the feature frequencies of at most ``TARGET_ROWS`` good rows, those of
smallest hash; the raw model on those of all rows (both smoothed). A text's log weight is the mean log ratio of its features -
the mean, so that length does not decide - times a sharpness. Each row gets
its log weight plus Gumbel noise, seeded by its id and text; the ``k`` largest
are the sample, which is a draw without replacement in proportion to weight.

Sharpness and ``k`` come from the data (:func:`calibrated`). The sharpness is
the slope of the logistic curve that tells good from poor fitting rows by their
mean log ratio, taken under a model fitted without them (two folds): how far
the ratio is to be trusted. The share kept is the good share of all labelled
rows. Where only good rows are named, it is the smallest share of all rows per
share of good rows above any ratio, and the rows under that share count as poor.

The ``k``-th largest value is found by narrowing a histogram of the scored
table, so nothing is sorted whole and the driver holds one histogram. Rows
equal in value are told apart by a hash of id and text; rows equal in both are
taken together.

Null and empty texts have no features and log weight 0 x nothing: they are
given the smallest weight, never sampled before any text. An empty table gives
no rows; without good rows both models agree and every text weighs the same.
Without any labelled row every row is kept, with poor ones only none.
The models are vectors of ``BUCKETS`` counts, whatever the size of the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from eventide.llm.shared import saved, ship
from eventide.llm.textops import U, Words, mix, steps
from eventide.llm.toxicity import _fit

BUCKETS = 1 << 16
TARGET_ROWS = 20_000    # good rows that the target model reads at most, and poor rows that the sharpness is fitted on
SMOOTH = 1.0
CELLS = 4096            # of the histogram that the sharpness is fitted on
EMPTY = -1e9
_PAIR = 0xD1B54A32D192ED03


def features(col: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """``(row, bucket)`` of the hashed words and word pairs, A-Z folded."""
    w = Words(col, fold=True)
    if not len(w):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    two = w.doc[1:] == w.doc[:-1]
    pair = mix(w.hash[:-1] * U(_PAIR) + w.hash[1:])[two]
    h = np.concatenate([w.hash, pair])
    return np.concatenate([w.doc, w.doc[1:][two]]), (h % U(buckets)).astype(np.int64)


def counts(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Feature counts over the good rows of either fold and over all rows of
    ``text, good, fold``; summed per task, then by bucket: the driver gets one
    vector of each."""
    def count(batches):
        total = np.zeros((3, buckets), np.int64)
        for batch in batches:
            for part in steps(batch, "text"):
                row, b = features(part.column(0), buckets)
                good = np.nan_to_num(part.column(1).to_numpy(zero_copy_only=False).astype(float)).astype(bool)
                fold = part.column(2).to_numpy()
                total[2] += np.bincount(b, minlength=buckets)
                for f in (0, 1):
                    total[f] += np.bincount(b[(good & (fold == f))[row]], minlength=buckets)
        used = np.flatnonzero(total[2])
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(t[used]) for t in total)], ["b", "good0", "good1", "every"])

    names = ("good0", "good1", "every")
    found = (rows.select("text", "good", "fold").mapInArrow(count, "b long, good0 long, good1 long, every long")
             .groupBy("b").agg(*(F.sum(c).alias(c) for c in names)).toPandas())
    out = np.zeros((3, buckets), np.int64)
    for i, c in enumerate(names):
        out[i, found["b"]] = found[c]
    return out


def log_ratio(good: np.ndarray, every: np.ndarray, smooth: float = SMOOTH) -> np.ndarray:
    p, q = good + smooth, every + smooth
    return np.log(p / p.sum()) - np.log(q / q.sum())


def weighed(rows: DataFrame, ratios: np.ndarray, id_col: str = "doc_id") -> DataFrame:
    """``id, good, ratio, fair, noise, tie`` of every row of ``id, text, good,
    fold, tie``: mean log ratio under the whole model (``ratios[2]``) and under
    the one of the other fold (null without features), Gumbel noise."""
    out = T.StructType([rows.schema[id_col], T.StructField("good", T.IntegerType()), T.StructField("ratio", T.DoubleType()),
                        T.StructField("fair", T.DoubleType()), T.StructField("noise", T.DoubleType()), T.StructField("tie", T.LongType())])

    def weigh(batches):
        for batch in batches:
            for part in steps(batch, "text"):
                row, b = features(part.column(1), ratios.shape[1])
                n = np.bincount(row, minlength=part.num_rows)
                other = 1 - part.column(3).to_numpy()
                whole, fair = (np.bincount(row, weights=w, minlength=part.num_rows) / np.maximum(n, 1) for w in (ratios[2][b], ratios[other[row], b]))
                u = ((mix(part.column(4).to_numpy().view(U)) >> U(11)).astype(float) + 0.5) / 2**53
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(whole, mask=n == 0), pa.array(fair, mask=n == 0),
                                                  pa.array(-np.log(-np.log(u))), part.column(4)], out.names)

    return rows.select(id_col, "text", "good", "fold", "tie").mapInArrow(weigh, out)


def calibrated(rows: DataFrame, cells: int = CELLS) -> tuple[float, float]:
    """``(sharpness, good share)`` from ``good, fair`` of :func:`weighed` rows;
    the driver gets a histogram of three counts. The share is estimated from the
    good rows alone."""
    ends = rows.agg(F.count("*").alias("n"), F.min("fair").alias("lo"), F.max("fair").alias("hi"), F.count(F.when(F.col("good") == 1, F.col("fair"))).alias("good")).first()
    if not ends["good"]:
        return 1.0, 1.0
    lo, width = ends["lo"], (ends["hi"] - ends["lo"]) / cells
    cell = F.least(F.floor((F.col("fair") - lo) / width), F.lit(cells - 1)) if width > 0 else F.lit(0)
    n = lambda mark: F.count(F.when(F.col("good") == mark, 1))
    some = (rows.where(F.col("fair").isNotNull()).groupBy(cell.alias("c"))
            .agg(n(1).alias("good"), n(0).alias("poor"), F.count("*").alias("every")).orderBy("c").collect())
    at = lo + (np.array([r["c"] for r in some]) + 0.5) * width
    good, poor, every = (np.array([r[c] for r in some], float) for c in ("good", "poor", "every"))
    above = lambda x: np.cumsum(x[::-1])[::-1]
    seen = above(good) / good.sum()
    share = min(1.0, float((above(every) / ends["n"] / seen.clip(0.5))[seen >= 0.5].min()))
    if not poor.sum():
        under = np.cumsum(every) - every
        poor = np.clip(max(0.0, every.sum() - share * ends["n"]) - under, 0, every)
    if not poor.sum():
        return 1.0, share
    slope, _ = _fit(np.concatenate([at, at]), np.repeat([1.0, 0.0], len(at)), n=np.concatenate([good, poor]))
    return max(0.0, slope), share


def cutoff(keys: DataFrame, k: int, cells: int = 4096) -> tuple[float, int] | None:
    """``(gumbel_key, tie)`` of the ``k``-th row from above; ``None`` if all stay."""
    ends = keys.agg(F.count("*").alias("n"), F.min("gumbel_key").alias("lo"), F.max("gumbel_key").alias("hi")).first()
    if k >= ends["n"]:
        return None
    if k <= 0:
        return float("inf"), 0
    lo, hi, above = ends["lo"], ends["hi"], 0
    while lo < hi:
        width = (hi - lo) / cells
        cell = F.least(F.floor((F.col("gumbel_key") - lo) / width), F.lit(cells - 1)) if width > 0 else F.lit(0)
        some = (keys.where(F.col("gumbel_key").between(lo, hi)).groupBy(cell.alias("c"))
                .agg(F.count("*").alias("n"), F.min("gumbel_key").alias("lo"), F.max("gumbel_key").alias("hi")).collect())
        for r in sorted(some, key=lambda r: -r["c"]):
            if above + r["n"] >= k:
                break
            above += r["n"]
        if (lo, hi) == (r["lo"], r["hi"]):
            break
        lo, hi = r["lo"], r["hi"]
        if r["n"] <= cells:
            break
    if lo == hi:                     # all that is left is equal in value: taken together
        return lo, -2**63
    left = (keys.where(F.col("gumbel_key").between(lo, hi)).select("gumbel_key", "tie")
            .orderBy(F.desc("gumbel_key"), F.desc("tie")).limit(k - above).collect())
    return left[-1]["gumbel_key"], left[-1]["tie"]


def resample(docs: DataFrame, good: DataFrame, keep: float | None = None, id_col: str = "doc_id", text_col: str = "text", seed: int = 0,
             buckets: int = BUCKETS, target_rows: int = TARGET_ROWS, poor: DataFrame | None = None, sharpness: float | None = None) -> DataFrame:
    """``id, log_weight, gumbel_key, kept``; ``good(id)`` names the target rows,
    ``poor(id)`` labelled rows that are none; ``keep``, the share of rows that is
    sampled, and ``sharpness`` are worked out from them if not given."""
    marks = good.select(F.col(id_col), F.lit(1).alias("good"))
    if poor is not None:
        marks = marks.unionByName(poor.select(F.col(id_col), F.lit(0).alias("good")))
    marks = marks.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max("good").alias("good"))
    # at most `target_rows` ids of either kind: small enough to broadcast, whatever the table
    fitting = [marks.where(F.col("good") == g).orderBy(F.xxhash64(id_col), id_col).limit(target_rows) for g in ((1,) if poor is None else (1, 0))]
    target = fitting[0] if poor is None else fitting[0].unionByName(fitting[1])
    rows = (docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.xxhash64(F.lit(seed), id_col, text_col).alias("tie"))
            .join(F.broadcast(target), id_col, "left").withColumn("fold", F.pmod(F.xxhash64(F.lit(seed), id_col), F.lit(2)).cast("int")))
    ship(docs.sparkSession)
    fold0, fold1, every = counts(rows.withColumn("good", F.col("good") == 1), buckets)
    ratios = np.stack([log_ratio(g, every) for g in (fold0, fold1, fold0 + fold1)])
    scored = saved(weighed(rows, ratios, id_col), "quality-keys")
    if keep is None or sharpness is None:
        slope, share = calibrated(scored)
        if poor is not None:
            labelled = marks.agg(F.avg("good")).first()[0]
            share = 1.0 if labelled is None else labelled
        keep, sharpness = share if keep is None else keep, slope if sharpness is None else sharpness
    keys = (scored.withColumn("log_weight", F.coalesce(F.lit(float(sharpness)) * F.col("ratio"), F.lit(EMPTY)))
            .withColumn("gumbel_key", F.col("log_weight") + F.col("noise")))
    edge = cutoff(keys, int(round(keep * keys.count())))
    kept = F.lit(True) if edge is None else (
        (F.col("gumbel_key") > edge[0]) | ((F.col("gumbel_key") == edge[0]) & (F.col("tie") >= edge[1])))
    return keys.select(id_col, "log_weight", "gumbel_key", kept.alias("kept"))
