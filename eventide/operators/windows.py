"""Time-window aggregation (AGG1-AGG12, STR3) with the pane plan for overlapping windows.

Windows are ``[start, end)`` aligned to the epoch, as ``F.window``. Only windows
holding at least one row exist. Output columns: ``window_start``,
``window_end``, the keys, then one column per aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.functions.timefn import add_us, duration_us, epoch_us, from_epoch_us

# (output name, function, input column or "*")
Agg = tuple[str, str, str]

# Below this many overlapping windows per row the plain plan is used; above it
# rows are first reduced to panes of length `slide`, so the copy per window is
# made for (pane, key) partials instead of raw rows.
PANE_MIN_OVERLAP = 8
# From this overlap on, counts use the change-point plan (no copies at all).
# Measured at sf0.1 / local[8], pane vs change points: overlap 12: 0.35 vs
# 0.56 s; 60: 1.6 vs 0.85; 120: 2.4 vs 1.05; 720: 24 vs 1.3. The pane plan
# shuffles ~overlap copies per (key, pane), the change-point plan ~2 rows, so
# on large dense inputs the change points win much earlier: both thresholds
# can be set per session (see _threshold).
DELTA_MIN_OVERLAP = 24


def _threshold(name: str, default: int) -> int:
    """Session override: ``spark.conf.set('eventide.window.<name>', n)``."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    if spark is None:
        return default
    v = spark.conf.get(f"eventide.window.{name}", None)
    return int(v) if v else default


def _plain_agg(fn: str, col: str) -> Column:
    c = F.lit(1) if col == "*" else F.col(col)
    return {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg}[fn](c)


def _partials(name: str, fn: str, col: str) -> list[Column]:
    c = F.lit(1) if col == "*" else F.col(col)
    if fn == "count":
        return [F.count(c).alias(f"_{name}_n")]
    if fn == "avg":
        return [F.sum(c).alias(f"_{name}_s"), F.count(c).alias(f"_{name}_n")]
    return [{"sum": F.sum, "min": F.min, "max": F.max}[fn](c).alias(f"_{name}_v")]


def _merge(name: str, fn: str) -> Column:
    if fn == "count":
        return F.sum(f"_{name}_n").alias(name)
    if fn == "avg":
        return (F.sum(f"_{name}_s") / F.sum(f"_{name}_n")).alias(name)
    return {"sum": F.sum, "min": F.min, "max": F.max}[fn](f"_{name}_v").alias(name)


def window_agg(df: DataFrame, keys: Sequence[str], ts: str, size: str,
               slide: str | None = None, aggs: Sequence[Agg] = (("cnt", "count", "*"),),
               plan: str = "auto") -> DataFrame:
    """Tumbling (``slide=None``) or sliding window aggregate per key.

    ``plan``: ``'plain'`` (``F.window`` expands each row into size/slide
    copies), ``'pane'`` (aggregate to slide-length panes first, then expand the
    pane partials), or ``'auto'`` (pane when overlap >= PANE_MIN_OVERLAP).
    """
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide else size_us
    overlap = size_us // slide_us
    if plan == "auto":
        plan = "pane" if overlap >= _threshold("paneMinOverlap", PANE_MIN_OVERLAP) else "plain"
    if plan == "pane" and (size_us % slide_us or overlap == 1):
        plan = "plain"

    if plan == "plain":
        win = F.window(ts, size, slide) if slide and slide_us != size_us else F.window(ts, size)
        out = df.groupBy(win.alias("_w"), *keys).agg(*[_plain_agg(f, c).alias(n) for n, f, c in aggs])
        return out.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                          *keys, *[n for n, _, _ in aggs])

    parts = [p for n, f, c in aggs for p in _partials(n, f, c)]
    panes = df.groupBy(F.window(ts, slide).alias("_p"), *keys).agg(*parts)
    # A pane [ps, ps+slide) lies in the windows ending at ps+slide, ..., ps+size.
    copies = (panes
              .withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(overlap - 1))))
              .withColumn("window_end", add_us(F.col("_p.end"), F.col("_i").cast("long") * F.lit(slide_us))))
    out = copies.groupBy("window_end", *keys).agg(*[_merge(n, f) for n, f, _ in aggs])
    return out.select(add_us(F.col("window_end"), -size_us).alias("window_start"), "window_end",
                      *keys, *[n for n, _, _ in aggs])


def window_count(df: DataFrame, keys: Sequence[str], ts: str, size: str,
                 slide: str | None = None, name: str = "cnt", plan: str = "auto") -> DataFrame:
    """Count rows per key and window (AGG1-AGG5, AGG10).

    Sliding counts with overlap >= DELTA_MIN_OVERLAP use the change-point plan
    (:func:`_delta_count`), from PANE_MIN_OVERLAP the pane plan; ``plan``
    forces ``'plain'``, ``'pane'`` or ``'delta'``.
    """
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide else size_us
    overlap = size_us // slide_us
    if plan == "auto":
        delta_min = _threshold("deltaMinOverlap", DELTA_MIN_OVERLAP)
        plan = "delta" if overlap >= delta_min and size_us % slide_us == 0 else "auto"
    if plan == "delta" and overlap > 1 and size_us % slide_us == 0:
        return _delta_count(df, keys, ts, size_us, slide_us, name)
    return window_agg(df, keys, ts, size, slide, [(name, "count", "*")], "auto" if plan == "delta" else plan)


# Change points of a key are stitched per slice of this many window sizes.
DELTA_SLICE_SIZES = 64


def _delta_count(df: DataFrame, keys: Sequence[str], ts: str, size_us: int, slide_us: int,
                 name: str) -> DataFrame:
    """Sliding count in O(panes + output) instead of O(rows x size/slide).

    A pane [ps, ps+slide) with n rows raises the count of every window ending
    in [ps+slide, ps+size] by n: +n at ps+slide, -n at ps+size+slide. A running
    sum of these changes per key gives the count on each stretch between two
    change points; each stretch with a positive count is expanded into its
    window ends (the output rows themselves), so no copy of the input is made
    and nothing shuffles after the expansion. Counts are integers, so the
    running sum is exact.
    """
    t = "_cp"
    panes = df.groupBy(*keys, F.floor(epoch_us(ts) / F.lit(slide_us)).cast("long").alias("_pi")) \
              .agg(F.count(F.lit(1)).alias("_n"))
    start = F.col("_pi") * F.lit(slide_us)
    deltas = panes.select(*keys, F.explode(F.array(
        F.struct((start + slide_us).alias(t), F.col("_n").alias("_d")),
        F.struct((start + size_us + slide_us).alias(t), (-F.col("_n")).alias("_d")))).alias("_e"))
    deltas = deltas.groupBy(*keys, F.col("_e")[t].alias(t)).agg(F.sum(F.col("_e._d")).alias("_d"))
    # One sliced pass gives both the level (running sum) and the next change
    # point: in-slice window plus a per-slice summary (total, first point)
    # carried to the neighbouring slices.
    sl = F.floor(F.col(t) / F.lit(size_us * DELTA_SLICE_SIZES)).cast("long")
    d = deltas.withColumn("_k", F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0))) \
              .withColumn("_s", sl)
    w = Window.partitionBy("_k", "_s").orderBy(t)
    base = (d.withColumn("_in", F.sum("_d").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
             .withColumn("_nx", F.lead(t).over(w)))
    summ = d.groupBy("_k", "_s").agg(F.sum("_d").alias("_tot"), F.min(t).alias("_first"))
    wk = Window.partitionBy("_k").orderBy("_s")
    carry = summ.select("_k", "_s",
                        F.sum("_tot").over(wk.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
                        F.lead("_first").over(wk).alias("_next_first"))
    lv = (base.join(carry, on=["_k", "_s"], how="left")
              .withColumn("_lv", F.col("_in") + F.coalesce(F.col("_before"), F.lit(0)))
              .withColumn("_nxt", F.coalesce(F.col("_nx"), F.col("_next_first"))))
    seg = lv.where(F.col("_lv") > 0)
    ends = F.sequence(F.col(t), F.col("_nxt") - F.lit(slide_us), F.lit(slide_us))
    out = seg.select(*keys, F.explode(ends).alias("_end"), F.col("_lv").alias(name))
    end = from_epoch_us(F.col("_end"))
    return out.select(add_us(end, -size_us).alias("window_start"), end.alias("window_end"), *keys, name)


def unique_visitors(df: DataFrame, ts: str, user: str, size: str, slide: str | None = None,
                    name: str = "uv", exact: bool = True) -> DataFrame:
    """Distinct users per (non-keyed) window (AGG12).

    Exact: one ``count(DISTINCT)``, which Spark plans in two phases (partial
    aggregation on (window, user), then a per-window count), so one busy
    window never gathers raw rows in one task. ``exact=False`` uses HLL.
    """
    win = F.window(ts, size, slide) if slide else F.window(ts, size)
    fn = F.count_distinct(user) if exact else F.approx_count_distinct(user)
    out = df.groupBy(win.alias("_w")).agg(fn.alias(name))
    return out.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), name)


def flag_repeats(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 name: str = "seen_before", slice_col: Column | None = None) -> DataFrame:
    """Flag every row whose key already occurred earlier in ``order`` (AGG13):
    the running count of earlier rows of the key is positive.

    Through :func:`eventide.operators.sequence.with_running`: one window per
    key while keys fit in a task, per (key, time slice) with a carried count
    when ``slice_col`` is given (a hot key is spread over its slices).
    """
    from eventide.operators.sequence import with_running

    d = with_running(df, list(keys), list(order), F.lit(1), "count", "_n_before",
                     include_current=False, slice_col=slice_col)
    return d.withColumn(name, F.col("_n_before") > 0).drop("_n_before")
