"""Stream-stream joins (JON1-JON5 on streams).

Both inputs must carry a watermark (:func:`eventide.streaming.event_time.with_event_time`).
The time bounds in the join condition let Spark drop join state once the
watermark passes them; outer rows are emitted when the watermark shows no
partner can still arrive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from eventide.functions.timefn import duration_us


def _side(df: DataFrame, key: str, ts: str, cols: Sequence[str], p: str) -> DataFrame:
    return df.select(F.col(key).alias(f"{p}{key}"), F.col(ts).alias(f"{p}{ts}"),
                     *[F.col(c).alias(f"{p}{c}") for c in cols])


def stream_interval_match(left: DataFrame, right: DataFrame, key: str, lts: str, rts: str,
                          tolerance: str, left_cols: Sequence[str] = (), right_cols: Sequence[str] = (),
                          how: str = "full_outer", lp: str = "l_", rp: str = "r_") -> DataFrame:
    """``|rts - lts| <= tolerance`` on the same key (JON4/JON5 on streams).

    ``how='full_outer'`` gives the unified output (JON5): matched pairs, plus
    each side's unmatched rows with NULLs once the watermark passes their
    tolerance; split it on the NULL side for the three outputs of JON4.
    """
    l = _side(left, key, lts, left_cols, lp)
    r = _side(right, key, rts, right_cols, rp)
    secs = duration_us(tolerance) / 1_000_000
    tol = F.expr(f"INTERVAL {secs} SECONDS")
    cond = (F.col(f"{lp}{key}") == F.col(f"{rp}{key}")) & \
        F.col(f"{rp}{rts}").between(F.col(f"{lp}{lts}") - tol, F.col(f"{lp}{lts}") + tol)
    return l.join(r, cond, how)


def stream_window_join(left: DataFrame, right: DataFrame, key: str, ts: str, size: str,
                       left_cols: Sequence[str] = (), right_cols: Sequence[str] = (),
                       how: str = "inner", lp: str = "l_", rp: str = "r_") -> DataFrame:
    """Same key and same tumbling window (JON1; ``how='left_outer'`` for JON2).

    Rows of one window are at most ``size`` apart, which is the time bound the
    stream join needs to expire its state.
    """
    secs = duration_us(size) / 1_000_000
    l = _side(left, key, ts, left_cols, lp).withColumn("_lw", F.window(f"{lp}{ts}", size).start)
    r = _side(right, key, ts, right_cols, rp).withColumn("_rw", F.window(f"{rp}{ts}", size).start)
    bound = F.col(f"{rp}{ts}").between(F.col(f"{lp}{ts}") - F.expr(f"INTERVAL {secs} SECONDS"),
                                       F.col(f"{lp}{ts}") + F.expr(f"INTERVAL {secs} SECONDS"))
    cond = (F.col(f"{lp}{key}") == F.col(f"{rp}{key}")) & (F.col("_lw") == F.col("_rw")) & bound
    return l.join(r, cond, how).withColumnRenamed("_lw", "window_start").drop("_rw")
