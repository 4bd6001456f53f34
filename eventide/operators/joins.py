"""Window joins (JON1-JON3) and the two-stream match with tolerance (JON4, JON5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from eventide.functions.timefn import add_us, duration_us, slice_id
from eventide.operators.sequence import Running, mark_hot, unmarked, with_runnings


def _prefixed(df: DataFrame, keep: Sequence[str], key: str, p: str) -> DataFrame:
    return df.select(*[F.col(c) if c == key else F.col(c).alias(f"{p}{c}") for c in keep])


def window_join(left: DataFrame, right: DataFrame, key: str, ts: str, size: str,
                how: str = "inner", left_cols: Sequence[str] = (), right_cols: Sequence[str] = (),
                lp: str = "l_", rp: str = "r_") -> DataFrame:
    """Rows of both sides with the same key in the same tumbling window pair up.

    An equi-join on (key, window start); ``how`` is inner (JON1), left (JON2:
    unmatched left rows keep NULL right columns) or full (JON3: the left join
    and the right rows without partner, two joins that a skewed (key, window)
    can be split in, which a full outer join cannot).
    """
    us = duration_us(size)
    l = _prefixed(left, [key, ts, *left_cols], key, lp).withColumn("_w", slice_id(f"{lp}{ts}", us))
    r = _prefixed(right, [key, ts, *right_cols], key, rp).withColumn("_w", slice_id(f"{rp}{ts}", us))
    j = l.join(r, on=[key, "_w"], how={"inner": "inner", "left": "left", "full": "left"}[how])
    if how == "full":
        j = j.unionByName(r.join(l.select(key, "_w"), on=[key, "_w"], how="left_anti"), allowMissingColumns=True)
    start = add_us(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("_w") * F.lit(us))
    return j.withColumn("window_start", start).withColumn("window_end", add_us(start, us)).drop("_w")


def interval_match(left: DataFrame, right: DataFrame, key: str, lts: str, rts: str,
                   tolerance: str | None, left_cols: Sequence[str] = (),
                   right_cols: Sequence[str] = (), lp: str = "l_",
                   rp: str = "r_", unified: bool = False, slice_size: str = "6 hours"):
    """Match left and right rows on ``key`` with ``|rts - lts| <= tolerance``.

    Returns (matched pairs, left rows without partner, right rows without
    partner), or with ``unified=True`` one DataFrame with NULLs on the missing
    side (JON5).

    Pairs: a range condition on a key alone would compare every pair of a hot
    key, so the range is bucketed: the side that probes is copied into the
    three buckets of length ``tolerance`` around it, the other side sits in one
    bucket, and the join is an equi-join on (key, bucket); tolerance 0 is an
    equi-join on (key, time). Rows without partner: both sides in one sequence
    per key, sliced by ``slice_size``; a row has a partner if the other side's
    nearest row before or after it is near enough. ``tolerance=None`` matches
    on the key alone. Rows with a NULL key or (with a tolerance) a NULL time
    have no partner.
    """
    l = _prefixed(left, [key, lts, *left_cols], key, lp)
    r = _prefixed(right, [key, rts, *right_cols], key, rp)
    lt, rt = f"{lp}{lts}", f"{rp}{rts}"
    if tolerance is None:
        out = (l.join(r, on=[key], how="inner"), l.join(r.select(key), on=[key], how="left_anti"),
               r.join(l.select(key), on=[key], how="left_anti"))
        return unify(*out) if unified else out

    tol = duration_us(tolerance)
    if tol == 0:
        matched = (l.withColumn("_b", F.col(lt)).join(r.withColumn("_b", F.col(rt)), on=[key, "_b"], how="inner").drop("_b"))
    else:
        b = slice_id(rt, tol)
        near = F.abs(F.timestamp_diff("MICROSECOND", F.col(lt), F.col(rt))) <= tol
        matched = (l.withColumn("_b", slice_id(lt, tol))
                   .join(r.withColumn("_b", F.explode(F.array(b - 1, b, b + 1))), on=[key, "_b"], how="inner")
                   .where(near).drop("_b"))
    alone = _without_partner(l, r, key, lt, rt, tol, slice_size, at_once=unified)
    if unified:
        return matched.unionByName(alone.drop("_side"), allowMissingColumns=True)
    return (matched, alone.where(F.col("_side") == 0).select(*l.columns), alone.where(F.col("_side") == 1).select(*r.columns))


def _without_partner(l: DataFrame, r: DataFrame, key: str, lt: str, rt: str, tol: int, slice_size: str, at_once: bool = False) -> DataFrame:
    """Rows of both sides (``_side`` 0 and 1) without a partner, in one pass."""
    both = (l.withColumn("_side", F.lit(0)).withColumn("_t", F.col(lt))
            .unionByName(r.withColumn("_side", F.lit(1)).withColumn("_t", F.col(rt)), allowMissingColumns=True))
    on = lambda side: F.when(F.col("_side") == side, F.col("_t"))
    specs = [Running(f"_{at}{side}", on(side), fn, include_current=False, reverse=rev)
             for side in (0, 1) for at, fn, rev in (("before", "max", False), ("after", "min", True))]
    part = slice_id("_t", slice_size)
    both = mark_hot(both, [key], part, at_once)
    # rows of equal time lie next to each other, so one of the two directions sees them
    d = with_runnings(both, [key], ["_t", "_side"], specs, part)
    gap = lambda at: F.abs(F.timestamp_diff("MICROSECOND", F.col(at), F.col("_t"))) <= tol
    close = lambda side: F.coalesce(gap(f"_before{side}"), F.lit(False)) | F.coalesce(gap(f"_after{side}"), F.lit(False))
    has = F.when(F.col("_side") == 0, close(1)).otherwise(close(0)) & F.col(key).isNotNull()
    return unmarked(d).where(~has).drop("_t", *[s.name for s in specs])


def unify(matched: DataFrame, left_only: DataFrame, right_only: DataFrame) -> DataFrame:
    """JON5: one output, NULL on the missing side."""
    return matched.unionByName(left_only, allowMissingColumns=True) \
                  .unionByName(right_only, allowMissingColumns=True)
