"""Event-pattern and keyed-state rules in batch form (PAT1-PAT6, STA1-STA3, STR5).

Each rule is stated on event time: rows of a key are ordered by
``order`` (timestamp first, then a tie-break id). The time limit of a pattern
is strict (``gap < within``); STA3 uses a timer, so there ``gap <= within``.
All sequence work goes through :mod:`eventide.operators.sequence`, so with a
``slice_col`` no key is ever gathered in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.functions.timefn import duration_us, epoch_us, from_epoch_us, slice_id
from eventide.operators.sequence import mark_hot, next_where, null_safe_join, unmarked, with_neighbours, with_running
from eventide.operators.userfn import apply_groups

# Fixed value: the warning text of the click cap, with the cap inserted.
CAP_WARNING = "Click over {n} times today."


def _gap_us(a: Column, b: Column) -> Column:
    """Microseconds from ``a`` to ``b``."""
    return F.timestamp_diff("MICROSECOND", a, b)


# ---------------------------------------------------------------- STA1
#: Largest k for which Spark plans ``row_number() <= k`` with a partial limit
#: before the shuffle (``spark.sql.optimizer.windowGroupLimitThreshold``).
GROUP_LIMIT = 1000


def rate_cap(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], max_count: int,
             day_tz: str = "UTC", slice_size: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Click cap per key and day: the first ``max_count + 1`` rows pass; the
    next one raises one warning; later rows are dropped; the count resets each
    day (midnight in ``day_tz``; ``ts`` is a UTC wall clock).

    Up to ``GROUP_LIMIT`` both outputs are ``row_number() <= k`` per (key, day),
    planned as a partial WindowGroupLimit, so at most k rows per group leave
    each map task even if one key holds most of the data. A larger cap has no
    such limit: its rows are numbered per (key, day, time slice) of
    ``slice_size`` (then "10 minutes" by default) and stitched.
    """
    local = F.col(ts) if day_tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(day_tz), F.col(ts))
    d = df.withColumn("day", F.to_date(local))
    if max_count + 2 > GROUP_LIMIT and slice_size is None:
        slice_size = "10 minutes"
    if slice_size:
        d = with_running(d, [*keys, "day"], order, F.lit(1), "count", "_rn", slice_col=slice_id(ts, slice_size))
    else:
        d = d.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys, "day").orderBy(*order)))
    passed = d.where(F.col("_rn") <= max_count + 1).drop("_rn")
    warn = (d.where(F.col("_rn") <= max_count + 2)
             .where(F.col("_rn") == max_count + 2)
             .select(*keys, "day", F.col(ts).alias("warn_ts"),
                     F.lit(CAP_WARNING.format(n=max_count)).alias("msg")))
    return passed, warn


# ---------------------------------------------------------------- PAT1, PAT2
def consecutive(df: DataFrame, key: str, order: Sequence[str], cond: Column, times: int = 2,
                within: str | None = None, cols: Sequence[str] = (),
                slice_col: Column | None = None, emit: str = "last") -> DataFrame:
    """``times`` rows in a row (strict contiguity within the key) that all satisfy
    ``cond``, the last within ``within`` of the first. Overlapping matches are
    all emitted. Returns the matching last rows with struct columns
    ``prev1 .. prev{times-1}`` (order + cols of the earlier rows);
    ``emit='list'`` adds ``events``, the matched rows in order (bounded by
    ``times``)."""
    ts = order[0]
    fields = list(dict.fromkeys([*order, *cols, "_c"]))
    d = df.withColumn("_c", cond)
    d = with_neighbours(d, [key], order, fields, times - 1, prefix="prev", slice_col=slice_col)
    m = F.col("_c")
    for i in range(1, times):
        m = m & F.coalesce(F.col(f"prev{i}")["_c"], F.lit(False))
    if within is not None:
        m = m & (_gap_us(F.col(f"prev{times - 1}")[ts], F.col(ts)) < duration_us(within))
    out = d.where(m)
    for i in range(1, times):
        out = out.withColumn(f"prev{i}", F.col(f"prev{i}").dropFields("_c"))
    if emit == "list":
        this = F.struct(*[F.col(c) for c in dict.fromkeys([*order, *cols])])
        out = out.withColumn("events", F.array(*[F.col(f"prev{i}") for i in range(times - 1, 0, -1)], this))
    return out.drop("_c")


# ---------------------------------------------------------------- PAT4, STA3
def followed_by(df: DataFrame, key: str, order: Sequence[str], first: Column, second: Column,
                within: str, cols: Sequence[str] = (), inclusive: bool = False,
                slice_col: Column | None = None) -> DataFrame:
    """For every ``first`` row: the next later ``second`` row of the key
    (relaxed contiguity: other rows may lie between) as struct ``follow``, and
    ``matched`` = it exists and its gap is ``< within`` (``<=`` if inclusive).
    One ``second`` row completes every open ``first`` before it."""
    ts = order[0]
    d = df.where(first | second).withColumn("_first", first)
    d = next_where(d, [key], order, second, list(cols), "follow", slice_col)
    gap = _gap_us(F.col(ts), F.col("follow")[ts])
    lim = duration_us(within)
    ok = (gap <= lim) if inclusive else (gap < lim)
    return (d.where(F.col("_first"))
             .withColumn("matched", F.coalesce(F.col("follow").isNotNull() & ok, F.lit(False)))
             .drop("_first"))


def missing_followup(df: DataFrame, key: str, order: Sequence[str], first: Column, second: Column,
                     within: str, slice_col: Column | None = None) -> DataFrame:
    """``first`` rows with no ``second`` row of the key in ``[ts, ts + within]`` (STA3)."""
    r = followed_by(df, key, order, first, second, within, inclusive=True, slice_col=slice_col)
    return r.where(~F.col("matched")).drop("follow", "matched")


# ---------------------------------------------------------------- PAT5, PAT6 not-next
def next_row(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str],
             slice_col: Column | None = None) -> DataFrame:
    """Adds struct ``nxt`` = order + cols of the next row of the key (or NULL)."""
    fields = list(dict.fromkeys([*order, *cols]))
    return with_neighbours(df, [key], order, fields, 1, direction="next", prefix="_nx",
                           slice_col=slice_col).withColumnRenamed("_nx1", "nxt")


def next_pairs(df: DataFrame, key: str, order: Sequence[str], value: str, within: str,
               slice_col: Column | None = None, cond=None,
               cols: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Any row followed *immediately* by a row satisfying ``cond`` within
    ``within`` -> (completed pairs, timed-out starts). ``cond(nxt)`` gets the
    next row as struct column ``nxt`` (fields: order, ``value``, ``cols``) and
    may compare it with the current row's columns; the default is "``value``
    is greater". A start times out when no next row arrives within the time; a
    next row that fails ``cond`` just ends the partial match."""
    ts = order[0]
    d = next_row(df, key, order, [value, *cols], slice_col)
    gap = _gap_us(F.col(ts), F.col("nxt")[ts])
    in_time = F.col("nxt").isNotNull() & (gap < duration_us(within))
    test = cond(F.col("nxt")) if cond is not None else F.col("nxt")[value] > F.col(value)
    pairs = d.where(in_time & test)
    timeouts = d.where(~F.coalesce(in_time, F.lit(False))).drop("nxt")
    return pairs, timeouts


def not_next(df: DataFrame, key: str, order: Sequence[str], first: Column, banned: Column,
             slice_col: Column | None = None) -> DataFrame:
    """``first`` rows whose next row of the key (if any) does not satisfy ``banned``."""
    d = df.withColumn("_first", first).withColumn("_banned", banned)
    d = next_row(d, key, order, ["_banned"], slice_col)
    return (d.where(F.col("_first") & ~F.coalesce(F.col("nxt")["_banned"], F.lit(False)))
             .drop("_first", "_banned", "nxt"))


def not_followed_by(df: DataFrame, key: str, order: Sequence[str], first: Column, banned: Column,
                    within: str, slice_col: Column | None = None) -> DataFrame:
    """``first`` rows with no later ``banned`` row of the key within ``within`` (gap < within)."""
    r = followed_by(df, key, order, first, banned, within, slice_col=slice_col)
    return r.where(~F.col("matched")).drop("follow", "matched")


# ---------------------------------------------------------------- PAT6 followed-by-any
def followed_by_any(df: DataFrame, key: str, ts: str, tiebreak: str, first: Column, second: Column,
                    within: str, cols: Sequence[str] = ()) -> DataFrame:
    """Every (first, later second) pair of a key with gap ``< within``.

    A range join made an equi-join: time buckets of length ``within`` ; each
    ``first`` row probes its own bucket and the next one, so a pair is found
    exactly once and a hot key is spread over its buckets.
    """
    lim = duration_us(within)
    keep = list(dict.fromkeys([key, ts, tiebreak, *cols]))
    a = df.where(first).select(*keep).withColumn("_b", slice_id(ts, within))
    a = a.withColumn("_b", F.explode(F.array(F.col("_b"), F.col("_b") + 1)))
    b = df.where(second).select(*keep).withColumn("_b", slice_id(ts, within))
    a = a.select(*[F.col(c).alias(f"first_{c}") if c != key else F.col(c) for c in keep], "_b")
    b = b.select(*[F.col(c).alias(f"second_{c}") if c != key else F.col(c) for c in keep], "_b")
    j = null_safe_join(a, b, [key], "inner", extra=["_b"])
    after = (F.col(f"second_{ts}") > F.col(f"first_{ts}")) | (
        (F.col(f"second_{ts}") == F.col(f"first_{ts}")) & (F.col(f"second_{tiebreak}") > F.col(f"first_{tiebreak}")))
    return j.where(after & (_gap_us(F.col(f"first_{ts}"), F.col(f"second_{ts}")) < lim)).drop("_b")


# ---------------------------------------------------------------- STA2
def _rising_runs(df: DataFrame, key: str, order: Sequence[str], value: str, hold: str,
                 slice_col: Column | None) -> tuple[DataFrame, DataFrame]:
    """(rows with segment id and rise flag, first alert of every run with its segment)."""
    ts = order[0]
    d = with_neighbours(mark_hot(df, [key], slice_col), [key], order, [value], 1, prefix="_p", slice_col=slice_col)
    prev = F.col("_p1")[value]
    d = (d.withColumn("_fall", F.coalesce(F.col(value) < prev, F.lit(False)).cast("long"))
          .withColumn("_rise", F.coalesce(F.col(value) > prev, F.lit(False)))
          .drop("_p1"))
    d = unmarked(with_running(d, [key], order, F.col("_fall"), "sum", "_seg", slice_col=slice_col))
    # Per segment (rows between falls; a fall opens a new segment): first rise
    # and the segment's first row. Both are partial aggregates.
    seg = d.groupBy(key, "_seg").agg(
        F.min(F.when(F.col("_rise"), F.col(ts))).alias("run_start"),
        F.min(F.col(ts)).alias("_seg_start"))
    nxt = seg.select(key, (F.col("_seg") - 1).alias("_seg"), F.col("_seg_start").alias("_next_fall"))
    alert = F.timestamp_add("MICROSECOND", F.lit(duration_us(hold)), F.col("run_start"))
    alerts = (null_safe_join(seg.where(F.col("run_start").isNotNull()), nxt, [key], "left", extra=["_seg"])
                 .where(F.col("_next_fall").isNull() | (F.col("_next_fall") > alert))
                 .select(key, "_seg", "run_start", alert.alias("alert_ts"), "_next_fall"))
    return d, alerts


def rising_alert(df: DataFrame, key: str, order: Sequence[str], value: str, hold: str,
                 slice_col: Column | None = None) -> DataFrame:
    """First alert of every rising run: a run starts at the first rise
    (``v > prev``) after the last fall (``v < prev``; equal values neither start
    nor cancel); it alerts at ``t0 + hold`` if the next fall comes later than
    that or never. Output: key, ``run_start``, ``alert_ts``.
    """
    _, alerts = _rising_runs(df, key, order, value, hold, slice_col)
    return alerts.drop("_seg", "_next_fall")


def rising_alert_chain(df: DataFrame, key: str, order: Sequence[str], value: str, hold: str,
                       slice_size: str | None = None) -> DataFrame:
    """Rising alerts with re-arming (the stream processor's ``repeat=True``):
    in a run, the first rise arms an alert at ``t0 + hold``; after it fires,
    the first rise later than the alert time arms the next one, until the run's
    next fall. Only the rises of runs that alert at all are dealt, by (key,
    run), so a hot key is spread over its runs; each run passes in time order
    in chunks, from alert to alert by binary search."""
    ts, lim = order[0], duration_us(hold)
    d, alerts = _rising_runs(df, key, order, value, hold, slice_id(ts, slice_size) if slice_size else None)
    ends = alerts.select(key, "_seg", epoch_us(F.col("_next_fall")).alias("_fall_us"))
    rises = null_safe_join(d.where(F.col("_rise")).select(key, "_seg", epoch_us(F.col(ts)).alias("_t")), ends, [key], "inner",
                           extra=["_seg"]).where(F.col("_t").isNotNull())

    def alerts_of(run, frames):
        out, alert = [], None
        for f in frames:
            t = f["_t"].to_numpy()
            fall = f["_fall_us"].iloc[0]
            while True:
                at = 0 if alert is None else int(np.searchsorted(t, alert, "right"))
                if at == len(t):
                    break
                if fall == fall and fall is not None and t[at] + lim >= fall:    # the fall comes first
                    yield pd.DataFrame(out, columns=[key, "_t", "_a"])
                    return
                alert = int(t[at]) + lim
                out.append((run[0], int(t[at]), alert))
        yield pd.DataFrame(out, columns=[key, "_t", "_a"])

    found = apply_groups(rises, [key, "_seg"], alerts_of, f"{key} {df.schema[key].dataType.simpleString()}, _t long, _a long", order=["_t"])
    return found.select(key, from_epoch_us(F.col("_t")).alias("run_start"), from_epoch_us(F.col("_a")).alias("alert_ts"))


def rising_alert_rows(df: DataFrame, key: str, order: Sequence[str], value: str, hold: str,
                      slice_col: Column | None = None) -> DataFrame:
    """The rising readings behind every alert (the list the alert carries, as
    rows): rises of the alerted run from ``run_start`` to ``alert_ts``. Rows,
    not one list per run, so a long run of a hot key is never one value.
    Joined on (key, segment), which spreads a hot key over its runs."""
    ts = order[0]
    d, alerts = _rising_runs(df, key, order, value, hold, slice_col)
    rises = d.where(F.col("_rise")).drop("_rise", "_fall")
    j = null_safe_join(rises, alerts.drop("_next_fall"), [key], "inner", extra=["_seg"])
    return j.where(F.col(ts).between(F.col("run_start"), F.col("alert_ts"))).drop("_seg")


# ---------------------------------------------------------------- STR5
def split_late(df: DataFrame, ts: str, delay: str, arrival: Sequence[str],
               slice_size: str | None = "1 day") -> tuple[DataFrame, DataFrame]:
    """Split rows by lateness against the watermark *as they arrive*: a row is
    late when its ``ts`` is below (max ts of all earlier arrivals) - ``delay``.

    The running max over arrival order is global; it is computed per arrival
    slice plus a prefix max of slice maxima, never in one task.
    """
    sl = slice_id(arrival[0], slice_size) if slice_size else None
    d = with_running(df, [], arrival, F.col(ts), "max", "_wm_src", include_current=False, slice_col=sl)
    late = F.coalesce(_gap_us(F.col(ts), F.col("_wm_src")) > duration_us(delay), F.lit(False))
    d = d.withColumn("_late", late)
    return d.where(~F.col("_late")).drop("_late", "_wm_src"), d.where(F.col("_late")).drop("_late", "_wm_src")
