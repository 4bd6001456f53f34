"""Ordered-sequence building blocks: neighbours (lag / lead) and running aggregates.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to one
task. With one key holding a third of all rows that task is the whole job. The
*sliced* forms below count the rows of each key first. Calm keys (up to
``HOT_ROWS`` rows) stay whole; a hot key is cut into time slices, which are
stitched from per-slice summaries:

* the window over (key, slice) is the only full shuffle; the slice of a calm
  key is a constant, so for those it is the plain window;
* the count per key is a partial aggregate over the key columns alone. The hot
  keys number at most rows / ``HOT_ROWS``, so they are broadcast;
* summaries (last rows, totals) are made of hot keys only, one per slice,
  pre-aggregated before they shuffle; where no key is hot they are empty;
* the carry from earlier slices is a window over the summaries, joined back on
  (key, slice), which keeps the big side's partitioning.

One plan at every size: the data decide which keys are cut, at run time.
:func:`mark_hot` finds them once for several steps on the same keys.

``slice_col`` must be monotone non-decreasing in ``order`` (a time slice of the
leading order column); its length is a parameter, so that one slice of the
busiest key fits a task: hours for calm keys, milliseconds for a burst. Without
``slice_col`` the plain window is used (for tests of equivalence).

The sliced forms group on non-nullable surrogates of the keys (value with a
typed default, plus a NULL flag) and a null-safe slice id: NULL keys form one
group as in a plain window, and the carry join is null-safe.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.session import ensure_checkpoint_dir

#: Rows of a key from which its time slices go to different tasks.
HOT_ROWS = 1_000_000

_S = "_slice"
_HOT = "_hot_slice"    # time slice of the rows of hot keys, NULL for all others
_NULL_SLICE = 1 << 62  # slice of rows with a NULL order value: before all others


def _key_cols(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Non-nullable surrogate columns for ``keys``: ``coalesce(key, default)``
    plus ``isnull(key)`` per key (NULL keys stay one group, apart from the
    default value), so joins on them are null-safe, no NOT NULL filter is
    inferred, and a numeric key keeps the fast prefix sort. Keys of types
    without a natural default go through one struct."""
    from pyspark.sql import types as T

    if not keys:
        # one group, under a key the optimizer does not fold: the rows are
        # partitioned by their slices, only the per-slice summaries meet
        return df.withColumn("_k0", F.pmod(F.col(_S), F.lit(1))) if _S in df.columns else df.withColumn("_k0", F.lit(0)), ["_k0"]
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for i, k in enumerate(keys):
        t = types.get(k)
        if isinstance(t, T.NumericType):
            default = F.lit(0).cast(t)
        elif isinstance(t, T.StringType):
            default = F.lit("")
        elif isinstance(t, T.BooleanType):
            default = F.lit(False)
        elif isinstance(t, T.DateType):
            default = F.lit("1970-01-01").cast(t)
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            default = F.lit("1970-01-01 00:00:00").cast(t)
        else:
            return df.withColumn("_k0", F.struct(*[F.col(x) for x in keys])), ["_k0"]
        df = df.withColumn(f"_kv{i}", F.coalesce(F.col(k), default)).withColumn(f"_kn{i}", F.col(k).isNull())
        cols += [f"_kv{i}", f"_kn{i}"]
    return df, cols


def mark_hot(df: DataFrame, keys: Sequence[str], slice_col: Column | None, at_once: bool = False) -> DataFrame:
    """``df`` with the time slice of hot keys' rows, for several sliced steps
    over the same keys; they pass it on, and :func:`unmarked` takes it off.
    ``at_once`` counts the keys now, so that steps do not read the input for it
    again, and keeps the hot ones in the checkpoint folder."""
    if slice_col is None or _HOT in df.columns:
        return df
    part = F.coalesce(slice_col, F.lit(-_NULL_SLICE)).cast("long")
    if not keys:
        return df.withColumn(_HOT, part)
    d, kc = _key_cols(df, keys)
    hot = (d.groupBy(*kc).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT_ROWS)
           .select(*kc, F.lit(True).alias("_is_hot")))
    if at_once:
        ensure_checkpoint_dir(df.sparkSession)
        hot = hot.checkpoint()
    return d.join(F.broadcast(hot), kc, "left").withColumn(_HOT, F.when(F.col("_is_hot"), part)).drop("_is_hot", *kc)


def unmarked(df: DataFrame) -> DataFrame:
    return df.drop(_HOT)


def _sliced(df: DataFrame, keys: Sequence[str], slice_col: Column) -> tuple[DataFrame, list[str], list[str]]:
    """The rows with their slice, the key columns, and the columns to drop at the end."""
    mine = [] if _HOT in df.columns else [_HOT]
    df = mark_hot(df, keys, slice_col)
    df, kc = _key_cols(df.withColumn(_S, F.coalesce(_HOT, F.lit(0).cast("long"))), keys)
    return df, kc, [*kc, _S, *mine]


def _cut(src: DataFrame) -> DataFrame:
    """The rows that summaries are made of."""
    return src.where(F.col(_HOT).isNotNull())


def _by_slice(reverse: bool) -> Column:
    return F.col(_S).desc() if reverse else F.col(_S).asc()


def _ordering(order: Sequence[str], reverse: bool) -> list[Column]:
    return [F.col(o).desc() if reverse else F.col(o).asc() for o in order]


def _spec(part: Sequence[str]):
    return Window.partitionBy(*part) if part else Window.partitionBy(F.lit(0))


def with_neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    cols: Sequence[str], n: int = 1, *, direction: str = "prev",
                    prefix: str | None = None, slice_col: Column | None = None) -> DataFrame:
    """Add struct columns ``{prefix}1 .. {prefix}n`` holding ``cols`` of the row
    1..n positions before (``direction='prev'``) or after (``'next'``) each row,
    within ``keys`` in ``order``. Missing neighbours are NULL.
    """
    reverse = direction == "next"
    prefix = prefix or direction
    value = F.struct(*[F.col(c) for c in cols])
    if slice_col is None:
        w = _spec(keys).orderBy(*_ordering(order, reverse))
        for i in range(1, n + 1):
            df = df.withColumn(f"{prefix}{i}", F.lag(value, i).over(w))
        return df

    src, kc, mine = _sliced(df, keys, slice_col)
    cut = _cut(src)
    w = Window.partitionBy(*kc, _S).orderBy(*_ordering(order, reverse))
    base = src.withColumn("_pos", F.row_number().over(w))
    for i in range(1, n + 1):
        base = base.withColumn(f"_in{i}", F.lag(value, i).over(w))

    if n == 1:
        # Last row of every slice (first when reversed): a hash aggregate with
        # partial aggregation, no sort; the carry is the previous slice's.
        pick = F.min_by if reverse else F.max_by
        key = F.struct(*[F.col(o) for o in order])
        last = cut.groupBy(*kc, _S).agg(pick(value, key).alias("_t"))
        carry = last.select(*kc, _S, F.array(F.lag("_t", 1).over(Window.partitionBy(*kc).orderBy(_by_slice(reverse))))
                            .alias("_carry"))
    else:
        # Last n rows of every slice (first n when reversed), nearest-to-the-end
        # first, from the input: ``row_number() <= n`` is planned as a partial
        # WindowGroupLimit before its shuffle, so at most n rows per (key,
        # slice) leave each map task.
        wd = Window.partitionBy(*kc, _S).orderBy(*_ordering(order, not reverse))
        tail = (cut.withColumn("_rd", F.row_number().over(wd))
                .where(F.col("_rd") <= n)
                .groupBy(*kc, _S)
                .agg(F.sort_array(F.collect_list(F.struct("_rd", value.alias("v")))).alias("_t"))
                .select(*kc, _S, F.transform("_t", lambda x: x["v"]).alias("_t")))
        # Carry: the n rows just before the slice, nearest first. Each non-empty
        # slice holds at least one row, so n earlier slices are always enough.
        wk = Window.partitionBy(*kc).orderBy(_by_slice(reverse)).rowsBetween(-n, -1)
        carry = tail.select(*kc, _S, F.slice(F.flatten(F.reverse(F.collect_list("_t").over(wk))), 1, n)
                            .alias("_carry"))

    out = base.join(carry, on=[*kc, _S], how="left")
    for i in range(1, n + 1):
        out = out.withColumn(
            f"{prefix}{i}",
            F.when(F.col("_pos") > i, F.col(f"_in{i}"))
             .otherwise(F.get(F.col("_carry"), F.lit(i) - F.col("_pos"))))
    return out.drop(*mine, "_pos", "_carry", *[f"_in{i}" for i in range(1, n + 1)])


_MERGE = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.sum}
_COMBINE = {"min": F.least, "max": F.greatest}


@dataclass(frozen=True)
class Running:
    """``name`` = running ``fn`` (min, max, sum, count) of ``value`` over the rows
    before each row (after it when ``reverse``), optionally including it."""

    name: str
    value: Column
    fn: str
    include_current: bool = True
    reverse: bool = False


def with_runnings(df: DataFrame, keys: Sequence[str], order: Sequence[str], specs: Sequence[Running],
                  slice_col: Column | None = None) -> DataFrame:
    """Add several running values in one pass: one shuffle by (key, slice), one
    summary per slice of a hot key, one carry join, whatever the number and directions."""
    agg = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.count}

    def frame(w, spec):
        return w.rowsBetween(Window.unboundedPreceding, Window.currentRow if spec.include_current else -1)

    if slice_col is None:
        for s in specs:
            df = df.withColumn(s.name, agg[s.fn](s.value).over(frame(_spec(keys).orderBy(*_ordering(order, s.reverse)), s)))
        return df

    src, kc, mine = _sliced(df, keys, slice_col)
    base, totals, carries = src, [], []
    for i, s in enumerate(specs):
        w = Window.partitionBy(*kc, _S).orderBy(*_ordering(order, s.reverse))
        base = base.withColumn(f"_in{i}", agg[s.fn](s.value).over(frame(w, s)))
        # one total per slice: a partial aggregate before its (small) shuffle
        totals.append(agg[s.fn](s.value).alias(f"_tot{i}"))
        wk = Window.partitionBy(*kc).orderBy(_by_slice(s.reverse)).rowsBetween(Window.unboundedPreceding, -1)
        carries.append(_MERGE[s.fn](f"_tot{i}").over(wk).alias(f"_carry{i}"))
    carry = _cut(src).groupBy(*kc, _S).agg(*totals).select(*kc, _S, *carries)
    out = base.join(carry, on=[*kc, _S], how="left")
    for i, s in enumerate(specs):
        here, before = F.col(f"_in{i}"), F.col(f"_carry{i}")
        if s.fn in _COMBINE:
            res = _COMBINE[s.fn](here, before)
        elif s.fn == "count":
            res = here + F.coalesce(before, F.lit(0))
        else:
            res = F.when(here.isNull(), before).when(before.isNull(), here).otherwise(here + before)
        out = out.withColumn(s.name, res)
    return out.drop(*mine, *[f"_{x}{i}" for x in ("in", "carry") for i in range(len(specs))])


def with_running(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column,
                 fn: str, name: str, *, include_current: bool = True, reverse: bool = False,
                 slice_col: Column | None = None) -> DataFrame:
    """One :class:`Running` value.

    Reverse running min over later rows of ``when(cond, struct(ts, id, ...))``
    gives "the next row satisfying cond"; forward max gives "the previous one".
    """
    return with_runnings(df, keys, order, [Running(name, value, fn, include_current, reverse)], slice_col)


def next_where(df: DataFrame, keys: Sequence[str], order: Sequence[str], cond: Column,
               cols: Sequence[str], name: str, slice_col: Column | None = None) -> DataFrame:
    """Add ``name`` = struct(order..., cols...) of the first *later* row (strictly
    after in ``order``) of the same key for which ``cond`` holds, else NULL."""
    fields = list(dict.fromkeys([*order, *cols]))
    v = F.when(cond, F.struct(*[F.col(c) for c in fields]))
    return with_running(df, keys, order, v, "min", name, include_current=False,
                        reverse=True, slice_col=slice_col)


def prev_where(df: DataFrame, keys: Sequence[str], order: Sequence[str], cond: Column,
               cols: Sequence[str], name: str, slice_col: Column | None = None) -> DataFrame:
    """Mirror of :func:`next_where`: the last *earlier* row satisfying ``cond``."""
    fields = list(dict.fromkeys([*order, *cols]))
    v = F.when(cond, F.struct(*[F.col(c) for c in fields]))
    return with_running(df, keys, order, v, "max", name, include_current=False,
                        reverse=False, slice_col=slice_col)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
                   extra: Sequence[str] = ()) -> DataFrame:
    """Join on ``keys`` (plus ``extra`` plain columns) where NULL keys match
    each other, as rows of one group do in a window or aggregate. Both sides
    get the same non-nullable surrogates (see :func:`_key_cols`), so the join
    stays an equi-join; the right side's key columns are dropped."""
    left, kc = _key_cols(left, keys)
    right, _ = _key_cols(right, keys)
    right = right.drop(*keys)
    return left.join(right, on=[*kc, *extra], how=how).drop(*kc)
