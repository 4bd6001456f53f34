"""Analytic (over-row) operators: WIN1-WIN3 and the running minimum AGG9."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventide.operators.sequence import Running, with_neighbours, with_runnings


def over_rows(df: DataFrame, key: str, order: Sequence[str], value: str, preceding: int = 2,
              prefix: str = "", slice_col: Column | None = None) -> DataFrame:
    """count / avg / sum / min / max of ``value`` over the current row and the
    ``preceding`` rows before it in ``order`` per ``key`` (WIN1, WIN2)."""
    d = with_neighbours(df, [key], order, [value], preceding, direction="prev",
                        prefix="_ov", slice_col=slice_col)
    vals = F.filter(F.array(F.col(value), *[F.col(f"_ov{i}")[value] for i in range(1, preceding + 1)]),
                    lambda x: x.isNotNull())
    total = F.aggregate(vals, F.lit(0.0), lambda a, x: a + x)
    n = F.size(vals)
    return (d.withColumn(f"{prefix}cnt", n.cast("long"))
             .withColumn(f"{prefix}sum", F.when(n > 0, total))
             .withColumn(f"{prefix}avg", F.when(n > 0, total / n))
             .withColumn(f"{prefix}min", F.array_min(vals))
             .withColumn(f"{prefix}max", F.array_max(vals))
             .drop(*[f"_ov{i}" for i in range(1, preceding + 1)]))


def jump_flag(df: DataFrame, key: str, order: Sequence[str], value: str, limit: float,
              first_prev: float = 0.0, slice_col: Column | None = None) -> DataFrame:
    """Compare each value with the previous one of its key (the first row with
    ``first_prev``); ``jumped`` when ``abs(diff) > limit`` (WIN3)."""
    d = with_neighbours(df, [key], order, [value], 1, prefix="_jp", slice_col=slice_col)
    # no earlier row: first_prev; an earlier row without a value: NULL
    prev = F.when(F.col("_jp1").isNull(), F.lit(first_prev)).otherwise(F.col("_jp1")[value])
    return (d.withColumn("prev_value", prev)
             .withColumn("jumped", F.abs(F.col(value) - prev) > F.lit(limit))
             .drop("_jp1"))


def running_min(df: DataFrame, key: str, order: Sequence[str], value: str, name: str = "running_min",
                slice_col: Column | None = None, before: str | None = None) -> DataFrame:
    """One output row per input row: minimum of ``value`` so far for the key
    (AGG9); ``before`` names a column for the number of earlier rows."""
    specs = [Running(name, F.col(value), "min")]
    if before:
        specs.append(Running(before, F.lit(1), "count", include_current=False))
    return with_runnings(df, [key], order, specs, slice_col)
