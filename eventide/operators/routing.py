"""Splitting, side outputs, routing and two-input mapping (RTE1-RTE3, SET1, FLT1, FLT2).

A side output is just another filtered projection of the same input; Spark
shares the scan when both are written in one job (e.g. from ``foreachBatch``
over a persisted batch).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def branch_label(branches: Mapping[str, Column], default: str | None = None) -> Column:
    """The first label whose condition holds (in mapping order), else ``default``."""
    out = None
    for label, cond in branches.items():
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default)) if default is not None else out


def split(df: DataFrame, branches: Mapping[str, Column], default: str | None = None,
          label_col: str = "branch") -> dict[str, DataFrame]:
    """Labelled sub-streams: every row goes to the first matching branch (RTE1)."""
    d = df.withColumn(label_col, branch_label(branches, default))
    labels = list(branches) + ([default] if default is not None else [])
    return {lab: d.where(F.col(label_col) == lab) for lab in labels}


def side_output(df: DataFrame, cond: Column, side_expr: Column, side_cols: Sequence[str] = (),
                name: str = "alarm") -> tuple[DataFrame, DataFrame]:
    """Every row to the main output; rows matching ``cond`` also produce
    ``side_expr`` on the side output (RTE2)."""
    return df, df.where(cond).select(*side_cols, side_expr.alias(name))


def route_label(col: str, dim_values: Sequence[str], dim: str = "dim", fact: str = "fact") -> Column:
    """The branch of :func:`route` as a column: one scan labels every row."""
    return F.when(F.col(col).isin(list(dim_values)), F.lit(dim)).otherwise(F.lit(fact))


def route(df: DataFrame, col: str, dim_values: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Dimension rows (``col`` in ``dim_values``) and fact rows (the rest) (RTE3)."""
    is_dim = F.col(col).isin(list(dim_values))
    return df.where(is_dim), df.where(~is_dim | F.col(col).isNull())


def connect_map(left: DataFrame, right: DataFrame, lmap: Sequence[Column],
                rmap: Sequence[Column]) -> DataFrame:
    """Map each input with its own projection and merge into one output (SET1);
    columns missing on one side are NULL."""
    return left.select(*lmap).unionByName(right.select(*rmap), allowMissingColumns=True)
