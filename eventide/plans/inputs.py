"""Inputs of the registered queries: the driver tables, read with pruning-friendly scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventide.functions.timefn import slice_id


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events(event_id, ts timestamp_ntz, user_id, event_type, value, props)``."""
    return table(spark, sf_dir, "events")


def prop_k() -> Column:
    """The item / URL / channel id carried in ``props`` as ``{"k": n}``."""
    return F.get_json_object("props", "$.k").cast("int")


# Per-key sequences always run per (key, time slice), stitched at the slice
# boundaries (eventide.operators.sequence): one plan at every scale. The length
# of a slice is a parameter of the session: long enough that a slice holds many
# rows of a usual key, short enough that one slice of the busiest key fits a
# task (a key with a million rows a second wants "1 second").
SEQ_SLICE = "6 hours"


def seq_slice_size(spark: SparkSession) -> str:
    return spark.conf.get("eventide.sequence.slice", SEQ_SLICE)


def seq_slice(spark: SparkSession, ts: str = "ts") -> Column:
    return slice_id(ts, seq_slice_size(spark))


# DuckDB side: the same id from props.
SQL_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
