"""Keyed upsert into a versioned snapshot (SNK4, SNK6)."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from eventide.plans.inputs import events
from eventide.plans.registry import register
from eventide.session import scratch_path
from eventide.sinks.upsert import read_snapshot, upsert_batch

ORDER = ["ts", "event_id"]


@register("upsert_latest",
          "SELECT user_id, event_id, ts, event_type, value FROM (SELECT *, row_number() OVER "
          "(PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def upsert_latest(spark: SparkSession, sf_dir: str):
    """All events upserted by user in two arrival batches (before / from mid-month), then read back."""
    ev = events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type", "value")
    root = scratch_path(spark, "upsert")
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    upsert_batch(ev.where(F.col("ts") < cut), 0, ["user_id"], ORDER, root)
    upsert_batch(ev.where(~(F.col("ts") < cut) | F.col("ts").isNull()), 1, ["user_id"], ORDER, root)
    return read_snapshot(spark, root, ev.schema).select(*ev.columns)
