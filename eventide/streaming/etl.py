"""

Each micro-batch is persisted once and written twice: dimension rows are upserted
into the keyed snapshot (SNK6 via SNK4) and fact rows become ``dwd<topic>``
frames (SNK3), written to the bus when ``servers`` is given, else to a
directory per batch. The snapshot and the directory are idempotent by batch id;
the bus is at-least-once (a replayed batch sends its facts again).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from eventide.functions.jsonfn import is_json_object
from eventide.operators.routing import route
from eventide.sinks.bus import to_topic_frame, write_kafka
from eventide.sinks.upsert import upsert_batch

# The topics routed to the dimension sink by default.
DIM_TOPICS = ["based", "basewebsite", "membervip"]


def etl_batch(batch: DataFrame, batch_id: int, dim_topics: Sequence[str] | None, dim_keys: Sequence[str],
              dim_order: Sequence[str], dim_root: str, fact_root: str | None = None,
              servers: str | None = None, prefix: str = "dwd") -> None:
    valid = batch.where(is_json_object(F.col("value"))).persist()
    try:
        dim, fact = route(valid, "topic", DIM_TOPICS if dim_topics is None else dim_topics)
        upsert_batch(dim, batch_id, dim_keys, dim_order, dim_root)
        frame = to_topic_frame(fact, prefix=prefix)
        if servers:
            write_kafka(frame, servers)
        else:
            frame.write.mode("overwrite").parquet(f"{fact_root}/batch={batch_id}")
    finally:
        valid.unpersist()


def run_etl(records: DataFrame, checkpoint: str, dim_topics: Sequence[str], dim_keys: Sequence[str],
            dim_order: Sequence[str], dim_root: str, fact_root: str | None = None,
            servers: str | None = None, trigger: dict | None = None):
    """``records``: a stream of (topic, value text, ...), e.g. from
    :func:`eventide.sources.bus.scan_kafka_topics`."""
    w = records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda b, i: etl_batch(b, i, dim_topics, dim_keys, dim_order, dim_root, fact_root, servers))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
