"""Bus sink frames (SNK3): the per-row topic and the UTF-8 payload."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def to_topic_frame(df: DataFrame, topic: str = "topic", value: str = "value", prefix: str = "dwd") -> DataFrame:
    """(topic = prefix + topic, key NULL, value UTF-8 bytes): the frame the Kafka
    writer routes by its ``topic`` column."""
    return df.select(F.concat(F.lit(prefix), F.col(topic)).alias("topic"),
                     F.lit(None).cast("binary").alias("key"),
                     F.encode(F.col(value), "UTF-8").alias("value"))


def write_kafka(frame: DataFrame, servers: str, checkpoint: str | None = None, **options):
    """Write a topic frame to the bus (batch or stream)."""
    if frame.isStreaming:
        w = frame.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
        w = w.option("checkpointLocation", checkpoint)
        for k, v in options.items():
            w = w.option(k, v)
        return w.start()
    w = frame.write.format("kafka").option("kafka.bootstrap.servers", servers)
    for k, v in options.items():
        w = w.option(k, v)
    w.save()
    return None
