"""File sinks: insert into a CSV file table (SNK2) and print (SNK1)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from eventide.sources.files import TS_FORMAT


def insert_csv(df: DataFrame, path: str, mode: str = "append", sep: str = ",") -> None:
    """Append the rows of ``df`` to a CSV file table at ``path`` (no header)."""
    (df.write.mode(mode).option("sep", sep)
       .option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT).csv(path))


def stream_csv(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Streaming form of :func:`insert_csv` (append mode, exactly once by checkpoint)."""
    w = (df.writeStream.format("csv").option("path", path).option("checkpointLocation", checkpoint)
         .option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT))
    w = w.outputMode("append")
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def to_console(df: DataFrame, label: str | None = None, n: int = 20):
    """Print rows with an optional label; streams get a console sink."""
    if df.isStreaming:
        return df.writeStream.format("console").option("truncate", False).queryName(label).start()
    if label:
        print(label)
    df.show(n, truncate=False)
    return None
