"""Event time for streams (STR1, STR2, STR4) and streaming forms of the window operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F


def with_event_time(df: DataFrame, col: str, unit: str | None = None, delay: str = "0 seconds",
                    name: str = "event_time") -> DataFrame:
    """Add ``name`` (TIMESTAMP) from ``col`` and declare it the event time with
    bounded out-of-orderness ``delay`` (``'0 seconds'`` = ascending timestamps).

    ``unit`` = ``'s'`` / ``'ms'`` for epoch numbers; ``None`` for a timestamp
    column (TIMESTAMP_NTZ is read as a UTC wall clock: watermarks need TIMESTAMP).
    """
    c = F.col(col)
    if unit == "s":
        ts = F.timestamp_seconds(c)
    elif unit == "ms":
        ts = F.timestamp_millis(c)
    else:
        # UTC wall clock -> session-zone wall clock -> instant.
        ts = F.convert_timezone(F.lit("UTC"), F.current_timezone(), c.cast("timestamp_ntz")).cast("timestamp")
    return df.withColumn(name, ts).withWatermark(name, delay)


def with_ingest_time(df: DataFrame, name: str = "ingest_time") -> DataFrame:
    """Processing-time attribute: the arrival clock of each micro-batch (STR4)."""
    return df.withColumn(name, F.current_timestamp())


def stream_window_count(df: DataFrame, keys: Sequence[str], ts: str, size: str,
                        slide: str | None = None, name: str = "cnt", pane: bool = False,
                        keep_window: bool = False) -> DataFrame:
    """Windowed count on a watermarked stream (append mode emits closed windows).

    ``pane=True``: two chained aggregates, panes of length ``slide`` first,
    then the windows over the pane ends (valid when slide divides size).
    ``keep_window=True`` keeps the ``window`` struct, which carries the event
    time into a chained aggregate.
    """
    if not pane or not slide:
        win = F.window(ts, size, slide) if slide else F.window(ts, size)
        out = df.groupBy(win.alias("window"), *keys).agg(F.count(F.lit(1)).alias(name))
    else:
        panes = (df.groupBy(F.window(ts, slide).alias("_p"), *keys).agg(F.count(F.lit(1)).alias("_n"))
                   .select(F.window_time("_p").alias("_pt"), *keys, "_n"))
        out = panes.groupBy(F.window("_pt", size, slide).alias("window"), *keys).agg(F.sum("_n").alias(name))
    bounds = [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]
    return out.select(*(["window"] if keep_window else []), *bounds, *keys, name)


def stream_window_agg(df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str | None = None,
                      aggs: Sequence[tuple[str, str, str]] = (("cnt", "count", "*"),)) -> DataFrame:
    """Windowed avg / min / max / sum / count on a watermarked stream (append
    mode emits closed windows). The stream form of ``window_agg``'s plain plan:
    the pane plan would group on a plain column, without a watermark."""
    from eventide.operators.windows import window_agg
    return window_agg(df, keys, ts, size, slide, aggs, plan="plain")


def stream_topn(counts: DataFrame, n: int, score: str, item: str, write: Callable[[DataFrame, int], None],
                checkpoint: str, group: str = "window_end", trigger: dict | None = None):
    """Top-n per window on a stream (TOP1/TOP2), handed to ``write`` per batch.

    ``counts`` emits each window's rows when it closes (append mode), all in one
    micro-batch, so the batch operator ranks it: at most ``n`` rows per window
    leave each task, however many items a window has. Ties go to the smaller
    item, as in the batch form."""
    from eventide.operators.topn import topn_per_group

    def body(batch: DataFrame, batch_id: int) -> None:
        top = topn_per_group(batch, [group], n, score, [item])
        write(top.select(group, F.col("rank").cast("bigint").alias("rank"), item, score), batch_id)

    w = counts.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(body)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def stream_unique_visitors(df: DataFrame, ts: str, user: str, size: str, name: str = "uv") -> DataFrame:
    """Distinct users per window on a stream (AGG12): de-duplicate (window,
    user) in state, then count per window; ``count(DISTINCT)`` is not allowed
    on streams."""
    d = df.where(F.col(user).isNotNull()).select(F.window(ts, size).alias("_w"), F.col(user)).dropDuplicates(["_w", user])
    out = d.groupBy("_w").agg(F.count(F.lit(1)).alias(name))
    return out.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), name)


def stream_flag_repeats(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str,
                        name: str = "seen_before") -> DataFrame:
    """Streaming "seen before?" (AGG13): every row, in time order, with whether
    its key occurred earlier; the state holds one flag per key."""
    from eventide.streaming import processors as P
    from eventide.streaming.rules import _key_fields
    return P.run_ordered(df, list(keys), ts, tiebreak, [], P.RepeatProcessor(_key_fields(df, keys), name=name))


def stream_flag_first(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Streaming "seen before?" (AGG13): keep only the first row per key
    within the watermark (later copies are the repeats)."""
    return df.dropDuplicatesWithinWatermark(list(keys))



def stream_running_min(df: DataFrame, key: str, value: str, name: str = "running_min") -> DataFrame:
    """Running minimum per key on a stream (AGG9): one updated row per key and
    micro-batch, for output mode ``update``."""
    return df.groupBy(key).agg(F.min(value).alias(name))
