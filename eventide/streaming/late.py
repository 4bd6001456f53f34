"""Late rows to a side output on a stream (STR5).

Spark drops rows behind the watermark and only counts them. To keep them,
split each micro-batch in ``foreachBatch`` before any stateful step: a row is
late when its event time is below (the largest event time of all earlier
arrivals) - ``delay``. Earlier arrivals are the previous micro-batches (their
maximum is kept in one small record per batch under the query's shared folder,
so a replayed batch reads the same value) and, when an arrival column is
given, the rows of the same batch that arrived before it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from eventide.functions.timefn import duration_us, epoch_us, slice_id
from eventide.operators.sequence import with_running


def _read_max(spark, root: str, batch_id: int):
    """Largest event time of all earlier batches; the first batch has none. A
    missing or unreadable record of a later one is an error: taking it for
    "nothing seen" would let late rows pass."""
    if batch_id <= 0:
        return None
    return spark.read.schema("max_us long").parquet(f"{root}/batch={batch_id - 1}").first()[0]


def split_late_batch(batch: DataFrame, batch_id: int, ts: str, delay: str, root: str,
                     arrival: Sequence[str] | None = None,
                     arrival_slice: str = "1 second") -> tuple[DataFrame, DataFrame]:
    """(on_time, late) rows of one micro-batch; records the running maximum.

    Inside the batch the running maximum over arrival order is sliced by
    ``arrival_slice`` (see :mod:`eventide.operators.sequence`): choose it well
    below the time in which a batch arrives, so that it is spread over tasks.
    The batch is read three times (maximum, on-time, late): persist it."""
    spark = batch.sparkSession
    prev = _read_max(spark, root, batch_id)
    us = epoch_us(F.col(ts))
    if arrival:
        d = with_running(batch, [], list(arrival), us, "max", "_seen", include_current=False,
                         slice_col=slice_id(arrival[0], arrival_slice))
        seen = F.greatest(F.col("_seen"), F.lit(prev)) if prev is not None else F.col("_seen")
    else:
        d = batch.withColumn("_seen", F.lit(prev).cast("long"))
        seen = F.col("_seen")
    d = d.withColumn("_late", F.coalesce(seen - us > duration_us(delay), F.lit(False)))
    batch_max = batch.agg(F.max(us)).first()[0]  # one value per micro-batch
    known = [x for x in (prev, batch_max) if x is not None]
    new_max = max(known) if known else None
    spark.createDataFrame([(new_max,)], "max_us long").write.mode("overwrite").parquet(f"{root}/batch={batch_id}")
    return d.where(~F.col("_late")).drop("_seen", "_late"), d.where(F.col("_late")).drop("_seen", "_late")


def stream_split_late(df: DataFrame, ts: str, delay: str, root: str, checkpoint: str,
                      on_time: Callable[[DataFrame, int], None], late: Callable[[DataFrame, int], None],
                      arrival: Sequence[str] | None = None, trigger: dict | None = None, arrival_slice: str = "1 second"):
    """Start a query that hands each batch's on-time and late rows to two writers."""
    def body(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            ok, lt = split_late_batch(batch, batch_id, ts, delay, root, arrival, arrival_slice)
            on_time(ok, batch_id)
            late(lt, batch_id)
        finally:
            batch.unpersist()

    w = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(body)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
