
import os
import random
import time
import uuid

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from eventide.functions.timefn import duration_us, slice_id
from eventide.operators.analytic import jump_flag
from eventide.operators.joins import interval_match
from eventide.operators.patterns import consecutive, missing_followup, rate_cap, rising_alert
from eventide.operators.windows import unique_visitors, window_count
from eventide.session import scratch_path
from eventide.sinks.upsert import latest_per_key, read_snapshot, stream_upsert
from eventide.streaming.event_time import (stream_topn, stream_unique_visitors, stream_window_count,
                                           with_event_time)
from eventide.streaming.processors import (ClickCapProcessor, ConsecutiveProcessor, JumpProcessor,
                                           MissingFollowupProcessor, RisingAlertProcessor, run_ordered)

SENTINEL_USER = -1
ORDER = ["ts", "event_id"]


@pytest.fixture(scope="module")
def batch(spark):
    return spark.read.parquet(f"{SF001}/events.parquet")


@pytest.fixture(scope="module")
def stream_dir(spark, batch):
    """Events in 4 files by time (rows shuffled inside each file), then a sentinel far in the future."""
    d = scratch_path(spark, "stream-src")
    os.makedirs(d, exist_ok=True)
    pdf = batch.toPandas().sort_values(["ts", "event_id"])
    rnd = random.Random(3)
    chunks = [pdf.iloc[i * len(pdf) // 4:(i + 1) * len(pdf) // 4] for i in range(4)]
    # One sentinel row per event type: filters are pushed below the watermark
    # node, so every filtered stream needs its own row to close its windows.
    sentinel = pdf.groupby("event_type").head(1).copy()
    sentinel["event_id"] = range(10**9, 10**9 + len(sentinel))
    sentinel["user_id"] = SENTINEL_USER
    sentinel["props"] = '{"k": 0}'
    sentinel["ts"] = pdf["ts"].max() + pd.Timedelta(days=60)
    schema = pa.schema([("event_id", pa.int64()), ("ts", pa.timestamp("us")), ("user_id", pa.int64()),
                        ("event_type", pa.string()), ("value", pa.float64()), ("props", pa.string())])
    for i, ch in enumerate([*chunks, sentinel]):
        ch = ch.sample(frac=1, random_state=rnd.randint(0, 10**6))
        p = os.path.join(d, f"part-{i:03d}.parquet")
        pq.write_table(pa.Table.from_pandas(ch, schema=schema, preserve_index=False), p)
        os.utime(p, (time.time() + i, time.time() + i))
    return d


def source(spark, stream_dir, batch, delay="0 seconds"):
    s = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(stream_dir)
    return with_event_time(s, "ts", delay=delay)


def collect_stream(spark, df, mode="append"):
    name = "q_" + uuid.uuid4().hex[:10]
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", scratch_path(spark, "ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.sql(f"SELECT * FROM {name}")


def rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_window_count_and_topn(spark, stream_dir, batch):
    ev = source(spark, stream_dir, batch).where(F.col("event_type") == "view") \
        .withColumn("item_id", F.get_json_object("props", "$.k").cast("int"))
    counts = stream_window_count(ev, ["item_id"], "event_time", "1 hour", "5 minutes")
    got = collect_stream(spark, counts)
    b = batch.where(F.col("event_type") == "view").withColumn("item_id", F.get_json_object("props", "$.k").cast("int"))
    want = window_count(b, ["item_id"], "ts", "1 hour", "5 minutes")
    cols = ["window_end", "item_id", "cnt"]
    g = got.withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))
    assert rows(g, cols) == rows(want, cols)


def test_chained_topn(spark, stream_dir, batch):
    from eventide.operators.topn import topn_per_group
    ev = source(spark, stream_dir, batch).where(F.col("event_type") == "view") \
        .withColumn("item_id", F.get_json_object("props", "$.k").cast("int"))
    counts = stream_window_count(ev, ["item_id"], "event_time", "1 hour", "5 minutes")
    out = scratch_path(spark, "topn")
    q = stream_topn(counts, 5, "cnt", "item_id", lambda top, i: top.write.mode("overwrite").parquet(f"{out}/batch={i}"),
                    scratch_path(spark, "ckpt"), trigger={"availableNow": True})
    q.awaitTermination()
    got = spark.read.parquet(out)
    b = batch.where(F.col("event_type") == "view").withColumn("item_id", F.get_json_object("props", "$.k").cast("int"))
    want = topn_per_group(window_count(b, ["item_id"], "ts", "1 hour", "5 minutes"), ["window_end"], 5, "cnt",
                          ["item_id"])
    g = got.withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))
    cols = ["window_end", "rank", "item_id", "cnt"]
    assert rows(g, cols) == rows(want, cols)


def test_pane_stream_equals_plain_stream(spark, stream_dir, batch):
    ev = source(spark, stream_dir, batch)
    a = collect_stream(spark, stream_window_count(ev, ["event_type"], "event_time", "1 hour", "5 minutes"))
    ev2 = source(spark, stream_dir, batch)
    b = collect_stream(spark, stream_window_count(ev2, ["event_type"], "event_time", "1 hour", "5 minutes", pane=True))
    cols = ["window_start", "window_end", "event_type", "cnt"]
    assert rows(a, cols) == rows(b, cols) and a.count() > 0


def test_unique_visitors(spark, stream_dir, batch):
    ev = source(spark, stream_dir, batch).where(F.col("event_type") == "view")
    got = collect_stream(spark, stream_unique_visitors(ev, "event_time", "user_id", "1 hour"))
    want = unique_visitors(batch.where(F.col("event_type") == "view"), "ts", "user_id", "1 hour")
    g = got.withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))
    assert rows(g, ["window_end", "uv"]) == rows(want, ["window_end", "uv"])


def test_interval_join_full_outer(spark, stream_dir, batch):
    from eventide.streaming.joins import stream_interval_match
    ev = source(spark, stream_dir, batch)
    pay = ev.where(F.col("event_type") == "purchase")
    clk = ev.where(F.col("event_type") == "click")
    j = stream_interval_match(pay, clk, "user_id", "event_time", "event_time", "1 hour", ["event_id"], ["event_id"])
    got = collect_stream(spark, j) \
        .where("coalesce(l_event_id, 0) < 1000000000 AND coalesce(r_event_id, 0) < 1000000000")
    b = batch.select("event_id", "ts", "user_id", "event_type")
    m, lo, ro = interval_match(b.where(F.col("event_type") == "purchase"), b.where(F.col("event_type") == "click"),
                               "user_id", "ts", "ts", "1 hour", ["event_id"], ["event_id"])
    assert rows(got.where("l_event_id IS NOT NULL AND r_event_id IS NOT NULL"), ["l_event_id", "r_event_id"]) == \
        rows(m, ["l_event_id", "r_event_id"])
    assert rows(got.where("r_event_id IS NULL"), ["l_event_id"]) == rows(lo, ["l_event_id"])
    assert rows(got.where("l_event_id IS NULL"), ["r_event_id"]) == rows(ro, ["r_event_id"])


KEY = [("user_id", "long")]


def test_click_cap_processor(spark, stream_dir, batch):
    ev = source(spark, stream_dir, batch)
    day = F.floor(F.unix_micros("event_time") / F.lit(86_400_000_000)).cast("long")
    proc = ClickCapProcessor([("user_id", "long"), ("event_type", "string")], 0)
    got = collect_stream(spark, run_ordered(ev, ["user_id", "event_type"], "event_time", "event_id", [day.alias("day")],
                                            proc)).where(F.col("user_id") != SENTINEL_USER)
    passed, warn = rate_cap(batch, ["user_id", "event_type"], "ts", ORDER, 0)
    assert rows(got.where("output = 'pass'"), ["event_id"]) == rows(passed, ["event_id"])
    assert got.where("output = 'warn'").count() == warn.count()


def test_missing_followup_processor(spark, stream_dir, batch):
    ev = source(spark, stream_dir, batch).where(F.col("event_type").isin("signup", "purchase"))
    kind = F.when(F.col("event_type") == "signup", 1).otherwise(2).alias("kind")
    proc = MissingFollowupProcessor(KEY, duration_us("1 day"))
    got = collect_stream(spark, run_ordered(ev, ["user_id"], "event_time", "event_id", [kind], proc))
    want = missing_followup(batch, "user_id", ORDER, F.col("event_type") == "signup",
                            F.col("event_type") == "purchase", "1 day")
    assert rows(got, ["event_id"]) == rows(want, ["event_id"])


def test_consecutive_processor(spark, stream_dir, batch):
    ev = source(spark, stream_dir, batch)
    proc = ConsecutiveProcessor(KEY, 2, duration_us("1 day"))
    got = collect_stream(spark, run_ordered(ev, ["user_id"], "event_time", "event_id",
                                            [(F.col("event_type") == "error").alias("c")], proc))
    want = consecutive(batch, "user_id", ORDER, F.col("event_type") == "error", 2, "1 day")
    pairs = want.select(F.col("prev1.event_id").alias("a"), F.col("event_id").alias("b"))
    assert rows(got, ["first_event_id", "event_id"]) == rows(pairs, ["a", "b"])
    assert got.count() > 0


def test_jump_processor(spark, stream_dir, batch):
    ev = source(spark, stream_dir, batch)
    proc = JumpProcessor(KEY, 5.0)
    got = collect_stream(spark, run_ordered(ev, ["user_id"], "event_time", "event_id",
                                            [F.col("value").alias("v")], proc))
    want = jump_flag(batch, "user_id", ORDER, "value", 5.0)
    assert rows(got, ["event_id", "prev_value", "jumped"]) == rows(want, ["event_id", "prev_value", "jumped"])


def test_rising_alert_processor(spark, stream_dir, batch):
    ev = source(spark, stream_dir, batch)
    proc = RisingAlertProcessor(KEY, duration_us("5 hours"))
    got = collect_stream(spark, run_ordered(ev, ["user_id"], "event_time", "event_id",
                                            [F.col("value").alias("v")], proc))
    want = rising_alert(batch, "user_id", ORDER, "value", "5 hours", slice_col=slice_id("ts", "1 day"))
    g = got.select("user_id", F.timestamp_micros("run_start_us").cast("timestamp_ntz").alias("run_start"),
                   F.timestamp_micros("alert_us").cast("timestamp_ntz").alias("alert_ts"))
    # the sentinel moves the watermark past every alert time, so all have fired
    assert rows(g, ["user_id", "run_start", "alert_ts"]) == rows(want, ["user_id", "run_start", "alert_ts"])
    assert g.count() > 0


def test_stream_upsert_survives_restart(spark, stream_dir, batch):
    root, ckpt = scratch_path(spark, "upsert"), scratch_path(spark, "upsert-ckpt")
    s = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(stream_dir)
    s = s.select("user_id", "event_id", "ts", "value")
    q = stream_upsert(s, ["user_id"], ORDER, root, ckpt, buckets=8, trigger={"processingTime": "1 second"})
    deadline = time.time() + 120
    while (q.lastProgress is None or q.lastProgress["batchId"] < 1) and time.time() < deadline:
        time.sleep(0.5)
    q.stop()  # stop mid-stream, as a lost driver would
    q = stream_upsert(s, ["user_id"], ORDER, root, ckpt, buckets=8, trigger={"availableNow": True})
    q.awaitTermination()
    snap = read_snapshot(spark, root, s.schema).where(F.col("user_id") != SENTINEL_USER)
    want = latest_per_key(batch.select("user_id", "event_id", "ts", "value"), ["user_id"], ORDER)
    assert rows(snap, ["user_id", "event_id"]) == rows(want, ["user_id", "event_id"])


def test_rising_alert_repeat_processor_equals_chain(spark, stream_dir, batch):
    from eventide.operators.patterns import rising_alert_chain
    ev = source(spark, stream_dir, batch)
    proc = RisingAlertProcessor(KEY, duration_us("5 hours"), repeat=True)
    got = collect_stream(spark, run_ordered(ev, ["user_id"], "event_time", "event_id",
                                            [F.col("value").alias("v")], proc))
    want = rising_alert_chain(batch, "user_id", ORDER, "value", "5 hours")
    g = got.select("user_id", F.timestamp_micros("run_start_us").cast("timestamp_ntz").alias("run_start"),
                   F.timestamp_micros("alert_us").cast("timestamp_ntz").alias("alert_ts"))
    assert rows(g, ["user_id", "run_start", "alert_ts"]) == rows(want, ["user_id", "run_start", "alert_ts"])
    assert want.count() > rising_alert(batch, "user_id", ORDER, "value", "5 hours").count()
