"""Extra lateness, two inputs and the processing clock on streams."""

import os
import random
import time

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from test_streaming import batch, collect_stream, source, stream_dir  # noqa: F401  (fixtures)
from eventide.functions.timefn import duration_us
from eventide.operators.joins import interval_match
from eventide.operators.userfn import Average, RowCount
from eventide.session import scratch_path
from eventide.streaming.clock import stream_rise_clock
from eventide.streaming.event_time import with_event_time
from eventide.streaming.lateness import LatenessProcessor, stream_window_lateness
from eventide.streaming.two_inputs import stream_match

SCHEMA = "event_id long, ts timestamp_ntz, k string, v double"
T0 = pd.Timestamp("2024-01-01")
S = 1_000_000
T0_US = T0.value // 1000


def write(d, i, rows):
    """One file: rows ``(id, seconds, key, value)``."""
    os.makedirs(d, exist_ok=True)
    pdf = pd.DataFrame([(a, T0 + pd.Timedelta(seconds=s), k, v) for a, s, k, v in rows], columns=["event_id", "ts", "k", "v"])
    schema = pa.schema([("event_id", pa.int64()), ("ts", pa.timestamp("us")), ("k", pa.string()), ("v", pa.float64())])
    p = os.path.join(d, f"part-{i:03d}.parquet")
    pq.write_table(pa.Table.from_pandas(pdf, schema=schema, preserve_index=False), p)
    os.utime(p, (time.time() + i, time.time() + i))


def read(spark, d, delay="10 seconds"):
    return with_event_time(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(d), "ts", delay=delay)


def run(spark, files, agg, size, lateness, slide=None, delay="10 seconds"):
    d = scratch_path(spark, "late-src")
    for i, rows in enumerate(files):
        write(d, i, rows)
    return collect_stream(spark, stream_window_lateness(read(spark, d, delay), ["k"], "event_time", "event_id", agg, size, lateness, slide)).collect()


def test_a_late_row_corrects_its_window_and_a_later_one_goes_aside(spark):
    files = [[(1, 5, "a", 1.0), (2, 55, "a", 3.0)],
             [(3, 85, "a", 5.0)],                           # watermark 75 s: the first minute is sent
             [(4, 59, "a", 8.0)],                           # 16 s behind the watermark: corrects it
             [(5, 100, "a", 0.0)],                          # watermark 90 s: the first minute's extra 20 s are over
             [(6, 58, "a", 9.0), (7, 95, "a", 2.0)],        # 32 s behind: aside; the other one is on time
             [(9, 1000, "a", 0.0)]]
    got = run(spark, files, Average("v"), "1 minute", "20 seconds")
    windows = [((r.window_start_us - T0_US) // S, r.version, r.avg) for r in got if r.output == "window"]
    assert sorted(windows) == [(0, 1, 2.0), (0, 2, 4.0), (60, 1, 7 / 3)]
    assert [(r.event_id, r.t_us - T0_US) for r in got if r.output == "late"] == [(6, 58 * S)]


def simulate(files, size, slide, lateness, delay):
    """The same by brute force, file by file."""
    wm, top, windows, sent, out = None, None, {}, {}, []
    for rows in [*files, []]:                # the last one is the batch without data that ends the stream
        changed = set()
        for (k, w), n in list(windows.items()):
            if wm is not None and w + size <= wm and (k, w) not in sent:
                sent[k, w] = 1
                out.append(("window", k, w, 1, n))
        for i, s, k, _ in rows:
            open_ = []
            for w in range((s // slide - size // slide) * slide, s + 1, slide):
                if w <= s < w + size and (wm is None or w + size + lateness > wm):
                    open_.append(w)
            if not open_:
                out.append(("late", k, i))
            for w in open_:
                windows[k, w] = windows.get((k, w), 0) + 1
                changed.add((k, w))
        for k, w in changed:
            if wm is not None and w + size <= wm:
                sent[k, w] = sent.get((k, w), 0) + 1
                out.append(("window", k, w, sent[k, w], windows[k, w]))
        top = max([r[1] for r in rows] + ([top] if top is not None else []), default=None)
        wm = top - delay
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_lateness_matches_a_simulation(spark, seed):
    rng = random.Random(seed)
    files, now = [], 100
    for f in range(7):
        now += rng.randint(10, 60)
        files.append([(f * 100 + i, max(0, now - rng.choice([0, 3, 9, 20, 40, 90, 200])), rng.choice("ab"), 1.0) for i in range(12)])
    files.append([(10_000 + i, 5000, k, 1.0) for i, k in enumerate("ab")])
    got = run(spark, files, RowCount(), "1 minute", "30 seconds", slide="20 seconds")
    want = [x for x in simulate(files, 60, 20, 30, 10) if x[0] == "late" or x[2] < 4000]
    plain = [("late", r.k, r.event_id) if r.output == "late" else ("window", r.k, (r.window_start_us - T0_US) // S, r.version, r.cnt) for r in got]
    assert sorted(plain, key=str) == sorted(want, key=str) and any(x[0] == "window" and x[3] > 1 for x in plain)


def test_state_holds_open_windows_only():
    from test_processors_unit import _Handle
    p = LatenessProcessor([("k", "string")], RowCount(), 60 * S, 60 * S, 20 * S)
    p.init(_Handle())
    frame = lambda *t: iter([pd.DataFrame({"ev_t": [x * S for x in t], "ev_id": list(range(len(t)))})])
    assert not list(p.handleInputRows(("a",), frame(5, 5, 65, 200), _Timers(0, 0))) and len(p.windows.v) == 3
    out = [r for wm, at in ((60_000, 59_999), (80_000, 79_999), (150_000, 119_999), (150_000, 139_999)) for f in p.handleExpiredTimer(("a",), _Timers(wm, at), _Timers(wm, at))
           for r in f.itertuples()]
    assert [(r.window_start_us, r.version, r.cnt) for r in out] == [(0, 1, 2), (60 * S, 1, 1)]
    assert list(p.windows.v) == [(180 * S,)]


class _Timers:
    def __init__(self, wm, at):
        self.wm, self.at = wm, at

    def getCurrentWatermarkInMs(self):
        return self.wm

    def getExpiryTimeInMs(self):
        return self.at


def test_two_inputs_match_like_the_batch_join(spark, stream_dir, batch):  # noqa: F811
    left = source(spark, stream_dir, batch).where(F.col("event_type") == "purchase")
    right = source(spark, stream_dir, batch).where(F.col("event_type") == "click")
    got = collect_stream(spark, stream_match(left, right, "user_id", "event_time", "event_time", "event_id", "event_id", "12 hours")).where("user_id >= 0")
    want = interval_match(batch.where(F.col("event_type") == "purchase"), batch.where(F.col("event_type") == "click"), "user_id", "ts", "ts", "12 hours",
                          ["event_id"], ["event_id"], unified=True)
    g = sorted((r.l_event_id or -1, r.r_event_id or -1) for r in got.collect())
    assert g == sorted((r.l_event_id or -1, r.r_event_id or -1) for r in want.collect())
    kinds = {r.result for r in got.select("result").distinct().collect()}
    assert kinds == {"match", "left_only", "right_only"}


def test_two_inputs_keep_repeated_rows_and_equal_times(spark):
    left, right = scratch_path(spark, "l"), scratch_path(spark, "r")
    write(left, 0, [(1, 10, "a", 0.0), (1, 10, "a", 0.0), (2, 30, "a", 0.0), (3, 50, None, 0.0), (99, 9999, "z", 0.0)])
    write(right, 0, [(7, 10, "a", 0.0), (8, 15, "a", 0.0), (9, 36, "a", 0.0), (98, 9999, "y", 0.0)])
    for d in (left, right):
        write(d, 1, [(100, 20_000, "w", 0.0)])
    got = collect_stream(spark, stream_match(read(spark, left), read(spark, right), "k", "event_time", "event_time", "event_id", "event_id", "5 seconds"))
    rows = sorted((r.result, r.l_event_id or -1, r.r_event_id or -1) for r in got.where("coalesce(l_event_id, 0) < 90 and coalesce(r_event_id, 0) < 90").collect())
    assert rows == [("left_only", 2, -1), ("left_only", 3, -1), ("match", 1, 7), ("match", 1, 7), ("match", 1, 8), ("match", 1, 8), ("right_only", -1, 9)]


def test_a_rise_rings_on_the_clock_and_a_fall_deletes_it(spark):
    d = scratch_path(spark, "clock")
    write(d, 0, [(1, 0, "up", 1.0), (2, 1, "up", 2.0), (1, 0, "down", 1.0), (2, 1, "down", 2.0), (3, 2, "down", 1.5), (1, 0, "flat", 1.0), (4, 1, "first", 5.0),
                 (1, 0, "later", 1.0), (2, 1, "later", 2.0)])
    s = spark.readStream.schema(SCHEMA).parquet(d)
    q = (stream_rise_clock(s, "k", "event_id", "v", "20 seconds").writeStream.format("memory").queryName("clock_alerts").outputMode("append")
         .option("checkpointLocation", scratch_path(spark, "clock-ckpt")).trigger(processingTime="1 second").start())
    try:
        def wait(done, seconds):
            end = time.time() + seconds
            while time.time() < end and not done():
                assert q.exception() is None
                time.sleep(0.5)
        wait(lambda: any(p["numInputRows"] for p in q.recentProgress), 60)
        assert spark.table("clock_alerts").count() == 0
        write(d, 1, [(3, 9, "later", 1.0), (4, 9, "up", 3.0)])      # a second trigger: the fall deletes the timer that waits
        wait(lambda: spark.table("clock_alerts").count() > 0, 60)
        time.sleep(3)
        assert [(r.k, r.value) for r in spark.table("clock_alerts").collect()] == [("up", 3.0)]
    finally:
        q.stop()
