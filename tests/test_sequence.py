"""The sliced (key, time-slice) forms equal the plain per-key window forms."""

import random

import pytest
from pyspark.sql import functions as F

from eventide.functions.timefn import slice_id
from eventide.operators import sequence
from eventide.operators.sequence import Running, next_where, prev_where, with_neighbours, with_running, with_runnings


@pytest.fixture(autouse=True, params=[-1, 60], ids=["all cut", "hot cut"])
def hot_rows(request, monkeypatch):
    """Every key or only the hot one is cut into slices."""
    monkeypatch.setattr(sequence, "HOT_ROWS", request.param)
    return request.param


@pytest.fixture(scope="module")
def seq(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(600):
        key = 0 if rnd.random() < 0.5 else rnd.randint(1, 6)  # key 0 is hot
        key = None if rnd.random() < 0.03 else key             # NULL keys form one group
        sec = rnd.randint(0, 4 * 86400)                       # four days, many empty hours
        val = None if rnd.random() < 0.05 else rnd.randint(0, 20) / 2
        rows.append((i, key, sec, val, rnd.random() < 0.3))
    # ties on ts inside a key, broken by id
    rows += [(600, 0, 1000, 1.0, True), (601, 0, 1000, 2.0, False)]
    df = spark.createDataFrame(rows, "id long, k long, s long, v double, c boolean")
    return df.withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz")).drop("s")


def _rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("direction", ["prev", "next"])
@pytest.mark.parametrize("n", [1, 3])
@pytest.mark.parametrize("size", ["1 hour", "1 day"])
def test_neighbours(seq, direction, n, size):
    cols = ["id", *[f"{direction}{i}" for i in range(1, n + 1)]]
    plain = with_neighbours(seq, ["k"], ["ts", "id"], ["id", "v"], n, direction=direction)
    sliced = with_neighbours(seq, ["k"], ["ts", "id"], ["id", "v"], n, direction=direction,
                             slice_col=slice_id("ts", size))
    assert _rows(plain, cols) == _rows(sliced, cols)


@pytest.mark.parametrize("fn", ["min", "max", "sum", "count"])
@pytest.mark.parametrize("include", [True, False])
@pytest.mark.parametrize("reverse", [False, True])
def test_running(seq, fn, include, reverse):
    kw = dict(include_current=include, reverse=reverse)
    plain = with_running(seq, ["k"], ["ts", "id"], F.col("v"), fn, "r", **kw)
    sliced = with_running(seq, ["k"], ["ts", "id"], F.col("v"), fn, "r", slice_col=slice_id("ts", "1 hour"), **kw)
    assert _rows(plain, ["id", "r"]) == _rows(sliced, ["id", "r"])


def test_running_without_key(seq):
    plain = with_running(seq, [], ["ts", "id"], F.col("v"), "max", "r", include_current=False)
    sliced = with_running(seq, [], ["ts", "id"], F.col("v"), "max", "r", include_current=False,
                          slice_col=slice_id("ts", "1 hour"))
    assert _rows(plain, ["id", "r"]) == _rows(sliced, ["id", "r"])


def test_next_and_prev_where(seq):
    for fn in (next_where, prev_where):
        plain = fn(seq, ["k"], ["ts", "id"], F.col("c"), ["v"], "m")
        sliced = fn(seq, ["k"], ["ts", "id"], F.col("c"), ["v"], "m", slice_col=slice_id("ts", "1 hour"))
        assert _rows(plain, ["id", "m"]) == _rows(sliced, ["id", "m"])


def test_next_where_brute_force(seq):
    rows = sorted(seq.collect(), key=lambda r: (r.k is not None, r.k or 0, r.ts, r.id))
    expect = {}
    for i, r in enumerate(rows):
        nxt = next((x for x in rows[i + 1:] if x.k == r.k and x.c), None)
        expect[r.id] = None if nxt is None else nxt.id
    got = next_where(seq, ["k"], ["ts", "id"], F.col("c"), [], "m", slice_col=slice_id("ts", "1 hour"))
    assert {r.id: (r.m.id if r.m else None) for r in got.collect()} == expect


def test_several_running_values_in_one_pass(seq):
    specs = [Running("a", F.col("v"), "min"), Running("b", F.lit(1), "count", include_current=False),
             Running("c", F.col("v"), "max", include_current=False, reverse=True)]
    plain = with_runnings(seq, ["k"], ["ts", "id"], specs)
    sliced = with_runnings(seq, ["k"], ["ts", "id"], specs, slice_id("ts", "1 hour"))
    assert _rows(plain, ["id", "a", "b", "c"]) == _rows(sliced, ["id", "a", "b", "c"])
    # the rows once, three small ones for the summaries of hot keys, and the count per key, which stands in the plan
    # twice and runs once (the second broadcast is a reused one)
    assert sliced._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 7


def test_a_hot_key_is_dealt_over_its_slices_and_calm_keys_stay_whole(seq, hot_rows):
    marked = sequence.mark_hot(seq, ["k"], slice_id("ts", "1 hour"))
    parts = {r["k"]: r["n"] for r in marked.groupBy("k").agg(F.count_distinct("_hot_slice").alias("n")).collect()}
    assert parts[0] > 40
    assert all(n > 0 for n in parts.values()) if hot_rows < 0 else not any(n for k, n in parts.items() if k != 0)


def test_marked_rows_are_cut_the_same_by_every_step(seq):
    d = sequence.mark_hot(seq, ["k"], slice_id("ts", "1 hour"))
    d = with_neighbours(d, ["k"], ["ts", "id"], ["v"], 1, slice_col=slice_id("ts", "1 hour"))
    d = sequence.unmarked(with_running(d, ["k"], ["ts", "id"], F.col("v"), "sum", "r", slice_col=slice_id("ts", "1 hour")))
    plain = with_running(with_neighbours(seq, ["k"], ["ts", "id"], ["v"], 1), ["k"], ["ts", "id"], F.col("v"), "sum", "r")
    assert d.columns == plain.columns and _rows(d, ["id", "prev1", "r"]) == _rows(plain, ["id", "prev1", "r"])


def test_burst_of_one_key_is_dealt_over_its_slices(spark):
    """One key, all rows inside one second: slices of milliseconds spread it."""
    rows = [(i, i * 7919 % 100_000) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, us long").select(
        "id", F.lit(1).alias("k"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, us * 1e-5)").alias("ts"))
    size = slice_id("ts", "10 milliseconds")
    assert df.groupBy(size).count().agg(F.max("count")).first()[0] <= 40      # no task gets a long run
    plain = with_neighbours(df, ["k"], ["ts", "id"], ["id"])
    sliced = with_neighbours(df, ["k"], ["ts", "id"], ["id"], slice_col=size)
    assert _rows(plain, ["id", "prev1"]) == _rows(sliced, ["id", "prev1"])


def test_no_job_while_a_query_is_built_and_no_single_partition(spark, hot_rows):
    from conftest import SF001
    from eventide.plans import QUERIES
    tracker = spark.sparkContext.statusTracker()
    spark.read.parquet(f"{SF001}/events.parquet").schema
    for name in ("late_rows", "over_last3", "running_min", "rise_pairs", "not_followed_by"):
        df = QUERIES[name](spark, SF001)
        assert "SinglePartition" not in df._jdf.queryExecution().executedPlan().toString(), name
    spark.sparkContext.setJobGroup(f"building {hot_rows}", "queries being built")
    try:
        for name in ("late_rows", "over_last3", "rising_alert"):
            QUERIES[name](spark, SF001)
        jobs = [j for j in tracker.getJobIdsForGroup(f"building {hot_rows}")]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 3      # at most the schema of the file, once a query
