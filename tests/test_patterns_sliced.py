"""Pattern operators: sliced plans equal the plain per-key window plans on random data
with a hot key, ties, NULL keys and many empty slices."""

import random

import pytest
from pyspark.sql import functions as F

from eventide.functions.timefn import slice_id
from eventide.operators import sequence
from eventide.operators.patterns import (consecutive, followed_by, next_pairs, not_next, rising_alert,
                                         split_late)

ORDER = ["ts", "id"]


@pytest.fixture(autouse=True)
def cut_small_keys(monkeypatch):
    """Keys of more than five rows are cut into slices."""
    monkeypatch.setattr(sequence, "HOT_ROWS", 5)


@pytest.fixture(scope="module")
def ev(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(800):
        k = 0 if rnd.random() < 0.4 else rnd.choice([1, 2, 3, None])
        sec = rnd.randint(0, 3 * 86400)
        rows.append((i, k, sec, float(rnd.randint(0, 9)), rnd.choice(["a", "b", "c"])))
    rows += [(800, 0, 500, 3.0, "a"), (801, 0, 500, 3.0, "a")]   # a tie on ts
    df = spark.createDataFrame(rows, "id long, k long, s long, v double, kind string")
    return df.withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz"))


def _rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


SIZES = ["1 minute", "1 hour"]


@pytest.mark.parametrize("size", SIZES)
def test_rising_alert(ev, size):
    a = rising_alert(ev, "k", ORDER, "v", "2 hours")
    b = rising_alert(ev, "k", ORDER, "v", "2 hours", slice_col=slice_id("ts", size))
    assert _rows(a, a.columns) == _rows(b, a.columns) and a.count() > 0


@pytest.mark.parametrize("size", SIZES)
def test_followed_by(ev, size):
    args = ("k", ORDER, F.col("kind") == "a", F.col("kind") == "b", "3 hours")
    a = followed_by(ev, *args, cols=["id"])
    b = followed_by(ev, *args, cols=["id"], slice_col=slice_id("ts", size))
    cols = ["id", "matched", "follow"]
    assert _rows(a, cols) == _rows(b, cols)


@pytest.mark.parametrize("size", SIZES)
def test_consecutive_three(ev, size):
    a = consecutive(ev, "k", ORDER, F.col("kind") == "c", 3, "6 hours")
    b = consecutive(ev, "k", ORDER, F.col("kind") == "c", 3, "6 hours", slice_col=slice_id("ts", size))
    cols = ["id", "prev1", "prev2"]
    assert _rows(a, cols) == _rows(b, cols) and a.count() > 0


@pytest.mark.parametrize("size", SIZES)
def test_next_pairs_and_not_next(ev, size):
    pa, ta = next_pairs(ev, "k", ORDER, "v", "1 hour")
    pb, tb = next_pairs(ev, "k", ORDER, "v", "1 hour", slice_col=slice_id("ts", size))
    assert _rows(pa, ["id", "nxt"]) == _rows(pb, ["id", "nxt"])
    assert _rows(ta, ["id"]) == _rows(tb, ["id"])
    na = not_next(ev, "k", ORDER, F.col("kind") == "a", F.col("kind") == "c")
    nb = not_next(ev, "k", ORDER, F.col("kind") == "a", F.col("kind") == "c", slice_col=slice_id("ts", size))
    assert _rows(na, ["id"]) == _rows(nb, ["id"])


def test_split_late_brute_force(ev):
    d = ev.withColumn("arrival", F.timestamp_add("HOUR", F.col("id") % 7, F.col("ts")))
    _, late = split_late(d, "ts", "3 hours", ["arrival", "id"], slice_size="1 hour")
    rows = sorted(d.collect(), key=lambda r: (r.arrival, r.id))
    expect, seen = set(), None
    for r in rows:
        if seen is not None and (seen - r.ts).total_seconds() > 3 * 3600:
            expect.add(r.id)
        seen = r.ts if seen is None else max(seen, r.ts)
    assert {r.id for r in late.collect()} == expect and expect


@pytest.mark.parametrize("size", SIZES)
def test_rising_alert_rows(ev, size):
    from eventide.operators.patterns import rising_alert_rows
    a = rising_alert_rows(ev, "k", ORDER, "v", "2 hours")
    b = rising_alert_rows(ev, "k", ORDER, "v", "2 hours", slice_col=slice_id("ts", size))
    cols = ["k", "run_start", "alert_ts", "id"]
    assert _rows(a, cols) == _rows(b, cols) and a.count() > 0
    # every alert carries at least its first rise
    assert a.select("k", "run_start").distinct().count() == rising_alert(ev, "k", ORDER, "v", "2 hours").count()


def test_null_keys_are_one_group(ev):
    """A NULL key behaves as one key, as in a window: compare with a sentinel key."""
    from eventide.operators.windows import flag_repeats
    filled = ev.withColumn("k", F.coalesce("k", F.lit(-99)))
    from eventide.operators.patterns import followed_by_any
    for fn in (lambda d: rising_alert(d, "k", ORDER, "v", "2 hours"),
               lambda d: flag_repeats(d, ["k"], ORDER).select("id", "seen_before"),
               lambda d: followed_by_any(d, "k", "ts", "id", F.col("kind") == "a", F.col("kind") == "b",
                                         "2 hours").select("first_id", "second_id")):
        a = fn(ev).withColumn("k", F.coalesce("k", F.lit(-99))) if "k" in fn(ev).columns else fn(ev)
        b = fn(filled)
        assert _rows(a, a.columns) == _rows(b, a.columns)


@pytest.mark.parametrize("size", SIZES)
def test_flag_repeats_sliced(ev, size):
    from eventide.operators.windows import flag_repeats
    a = flag_repeats(ev, ["k", "kind"], ORDER)
    b = flag_repeats(ev, ["k", "kind"], ORDER, slice_col=slice_id("ts", size))
    assert _rows(a, ["id", "seen_before"]) == _rows(b, ["id", "seen_before"])
    firsts = {(r.k, r.kind) for r in ev.select("k", "kind").distinct().collect()}
    assert a.where(~F.col("seen_before")).count() == len(firsts)


def _brute_chain(rows, hold_s):
    """Re-arming alerts by the row rules, per key (rows sorted by ts, id)."""
    out = []
    by = {}
    for r in rows:
        by.setdefault(r.k, []).append(r)
    for k, rs in by.items():
        prev, alert, start = None, None, None
        for r in rs:
            t = r.ts
            if alert is not None and alert < t:
                out.append((k, start, alert))
                alert, start = None, None
            if prev is not None and r.v < prev:
                alert, start = None, None
            elif prev is not None and r.v > prev and alert is None:
                import datetime as _d
                alert, start = t + _d.timedelta(seconds=hold_s), t
            prev = r.v
        if alert is not None:
            out.append((k, start, alert))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [None, "1 hour"])
def test_rising_alert_chain_brute_force(ev, size):
    from eventide.operators.patterns import rising_alert_chain
    d = ev.where(F.col("k").isNotNull())
    got = rising_alert_chain(d, "k", ORDER, "v", "2 hours", slice_size=size)
    rows = sorted(d.collect(), key=lambda r: (r.k, r.ts, r.id))
    want = _brute_chain(rows, 7200)
    assert sorted(((r.k, r.run_start, r.alert_ts) for r in got.collect()), key=repr) == want and want
    # every first-per-run alert is also in the chain
    firsts = {(r.k, r.run_start) for r in rising_alert(d, "k", ORDER, "v", "2 hours").collect()}
    assert firsts <= {(k, s) for k, s, _ in want}
