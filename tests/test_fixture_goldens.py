"""Operators on small own rows (fixtures.py), against brute force over the same rows."""

import collections

import pytest
from pyspark.sql import functions as F

from fixtures import CLICKS, LOGINS, ORDERS, RECEIPTS, SENSORS, T0, ad_clicks, logins, orders, receipts, sensors, t_ms
from eventide.functions.timefn import slice_id
from eventide.operators.analytic import jump_flag, over_rows
from eventide.operators.joins import interval_match, unify, window_join
from eventide.operators.patterns import (consecutive, followed_by, missing_followup, next_pairs,
                                         rate_cap)
from eventide.operators.windows import window_agg, window_count

SLICES = [None, "1 second", "1 hour"]  # plain window and two slice sizes must agree


def _slice(size):
    return None if size is None else slice_id("ts", size)


def by_key(rows, key, time):
    """Rows of each key in order (time, line)."""
    out = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[time], r[0])):
        out[r[key]].append(r)
    return out


def windows_of(rows, key, size):
    """(key, window start in ms) -> rows, tumbling windows of ``size`` ms."""
    out = collections.defaultdict(list)
    for r in rows:
        t = T0 * 1000 + r[2]
        out[r[key], t - t % size].append(r)
    return out


@pytest.mark.parametrize("size", SLICES)
def test_login_fail_pairs(spark, size):
    r = consecutive(logins(spark), "user_id", ["ts", "line"], F.col("event_type") == "fail", 2,
                    "2 seconds", cols=["ip"], slice_col=_slice(size))
    want = [b[0] for rows in by_key(LOGINS, 1, 4).values() for a, b in zip(rows, rows[1:])
            if a[3] == b[3] == "fail" and b[4] - a[4] < 2]
    assert sorted(x.line for x in r.collect()) == sorted(want) and len(want) >= 3


def test_three_fails_give_two_overlapping_pairs(spark):
    df = spark.createDataFrame([(1, 1, "fail", 0), (2, 1, "fail", 1), (3, 1, "fail", 2), (4, 1, "fail", 2)],
                               "line long, user_id long, event_type string, s long")
    df = df.withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz"))
    r = consecutive(df, "user_id", ["ts", "line"], F.col("event_type") == "fail", 3, "2 seconds")
    # (1,2,3) spans 2 s: not < within; (2,3,4) spans 1 s.
    assert [x.line for x in r.collect()] == [4]


def test_gap_equal_to_within_is_a_timeout(spark):
    df = spark.createDataFrame([(1, 1, "create", 0), (2, 1, "pay", 15), (3, 2, "create", 0), (4, 2, "pay", 14)],
                               "line long, k long, event_type string, s long")
    df = df.withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz"))
    r = followed_by(df, "k", ["ts", "line"], F.col("event_type") == "create", F.col("event_type") == "pay",
                    "15 seconds")
    assert {x.k: x.matched for x in r.collect()} == {1: False, 2: True}
    # The timer form (STA3) counts a pay exactly at +15 s as paid.
    u = missing_followup(df, "k", ["ts", "line"], F.col("event_type") == "create", F.col("event_type") == "pay",
                         "15 seconds")
    assert u.count() == 0


def first_pay(order, rows):
    return next((r[4] - order[4] for r in rows if r[2] == "pay" and (r[4], r[0]) > (order[4], order[0])), None)


@pytest.mark.parametrize("within", [900, 15])
def test_order_pay_result(spark, within):
    r = followed_by(orders(spark), "order_id", ["ts", "line"], F.col("event_type") == "create",
                    F.col("event_type") == "pay", f"{within} seconds", slice_col=slice_id("ts", "1 minute"))
    want = {}
    for k, rows in by_key(ORDERS, 1, 4).items():
        for o in rows:
            if o[2] == "create":
                gap = first_pay(o, rows)
                want[k] = gap is not None and gap < within
    assert {x.order_id: x.matched for x in r.collect()} == want and 0 < sum(want.values()) < len(want)


def test_order_unpaid(spark):
    r = missing_followup(orders(spark), "order_id", ["ts", "line"], F.col("event_type") == "create",
                         F.col("event_type") == "pay", "15 minutes")
    want = [k for k, rows in by_key(ORDERS, 1, 4).items() for o in rows if o[2] == "create"
            and (first_pay(o, rows) is None or first_pay(o, rows) > 900)]
    assert sorted(x.order_id for x in r.collect()) == sorted(want) == [111, 113]   # 107 pays at the limit


def _pays(spark):
    o = orders(spark)
    return o.where((F.col("event_type") == "pay") & F.col("tx_id").isNotNull() & (F.col("tx_id") != ""))


def brute_match(tol):
    pays = [r for r in ORDERS if r[2] == "pay"]
    pairs = [(p[0], r[0]) for p in pays for r in RECEIPTS if p[3] == r[1] and (tol is None or abs(p[4] - r[3]) <= tol)]
    return (sorted(pairs), sorted(p[0] for p in pays if p[0] not in {a for a, _ in pairs}),
            sorted(r[0] for r in RECEIPTS if r[0] not in {b for _, b in pairs}))


@pytest.mark.parametrize("tol", [5, 0, None])
@pytest.mark.parametrize("size", ["1 second", "1 day"])
def test_tx_match(spark, tol, size):
    m, lo, ro = interval_match(_pays(spark), receipts(spark), "tx_id", "ts", "ts", None if tol is None else f"{tol} seconds",
                               ["line"], ["line"], slice_size=size)
    pairs, left, right = brute_match(tol)
    assert sorted((x.l_line, x.r_line) for x in m.collect()) == pairs and pairs
    assert sorted(x.l_line for x in lo.collect()) == left and sorted(x.r_line for x in ro.collect()) == right
    both = interval_match(_pays(spark), receipts(spark), "tx_id", "ts", "ts", None if tol is None else f"{tol} seconds",
                          ["line"], ["line"], unified=True)
    assert both.count() == len(pairs) + len(left) + len(right)
    assert sorted(unify(m, lo, ro).columns) == sorted(both.columns)


@pytest.mark.parametrize("tol", ["5 seconds", "0 seconds", None])
def test_rows_without_time_or_key(spark, tol):
    l = [(i, None if i % 11 == 3 else i % 60, None if i % 10 == 0 else i) for i in range(50)]
    r = [(i, None if i % 13 == 5 else i % 60, None if i % 10 == 0 else i) for i in range(20, 200)]
    sides = [spark.createDataFrame(x, "id long, k long, s long").withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz")) for x in (l, r)]
    m, lo, ro = interval_match(*sides, "k", "ts", "ts", tol, ["id"], ["id"])
    near = {None: lambda a, b: True, "5 seconds": lambda a, b: a is not None and b is not None and abs(a - b) <= 5,
            "0 seconds": lambda a, b: a is not None and a == b}[tol]
    pairs = {(a[0], b[0]) for a in l for b in r if a[1] is not None and a[1] == b[1] and near(a[2], b[2])}
    assert {(x.l_id, x.r_id) for x in m.collect()} == pairs and pairs
    assert sorted(x.l_id for x in lo.collect()) == [a[0] for a in l if a[0] not in {p for p, _ in pairs}]
    assert sorted(x.r_id for x in ro.collect()) == [b[0] for b in r if b[0] not in {p for _, p in pairs}]


def test_unified_match_reads_its_inputs_fewer_times(spark):
    from conftest import SF001
    from eventide.plans import QUERIES
    plan = QUERIES["tx_unified"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") - plan.count("ReusedExchange") < 7


def test_zero_slice_is_refused():
    with pytest.raises(ValueError):
        slice_id("ts", "0 seconds")


def test_tx_match_repeated_key_returns_every_pair(spark):
    l = spark.createDataFrame([("a", 0), ("a", 3)], "tx string, s long")
    r = spark.createDataFrame([("a", 1)], "tx string, s long")
    l, r = [d.withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz")) for d in (l, r)]
    m, lo, ro = interval_match(l, r, "tx", "ts", "ts", "5 seconds")
    assert (m.count(), lo.count(), ro.count()) == (2, 0, 0)


@pytest.mark.parametrize("cap,size", [(100, None), (100, "1 hour"), (1500, None)])
def test_click_cap(spark, cap, size):
    passed, warn = rate_cap(ad_clicks(spark), ["user_id", "ad_id"], "ts", ["ts", "line"], cap, day_tz="Asia/Shanghai", slice_size=size)
    seen, ok, late = collections.Counter(), [], []
    for r in sorted(CLICKS, key=lambda r: (r[5], r[0])):
        day = (T0 + r[5] + 8 * 3600) // 86400
        seen[r[1], r[2], day] += 1
        if seen[r[1], r[2], day] <= cap + 1:
            ok.append(r[0])
        elif seen[r[1], r[2], day] == cap + 2:
            late.append((r[1], r[2], (T0 + r[5]) * 1000, f"Click over {cap} times today."))
    assert sorted(x.line for x in passed.collect()) == sorted(ok)
    got = warn.select("user_id", "ad_id", t_ms("warn_ts").alias("ms"), "msg").collect()
    assert [tuple(x) for x in got] == late and len(late) == (cap == 100)


def _sensor_sides(spark):
    s = sensors(spark)
    return s.where(F.col("temperature") > 40), s.where(F.col("temperature") <= 40)


def brute_join():
    hi, lo = [r for r in SENSORS if r[3] > 40], [r for r in SENSORS if r[3] <= 40]
    a, b = windows_of(hi, 1, 30), windows_of(lo, 1, 30)
    return a, b, [(k[0], x[3], y[3], k[1]) for k in a for x in a[k] for y in b.get(k, [])]


def test_window_inner_join(spark):
    hi, lo = _sensor_sides(spark)
    r = window_join(hi, lo, "id", "ts", "30 milliseconds", "inner", ["temperature"], ["temperature"])
    got = r.select("id", "l_temperature", "r_temperature", t_ms("window_start").alias("ms")).collect()
    assert sorted(tuple(x) for x in got) == sorted(brute_join()[2]) and got


@pytest.mark.parametrize("how", ["left", "full"])
def test_window_outer_join(spark, how):
    hi, lo = _sensor_sides(spark)
    r = window_join(hi, lo, "id", "ts", "30 milliseconds", how, ["temperature"], ["temperature"])
    a, b, want = brute_join()
    want += [(k[0], x[3], None, k[1]) for k in a if k not in b for x in a[k]]
    if how == "full":
        want += [(k[0], None, y[3], k[1]) for k in b if k not in a for y in b[k]]
        assert "FullOuter" not in r._jdf.queryExecution().executedPlan().toString()
    got = r.select("id", "l_temperature", "r_temperature", t_ms("window_start").alias("ms")).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


@pytest.mark.parametrize("size", [50, 20])
def test_tumbling_average(spark, size):
    r = window_agg(sensors(spark), ["id"], "ts", f"{size} milliseconds", None, [("avg_t", "avg", "temperature")])
    want = {(k[0], k[1] + size): round(sum(x[3] for x in v) / len(v), 9) for k, v in windows_of(SENSORS, 1, size).items()}
    assert {(x.id, x.ms): round(x.avg_t, 9) for x in r.select("id", t_ms("window_end").alias("ms"), "avg_t").collect()} == want


def test_tumbling_count_sql(spark):
    sensors(spark).createOrReplaceTempView("sensor_fixture")
    r = spark.sql("SELECT id, count(1) AS cnt, window.end AS window_end FROM sensor_fixture "
                  "GROUP BY id, window(ts, '10 seconds')")
    want = {(k[0], len(v), k[1] + 10_000) for k, v in windows_of(SENSORS, 1, 10_000).items()}
    assert {(x.id, x.cnt, x.ms) for x in r.select("id", "cnt", t_ms("window_end").alias("ms")).collect()} == want


@pytest.mark.parametrize("size", SLICES)
def test_over_last3(spark, size):
    r = over_rows(sensors(spark), "id", ["ts", "line"], "temperature", 2, slice_col=_slice(size))
    want = {}
    for rows in by_key(SENSORS, 1, 2).values():
        for i, x in enumerate(rows):
            last = [y[3] for y in rows[max(0, i - 2):i + 1]]
            want[x[0]] = len(last), round(sum(last) / len(last), 9)
    assert {x.line: (x.cnt, round(x.avg, 9)) for x in r.collect()} == want


def test_jump_flag(spark):
    r = jump_flag(sensors(spark), "id", ["ts", "line"], "temperature", 15.0)
    want = {x[0]: abs(x[3] - (rows[i - 1][3] if i else 0.0)) > 15 for rows in by_key(SENSORS, 1, 2).values() for i, x in enumerate(rows)}
    assert {x.line: x.jumped for x in r.collect()} == want and len(set(want.values())) == 2


def test_jump_flag_previous_value_is_null(spark):
    df = spark.createDataFrame([(1, "a", 7.0), (2, "a", None), (3, "a", 9.0)], "n long, id string, v double")
    got = {x.n: (x.prev_value, x.jumped) for x in jump_flag(df, "id", ["n"], "v", 5.0).collect()}
    assert got == {1: (0.0, True), 2: (7.0, None), 3: (None, None)}


@pytest.mark.parametrize("size", SLICES)
def test_rise_pairs(spark, size):
    pairs, timeouts = next_pairs(sensors(spark), "id", ["ts", "line"], "temperature", "15 milliseconds",
                                 slice_col=_slice(size))
    near = [(a[0], b[0], b[3] > a[3]) for rows in by_key(SENSORS, 1, 2).values() for a, b in zip(rows, rows[1:]) if b[2] - a[2] < 15]
    got = sorted((x.line, x.nxt.line) for x in pairs.collect())
    assert got == sorted((a, b) for a, b, up in near if up) and got
    assert sorted(x.line for x in timeouts.collect()) == sorted({r[0] for r in SENSORS} - {a for a, _, _ in near})


@pytest.mark.parametrize("size,slide", [("60 minutes", "5 seconds"), ("10 minutes", "1 minute"),
                                        ("1 minute", "30 seconds")])
def test_sliding_plans_agree(spark, size, slide):
    clicks = ad_clicks(spark)
    a = window_count(clicks, ["province"], "ts", size, slide, plan="plain")
    assert a.count() > 0
    for plan in ("pane", "delta", "auto"):
        b = window_count(clicks, ["province"], "ts", size, slide, plan=plan)
        assert sorted(a.collect()) == sorted(b.collect()), plan


def test_empty_input(spark):
    empty = sensors(spark).limit(0)
    assert window_count(empty, ["id"], "ts", "10 seconds").count() == 0
    assert over_rows(empty, "id", ["ts", "line"], "temperature", 2, slice_col=slice_id("ts", "1 hour")).count() == 0


def test_window_plan_thresholds_from_session(spark):
    from eventide.operators import windows as W
    clicks = ad_clicks(spark)
    a = window_count(clicks, ["province"], "ts", "10 minutes", "1 minute")   # overlap 10: pane
    spark.conf.set("eventide.window.deltaMinOverlap", "4")
    try:
        assert W._threshold("deltaMinOverlap", 24) == 4
        b = window_count(clicks, ["province"], "ts", "10 minutes", "1 minute")  # now change points
        assert sorted(a.collect()) == sorted(b.collect())
    finally:
        spark.conf.unset("eventide.window.deltaMinOverlap")


def test_api_forms(spark):
    from eventide.operators.patterns import next_pairs
    from eventide.operators.topn import topn_per_window
    # a custom cross-row condition: next reading cooler by more than 20
    pairs, _ = next_pairs(sensors(spark), "id", ["ts", "line"], "temperature", "5 seconds",
                          cond=lambda nxt: nxt["temperature"] < F.col("temperature") - 20)
    want = [a[0] for rows in by_key(SENSORS, 1, 2).values() for a, b in zip(rows, rows[1:]) if b[3] < a[3] - 20]
    assert sorted(r.line for r in pairs.collect()) == sorted(want) and want
    top = topn_per_window(window_count(ad_clicks(spark), ["province"], "ts", "1 hour"), 1, "cnt", ["province"])
    count = collections.Counter(((T0 + r[5]) // 3600, r[3]) for r in CLICKS)
    best = {h: min((-n, p) for (g, p), n in count.items() if g == h) for h, _ in count}
    got = {x.ms // 3_600_000 - 1: (-x.cnt, x.province) for x in top.select(t_ms("window_end").alias("ms"), "cnt", "province").collect()}
    assert got == best


@pytest.mark.parametrize("fn", ["avg", "min", "max", "sum"])
def test_sliding_pane_aggregates_equal_plain(spark, fn):
    clicks = ad_clicks(spark).withColumn("v", (F.col("ad_id") % 97).cast("double"))
    aggs = [("x", fn, "v")]
    a = window_agg(clicks, ["province"], "ts", "10 minutes", "1 minute", aggs, plan="plain")
    b = window_agg(clicks, ["province"], "ts", "10 minutes", "1 minute", aggs, plan="pane")
    r = lambda d: sorted((x.window_end, x.province, round(x.x, 9)) for x in d.collect())
    assert r(a) == r(b) and a.count() > 0


def test_unique_visitors_approximate(spark):
    from eventide.operators.windows import unique_visitors
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").where(F.col("event_type") == "view")
    exact = {x.window_end: x.uv for x in unique_visitors(ev, "ts", "user_id", "1 day").collect()}
    approx = {x.window_end: x.uv for x in unique_visitors(ev, "ts", "user_id", "1 day", exact=False).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - exact[k]) <= max(2, 0.1 * exact[k]) for k in exact)


def test_keyless_sliding_count_plans_agree(spark):
    clicks = ad_clicks(spark)
    a = window_count(clicks, [], "ts", "30 minutes", "1 minute", plan="plain")
    for plan in ("pane", "delta"):
        b = window_count(clicks, [], "ts", "30 minutes", "1 minute", plan=plan)
        assert sorted(a.collect()) == sorted(b.collect()), plan
    assert a.count() > 0
