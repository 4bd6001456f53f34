"""Pattern and keyed-state rules in batch form (PAT1-PAT6, STA1-STA3, STR5)."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from eventide.functions.timefn import duration_us
from eventide.operators.patterns import (consecutive, followed_by, followed_by_any, missing_followup,
                                         next_pairs, not_followed_by, not_next, rate_cap, rising_alert,
                                         rising_alert_chain, rising_alert_rows, split_late)
from eventide.plans.inputs import events, seq_slice, seq_slice_size
from eventide.plans.registry import register
from eventide.plans.windowed import CAP_KEYS, CAP_MAX, SQL_CAP_PASSED, SQL_CAP_RANKED

ORDER = ["ts", "event_id"]
HOUR = duration_us("1 hour")
DAY = duration_us("1 day")
W_USER = "WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"


def _ev(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type", "value")


# ---------------------------------------------------------------- STR5
@register("late_rows",
          "SELECT event_id, user_id, ts, arrival FROM (SELECT *, ts + to_hours(event_id % 5) AS arrival, "
          "max(ts) OVER (ORDER BY ts + to_hours(event_id % 5), event_id "
          "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx FROM events) "
          f"WHERE epoch_us(mx) - epoch_us(ts) > {2 * HOUR}")
def late_rows(spark: SparkSession, sf_dir: str):
    ev = _ev(spark, sf_dir).withColumn("arrival", F.timestamp_add("HOUR", F.col("event_id") % 5, F.col("ts")))
    _, late = split_late(ev, "ts", "2 hours", ["arrival", "event_id"], slice_size=seq_slice_size(spark))
    return late.select("event_id", "user_id", "ts", "arrival")


# ---------------------------------------------------------------- STA1
@register("click_cap_passed", f"SELECT event_id, user_id, event_type, ts, day FROM ({SQL_CAP_PASSED})")
def click_cap_passed(spark: SparkSession, sf_dir: str):
    passed, _ = rate_cap(_ev(spark, sf_dir), CAP_KEYS, "ts", ORDER, CAP_MAX)
    return passed.select("event_id", "user_id", "event_type", "ts", "day")


@register("click_cap_warnings",
          f"SELECT user_id, event_type, day, ts AS warn_ts, 'Click over {CAP_MAX} times today.' AS msg "
          f"FROM ({SQL_CAP_RANKED}) WHERE _rn = {CAP_MAX + 2}")
def click_cap_warnings(spark: SparkSession, sf_dir: str):
    _, warn = rate_cap(_ev(spark, sf_dir), CAP_KEYS, "ts", ORDER, CAP_MAX)
    return warn


# ---------------------------------------------------------------- STA2
_SQL_RISE_SEGS = (
    "WITH p AS (SELECT user_id, ts, event_id, value, lag(value) OVER w AS pv FROM events " + W_USER + "), "
    "s AS (SELECT *, sum(CASE WHEN value < pv THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, "
    "event_id ROWS UNBOUNDED PRECEDING) AS seg FROM p), "
    "g AS (SELECT user_id, seg, min(CASE WHEN value > pv THEN ts END) AS run_start, min(ts) AS seg_start "
    "FROM s GROUP BY user_id, seg), "
    "a AS (SELECT a.user_id, a.seg, a.run_start, a.run_start + INTERVAL 5 HOUR AS alert_ts FROM g a LEFT JOIN g b "
    "ON a.user_id = b.user_id AND b.seg = a.seg + 1 WHERE a.run_start IS NOT NULL AND "
    "(b.seg_start IS NULL OR b.seg_start > a.run_start + INTERVAL 5 HOUR)) ")


@register("rising_alert", _SQL_RISE_SEGS + "SELECT user_id, run_start, alert_ts FROM a")
def rising_alert_q(spark: SparkSession, sf_dir: str):
    return rising_alert(_ev(spark, sf_dir), "user_id", ORDER, "value", "5 hours",
                        slice_col=seq_slice(spark))


@register("rising_alert_rows",
          _SQL_RISE_SEGS + "SELECT s.user_id, a.run_start, a.alert_ts, s.event_id, s.ts, s.value FROM s "
          "JOIN a ON s.user_id = a.user_id AND s.seg = a.seg WHERE s.value > s.pv AND "
          "s.ts BETWEEN a.run_start AND a.alert_ts")
def rising_alert_rows_q(spark: SparkSession, sf_dir: str):
    r = rising_alert_rows(_ev(spark, sf_dir), "user_id", ORDER, "value", "5 hours",
                          slice_col=seq_slice(spark))
    return r.select("user_id", "run_start", "alert_ts", "event_id", "ts", "value")


_SQL_RISE_CHAIN = (
    "WITH RECURSIVE p AS (SELECT user_id, ts, event_id, value, lag(value) OVER w AS pv FROM events " + W_USER +
    "), s AS (SELECT *, sum(CASE WHEN value < pv THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, "
    "event_id ROWS UNBOUNDED PRECEDING) AS seg FROM p), "
    "r AS (SELECT user_id, seg, ts FROM s WHERE value > pv), "
    "nf AS (SELECT user_id, seg - 1 AS seg, min(ts) AS next_fall FROM s GROUP BY user_id, seg), "
    "chain(user_id, seg, ts) AS (SELECT user_id, seg, min(ts) FROM r GROUP BY user_id, seg "
    "UNION ALL SELECT c.user_id, c.seg, (SELECT min(r.ts) FROM r WHERE r.user_id = c.user_id AND "
    "r.seg = c.seg AND r.ts > c.ts + INTERVAL 5 HOUR) FROM chain c WHERE c.ts IS NOT NULL) "
    "SELECT c.user_id, c.ts AS run_start, c.ts + INTERVAL 5 HOUR AS alert_ts FROM chain c LEFT JOIN nf "
    "ON nf.user_id = c.user_id AND nf.seg = c.seg WHERE c.ts IS NOT NULL AND "
    "(nf.next_fall IS NULL OR nf.next_fall > c.ts + INTERVAL 5 HOUR)")


@register("rising_alert_repeat", _SQL_RISE_CHAIN)
def rising_alert_repeat(spark: SparkSession, sf_dir: str):
    """Alerts with re-arming: after an alert the run's next rise arms again."""
    return rising_alert_chain(_ev(spark, sf_dir), "user_id", ORDER, "value", "5 hours", slice_size=seq_slice_size(spark))


# ---------------------------------------------------------------- PAT4, STA3
_NEXT_PAY = ("SELECT *, min(CASE WHEN event_type = 'purchase' THEN {'ts': ts, 'event_id': event_id} END) "
             "OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) "
             "AS nx FROM events WHERE event_type IN ('signup', 'purchase')")


def _is(t: str):
    return F.col("event_type") == t



@register("order_pay_result",
          f"SELECT user_id, event_id, ts, CASE WHEN epoch_us(nx.ts) - epoch_us(ts) < {DAY} THEN 'success' "
          f"ELSE 'timeout' END AS result, CASE WHEN epoch_us(nx.ts) - epoch_us(ts) < {DAY} THEN nx.event_id END "
          f"AS pay_event_id FROM ({_NEXT_PAY}) WHERE event_type = 'signup'")
def order_pay_result(spark: SparkSession, sf_dir: str):
    r = followed_by(_ev(spark, sf_dir), "user_id", ORDER, _is("signup"), _is("purchase"), "1 day",
                    slice_col=seq_slice(spark))
    return r.select("user_id", "event_id", "ts",
                    F.when(F.col("matched"), "success").otherwise("timeout").alias("result"),
                    F.when(F.col("matched"), F.col("follow.event_id")).alias("pay_event_id"))


@register("order_unpaid",
          f"SELECT user_id, event_id, ts FROM ({_NEXT_PAY}) WHERE event_type = 'signup' AND "
          f"(nx IS NULL OR epoch_us(nx.ts) - epoch_us(ts) > {DAY})")
def order_unpaid(spark: SparkSession, sf_dir: str):
    r = missing_followup(_ev(spark, sf_dir), "user_id", ORDER, _is("signup"), _is("purchase"), "1 day",
                    slice_col=seq_slice(spark))
    return r.select("user_id", "event_id", "ts")


# ---------------------------------------------------------------- PAT1 / PAT2 / PAT3
_SQL_FAILS = (f"SELECT * FROM (SELECT user_id, event_id, ts, event_type, lag(event_type) OVER w AS pt, "
              f"lag(event_id) OVER w AS pid, lag(ts) OVER w AS pts FROM events {W_USER}) "
              f"WHERE event_type = 'error' AND pt = 'error' AND epoch_us(ts) - epoch_us(pts) < {HOUR}")


@register("login_fail_pairs",
          f"SELECT user_id, pid AS first_event_id, pts AS first_ts, event_id AS second_event_id, ts AS second_ts "
          f"FROM ({_SQL_FAILS})")
def login_fail_pairs(spark: SparkSession, sf_dir: str):
    r = consecutive(_ev(spark, sf_dir), "user_id", ORDER, _is("error"), 2, "1 hour",
                    slice_col=seq_slice(spark))
    return r.select("user_id", F.col("prev1.event_id").alias("first_event_id"), F.col("prev1.ts").alias("first_ts"),
                    F.col("event_id").alias("second_event_id"), F.col("ts").alias("second_ts"))


@register("login_fail_lists", f"SELECT user_id, [pid, event_id] AS event_ids, ts AS last_ts FROM ({_SQL_FAILS})")
def login_fail_lists(spark: SparkSession, sf_dir: str):
    r = consecutive(_ev(spark, sf_dir), "user_id", ORDER, _is("error"), 2, "1 hour",
                    slice_col=seq_slice(spark), emit="list")
    return r.select("user_id", F.transform("events", lambda e: e["event_id"]).alias("event_ids"),
                    F.col("ts").alias("last_ts"))


# ---------------------------------------------------------------- PAT5
_SQL_NEXT = (f"SELECT user_id, event_id, ts, value, lead(event_id) OVER w AS nid, lead(ts) OVER w AS nts, "
             f"lead(value) OVER w AS nv FROM events {W_USER}")
_IN_TIME = f"nts IS NOT NULL AND epoch_us(nts) - epoch_us(ts) < {5 * HOUR}"


def _rise(spark, sf_dir):
    return next_pairs(_ev(spark, sf_dir), "user_id", ORDER, "value", "5 hours",
                    slice_col=seq_slice(spark))


@register("rise_pairs",
          f"SELECT user_id, event_id, ts, value, nid AS next_event_id, nts AS next_ts, nv AS next_value "
          f"FROM ({_SQL_NEXT}) WHERE {_IN_TIME} AND nv > value")
def rise_pairs(spark: SparkSession, sf_dir: str):
    pairs, _ = _rise(spark, sf_dir)
    return pairs.select("user_id", "event_id", "ts", "value", F.col("nxt.event_id").alias("next_event_id"),
                        F.col("nxt.ts").alias("next_ts"), F.col("nxt.value").alias("next_value"))


@register("rise_timeouts", f"SELECT user_id, event_id, ts FROM ({_SQL_NEXT}) WHERE NOT ({_IN_TIME})")
def rise_timeouts(spark: SparkSession, sf_dir: str):
    _, timeouts = _rise(spark, sf_dir)
    return timeouts.select("user_id", "event_id", "ts")


# ---------------------------------------------------------------- PAT6
@register("followed_by_any",
          "SELECT s.user_id, s.event_id AS first_event_id, s.ts AS first_ts, p.event_id AS second_event_id, "
          "p.ts AS second_ts FROM events s JOIN events p ON s.user_id = p.user_id AND "
          "(p.ts > s.ts OR (p.ts = s.ts AND p.event_id > s.event_id)) AND "
          f"epoch_us(p.ts) - epoch_us(s.ts) < {DAY} WHERE s.event_type = 'signup' AND p.event_type = 'purchase'")
def followed_by_any_q(spark: SparkSession, sf_dir: str):
    r = followed_by_any(_ev(spark, sf_dir), "user_id", "ts", "event_id", _is("signup"), _is("purchase"), "1 day")
    return r.select("user_id", "first_event_id", "first_ts", "second_event_id", "second_ts")


@register("not_next",
          f"SELECT user_id, event_id, ts FROM (SELECT user_id, event_id, ts, event_type, "
          f"lead(event_type) OVER w AS nt FROM events {W_USER}) "
          f"WHERE event_type = 'signup' AND (nt IS NULL OR nt <> 'error')")
def not_next_q(spark: SparkSession, sf_dir: str):
    r = not_next(_ev(spark, sf_dir), "user_id", ORDER, _is("signup"), _is("error"),
                    slice_col=seq_slice(spark))
    return r.select("user_id", "event_id", "ts")


@register("not_followed_by",
          "SELECT user_id, event_id, ts FROM (SELECT *, min(CASE WHEN event_type = 'error' THEN ts END) OVER "
          "(PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ne "
          "FROM events WHERE event_type IN ('signup', 'error')) WHERE event_type = 'signup' AND "
          f"(ne IS NULL OR epoch_us(ne) - epoch_us(ts) >= {DAY})")
def not_followed_by_q(spark: SparkSession, sf_dir: str):
    r = not_followed_by(_ev(spark, sf_dir), "user_id", ORDER, _is("signup"), _is("error"), "1 day",
                    slice_col=seq_slice(spark))
    return r.select("user_id", "event_id", "ts")
