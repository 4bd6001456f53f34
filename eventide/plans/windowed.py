"""Window aggregates, top-n and analytic windows over ``events`` (AGG*, TOP*, WIN*)."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from eventide.functions.timefn import duration_us, epoch_us, format_slash_time
from eventide.operators.analytic import jump_flag, over_rows, running_min
from eventide.operators.patterns import rate_cap
from eventide.operators.topn import render_report, topn_per_group
from eventide.operators.windows import flag_repeats, unique_visitors, window_agg, window_count
from eventide.plans.inputs import SQL_K, events, prop_k, seq_slice
from eventide.plans.registry import register

ORDER = ["ts", "event_id"]


def sql_sliding(src: str, size: str, slide: str) -> str:
    """DuckDB: every row of ``src`` once per epoch-aligned window holding it; adds ``_ws`` (start, µs)."""
    sz, sl = duration_us(size), duration_us(slide)
    return (f"(SELECT s.*, (epoch_us(s.ts) // {sl}) * {sl} - r.i * {sl} AS _ws "
            f"FROM ({src}) s CROSS JOIN (SELECT range AS i FROM range({sz // sl})) r)")


def sql_bounds(size: str) -> str:
    return f"make_timestamp(_ws) AS window_start, make_timestamp(_ws + {duration_us(size)}) AS window_end"


# ---------------------------------------------------------------- AGG1/AGG2 + TOP1
def _item_views(spark, sf_dir):
    return events(spark, sf_dir).where(F.col("event_type") == "view").select("ts", prop_k().alias("item_id"))


def _item_counts(spark, sf_dir):
    return window_count(_item_views(spark, sf_dir), ["item_id"], "ts", "1 hour", "5 minutes")


_VIEWS = f"SELECT ts, {SQL_K} AS item_id FROM events WHERE event_type = 'view'"
_SQL_ITEM_COUNTS = (f"SELECT {sql_bounds('1 hour')}, item_id, count(*) AS cnt "
                    f"FROM {sql_sliding(_VIEWS, '1 hour', '5 minutes')} GROUP BY _ws, item_id")


@register("sliding_count", _SQL_ITEM_COUNTS)
def sliding_count(spark: SparkSession, sf_dir: str):
    return _item_counts(spark, sf_dir)


_SQL_HOT_TOP = (f"SELECT window_end, rank, item_id, cnt FROM (SELECT *, row_number() OVER "
                f"(PARTITION BY window_end ORDER BY cnt DESC, item_id) AS rank FROM ({_SQL_ITEM_COUNTS})) "
                f"WHERE rank <= 5")


@register("hot_items_topn", _SQL_HOT_TOP)
def hot_items_topn(spark: SparkSession, sf_dir: str):
    top = topn_per_group(_item_counts(spark, sf_dir), ["window_end"], 5, "cnt", ["item_id"])
    return top.select("window_end", F.col("rank").cast("bigint").alias("rank"), "item_id", "cnt")


@register("hot_items_report",
          "SELECT window_end, 'time: ' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || chr(10) || "
          "string_agg('No' || rank || ': item=' || item_id || ' count=' || cnt, chr(10) ORDER BY rank) "
          f"AS report FROM ({_SQL_HOT_TOP}) GROUP BY window_end")
def hot_items_report(spark: SparkSession, sf_dir: str):
    top = topn_per_group(_item_counts(spark, sf_dir), ["window_end"], 5, "cnt", ["item_id"])
    return render_report(top, "window_end", "rank", "item", "item_id", "cnt")


# ---------------------------------------------------------------- AGG3 + TOP2
_CLICK_URLS = f"SELECT ts, '/p/' || {SQL_K} AS url FROM events WHERE event_type = 'click'"


@register("url_topn",
          f"SELECT window_end, rank, url, cnt FROM (SELECT *, row_number() OVER "
          f"(PARTITION BY window_end ORDER BY cnt DESC, url) AS rank FROM ("
          f"SELECT {sql_bounds('10 minutes')}, url, count(*) AS cnt "
          f"FROM {sql_sliding(_CLICK_URLS, '10 minutes', '5 seconds')} GROUP BY _ws, url)) WHERE rank <= 3")
def url_topn(spark: SparkSession, sf_dir: str):
    clicks = (events(spark, sf_dir).where(F.col("event_type") == "click")
              .select("ts", F.concat(F.lit("/p/"), prop_k().cast("string")).alias("url")))
    counts = window_count(clicks, ["url"], "ts", "10 minutes", "5 seconds")
    top = topn_per_group(counts, ["window_end"], 3, "cnt", ["url"])
    return top.select("window_end", F.col("rank").cast("bigint").alias("rank"), "url", "cnt")


# ---------------------------------------------------------------- AGG4
_MARKETING = (f"SELECT ts, {SQL_K} % 6 AS channel, event_type AS behavior FROM events "
              f"WHERE event_type <> 'signup'")


@register("marketing_counts",
          f"SELECT {sql_bounds('10 hours')}, channel, behavior, count(*) AS cnt "
          f"FROM {sql_sliding(_MARKETING, '10 hours', '1 hour')} GROUP BY _ws, channel, behavior")
def marketing_counts(spark: SparkSession, sf_dir: str):
    ev = events(spark, sf_dir).where(F.col("event_type") != "signup")
    ev = ev.select("ts", (prop_k() % 6).alias("channel"), F.col("event_type").alias("behavior"))
    return window_count(ev, ["channel", "behavior"], "ts", "10 hours", "1 hour")


# ---------------------------------------------------------------- AGG5 (input: STA1 passed rows)
CAP_KEYS = ["user_id", "event_type"]
CAP_MAX = 0

SQL_CAP_RANKED = ("SELECT *, CAST(ts AS DATE) AS day, row_number() OVER (PARTITION BY user_id, event_type, "
                  "CAST(ts AS DATE) ORDER BY ts, event_id) AS _rn FROM events")
SQL_CAP_PASSED = f"SELECT * EXCLUDE (_rn) FROM ({SQL_CAP_RANKED}) WHERE _rn <= {CAP_MAX + 1}"


def cap_passed(spark, sf_dir):
    passed, _ = rate_cap(events(spark, sf_dir), CAP_KEYS, "ts", ORDER, CAP_MAX)
    return passed


_GEO = f"SELECT ts, user_id % 7 AS province FROM ({SQL_CAP_PASSED})"


@register("geo_click_counts",
          f"SELECT make_timestamp(_ws + {duration_us('60 minutes')}) AS window_end, "
          f"strftime(make_timestamp(_ws + {duration_us('60 minutes')}), '%Y/%m/%d-%H:%M:%S') AS window_end_text, "
          f"province, count(*) AS cnt FROM {sql_sliding(_GEO, '60 minutes', '5 seconds')} GROUP BY _ws, province")
def geo_click_counts(spark: SparkSession, sf_dir: str):
    rows = cap_passed(spark, sf_dir).select("ts", (F.col("user_id") % 7).alias("province"))
    c = window_count(rows, ["province"], "ts", "60 minutes", "5 seconds")
    return c.select("window_end", format_slash_time(F.col("window_end")).alias("window_end_text"),
                    "province", "cnt")


# ---------------------------------------------------------------- AGG10 (SQL form), AGG6/7, AGG11, AGG8
@register("tumble_count",
          f"SELECT user_id, count(*) AS cnt, make_timestamp((epoch_us(ts) // {duration_us('1 hour')}) * "
          f"{duration_us('1 hour')} + {duration_us('1 hour')}) AS window_end FROM events "
          f"GROUP BY user_id, epoch_us(ts) // {duration_us('1 hour')}")
def tumble_count(spark: SparkSession, sf_dir: str):
    view = f"events_{abs(hash(sf_dir)) % 10**8}"
    events(spark, sf_dir).createOrReplaceTempView(view)
    return spark.sql(f"SELECT user_id, count(1) AS cnt, window.end AS window_end FROM {view} "
                     f"GROUP BY user_id, window(ts, '1 hour')")


def _sql_tumble(fn: str, name: str, size: str) -> str:
    us = duration_us(size)
    return (f"SELECT user_id, make_timestamp((epoch_us(ts) // {us}) * {us}) AS window_start, "
            f"make_timestamp((epoch_us(ts) // {us}) * {us} + {us}) AS window_end, "
            f"round({fn}(value), 4) AS {name} FROM events GROUP BY user_id, epoch_us(ts) // {us}")


@register("tumble_avg", _sql_tumble("avg", "avg_value", "12 hours"))
def tumble_avg(spark: SparkSession, sf_dir: str):
    r = window_agg(events(spark, sf_dir), ["user_id"], "ts", "12 hours", None, [("avg_value", "avg", "value")])
    return r.withColumn("avg_value", F.round("avg_value", 4))


@register("tumble_sum", _sql_tumble("sum", "sum_value", "12 hours"))
def tumble_sum(spark: SparkSession, sf_dir: str):
    r = window_agg(events(spark, sf_dir), ["user_id"], "ts", "12 hours", None, [("sum_value", "sum", "value")])
    return r.withColumn("sum_value", F.round("sum_value", 4))


@register("sliding_min",
          f"SELECT {sql_bounds('10 hours')}, user_id, min(value) AS min_value "
          f"FROM {sql_sliding('SELECT ts, user_id, value FROM events', '10 hours', '5 hours')} "
          f"GROUP BY _ws, user_id")
def sliding_min(spark: SparkSession, sf_dir: str):
    return window_agg(events(spark, sf_dir), ["user_id"], "ts", "10 hours", "5 hours",
                      [("min_value", "min", "value")])


# ---------------------------------------------------------------- AGG9
@register("running_min",
          "SELECT event_id, user_id, CASE WHEN row_number() OVER w = 1 THEN epoch_us(ts) // 1000 ELSE 0 END AS ts_ms, "
          "min(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_min "
          "FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def running_min_q(spark: SparkSession, sf_dir: str):
    ev = events(spark, sf_dir).select("event_id", "user_id", "ts", "value")
    # The reduce keeps the first row's timestamp and zeroes it afterwards: the
    # first row is the one with no earlier row of its key. Both in one pass.
    r = running_min(ev, "user_id", ORDER, "value", slice_col=seq_slice(spark), before="_before")
    r = r.withColumn("ts_ms", F.when(F.col("_before") == 0, F.floor(epoch_us("ts") / 1000)).otherwise(0)
                     .cast("long"))
    return r.select("event_id", "user_id", "ts_ms", "running_min")


# ---------------------------------------------------------------- AGG12
@register("unique_visitors",
          f"SELECT make_timestamp((epoch_us(ts) // {duration_us('1 hour')}) * {duration_us('1 hour')}) AS window_start, "
          f"make_timestamp((epoch_us(ts) // {duration_us('1 hour')}) * {duration_us('1 hour')} + "
          f"{duration_us('1 hour')}) AS window_end, count(DISTINCT user_id) AS uv FROM events "
          f"WHERE event_type = 'view' GROUP BY epoch_us(ts) // {duration_us('1 hour')}")
def unique_visitors_q(spark: SparkSession, sf_dir: str):
    views = events(spark, sf_dir).where(F.col("event_type") == "view")
    return unique_visitors(views, "ts", "user_id", "1 hour")


# ---------------------------------------------------------------- AGG13
@register("flag_repeats",
          "SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day, row_number() OVER "
          "(PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts, event_id) > 1 AS seen_before "
          "FROM events")
def flag_repeats_q(spark: SparkSession, sf_dir: str):
    ev = events(spark, sf_dir).select("event_id", "user_id", "event_type", "ts", F.to_date("ts").alias("day"))
    r = flag_repeats(ev, ["user_id", "event_type", "day"], ORDER, slice_col=seq_slice(spark))
    return r.select("event_id", "user_id", "event_type", "day", "seen_before")


# ---------------------------------------------------------------- WIN1/WIN2
@register("over_last3",
          "SELECT event_id, user_id, count(value) OVER w AS cnt, round(avg(value) OVER w, 4) AS avg_value "
          "FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id "
          "ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)")
def over_last3(spark: SparkSession, sf_dir: str):
    ev = events(spark, sf_dir).select("event_id", "user_id", "ts", "value")
    r = over_rows(ev, "user_id", ORDER, "value", preceding=2, slice_col=seq_slice(spark))
    return r.select("event_id", "user_id", "cnt", F.round("avg", 4).alias("avg_value"))


# ---------------------------------------------------------------- WIN3
@register("jump_flag",
          "SELECT event_id, user_id, value, lag(value, 1, 0.0) OVER w AS prev_value, "
          "abs(value - lag(value, 1, 0.0) OVER w) > 5 AS jumped FROM events "
          "WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def jump_flag_q(spark: SparkSession, sf_dir: str):
    ev = events(spark, sf_dir).select("event_id", "user_id", "ts", "value")
    r = jump_flag(ev, "user_id", ORDER, "value", 5.0, slice_col=seq_slice(spark))
    return r.select("event_id", "user_id", "value", "prev_value", "jumped")
