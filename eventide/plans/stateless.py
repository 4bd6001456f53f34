"""Scans, sinks of the scan family, projections, filters, routing and scalar functions."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from eventide.functions.jsonfn import json_objects_only
from eventide.functions.strings import java_string_hash, register_string_hash
from eventide.operators.routing import branch_label, connect_map, route, route_label, side_output
from eventide.plans.inputs import SQL_K, events, prop_k
from eventide.session import scratch_path
from eventide.sinks.bus import to_topic_frame
from eventide.sinks.files import insert_csv
from eventide.sources.bus import decode_records, parse_csv_payload
from eventide.sources.catalog import read_table, save_table
from eventide.sources.files import register_csv_table, scan_access_log, scan_csv
from eventide.plans.registry import register

EVENTS_DDL = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def _view(spark, sf_dir, name="events"):
    """A session temp view over the events table, unique per input directory."""
    v = f"{name}_{abs(hash(sf_dir)) % 10**8}"
    events(spark, sf_dir).createOrReplaceTempView(v)
    return v


# ---------------------------------------------------------------- SRC1/SRC2
@register("csv_scan", "SELECT * FROM events")
def csv_scan(spark: SparkSession, sf_dir: str):
    path = scratch_path(spark, "csv_scan")
    insert_csv(events(spark, sf_dir), path)
    return scan_csv(spark, path, EVENTS_DDL)


# ---------------------------------------------------------------- SNK2 + SRC4
@register("csv_roundtrip", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def csv_roundtrip(spark: SparkSession, sf_dir: str):
    path = scratch_path(spark, "csv_table")
    rows = events(spark, sf_dir).where(F.col("event_type") == "purchase").select("event_id", "user_id", "value")
    insert_csv(rows, path)
    name = f"purchases_csv_{abs(hash(path)) % 10**8}"
    register_csv_table(spark, name, path, "event_id BIGINT, user_id BIGINT, value DOUBLE")
    return spark.sql(f"SELECT event_id, user_id, value FROM {name}")


# ---------------------------------------------------------------- SRC3, FUN1, FUN3
def access_lines(df):
    """One access-log line per event: ip - user time zone method url."""
    ip = F.concat_ws(".", F.lit("10"), (F.col("user_id") % 256).cast("string"),
                     (F.col("event_id") % 256).cast("string"), F.lit("1"))
    method = F.when(F.col("event_type").isin("view", "click"), "GET").otherwise("POST")
    return df.select(F.concat_ws(" ", ip, F.lit("-"), F.col("user_id").cast("string"),
                                 F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"), method,
                                 F.concat(F.lit("/p/"), prop_k().cast("string"))).alias("value"))


@register("access_log_parse",
          "SELECT '10.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) || '.1' AS ip, "
          "CAST(user_id AS VARCHAR) AS user_id, date_trunc('second', ts) AS event_time, "
          "CASE WHEN event_type IN ('view', 'click') THEN 'GET' ELSE 'POST' END AS method, "
          f"'/p/' || CAST({SQL_K} AS VARCHAR) AS url FROM events")
def access_log_parse(spark: SparkSession, sf_dir: str):
    path = scratch_path(spark, "access_log")
    access_lines(events(spark, sf_dir)).write.text(path)
    return scan_access_log(spark, path)


# ---------------------------------------------------------------- SRC5 payload, FUN2
@register("csv_payload_parse", "SELECT event_id, user_id, event_type, value FROM events")
def csv_payload_parse(spark: SparkSession, sf_dir: str):
    payload = events(spark, sf_dir).select(
        F.concat_ws(",", "event_id", "user_id", "event_type", F.col("value").cast("string")).alias("value"))
    return parse_csv_payload(payload, "value", "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE")


# ---------------------------------------------------------------- SRC4/PRJ1/FLT1/UDF6
@register("table_select", "SELECT event_id, value FROM events WHERE event_type = 'click'")
def table_select(spark: SparkSession, sf_dir: str):
    v = _view(spark, sf_dir)
    return spark.sql(f"SELECT event_id, value FROM {v} WHERE event_type = 'click'")


# ---------------------------------------------------------------- SRC7
@register("catalog_roundtrip", "SELECT event_id, user_id, event_type, value FROM events")
def catalog_roundtrip(spark: SparkSession, sf_dir: str):
    path = scratch_path(spark, "catalog")
    name = "eventide_events_" + path.rsplit("-", 1)[-1][:12]
    save_table(events(spark, sf_dir).select("event_id", "user_id", "event_type", "value"), name, path)
    return read_table(spark, name)


# ---------------------------------------------------------------- FLT2
@register("filter_threshold", "SELECT event_id, user_id, value FROM events WHERE value > 70")
def filter_threshold(spark: SparkSession, sf_dir: str):
    return events(spark, sf_dir).where(F.col("value") > 70).select("event_id", "user_id", "value")


# ---------------------------------------------------------------- RTE1
@register("split_high_low",
          "SELECT event_id, value, CASE WHEN value > 40 THEN 'high' ELSE 'low' END AS branch FROM events")
def split_high_low(spark: SparkSession, sf_dir: str):
    # the labelled stream in one scan; `split` gives the per-branch views of it
    return events(spark, sf_dir).select("event_id", "value",
                                        branch_label({"high": F.col("value") > 40}, "low").alias("branch"))


# ---------------------------------------------------------------- RTE2, FUN6
# Fixed value: the side-output alarm text, with the reading's id and value.
ALARM_FORMAT = "freezing-alarm for {id},temperature is {value}"


@register("side_output_alarm",
          "SELECT event_id, 'freezing-alarm for ' || CAST(user_id AS VARCHAR) || ',temperature is ' || "
          "CAST(value AS VARCHAR) AS alarm FROM events WHERE value < 5")
def side_output_alarm(spark: SparkSession, sf_dir: str):
    head, tail = ALARM_FORMAT.split("{id}")
    mid = tail.split("{value}")[0]
    text = F.concat(F.lit(head), F.col("user_id").cast("string"), F.lit(mid), F.col("value").cast("string"))
    _, side = side_output(events(spark, sf_dir), F.col("value") < 5, text, ["event_id"])
    return side


# ---------------------------------------------------------------- RTE3 (+ SNK6 input)
DIM_TOPICS = ["signup", "error"]


@register("route_dim_fact",
          "SELECT event_id, event_type AS topic, CASE WHEN event_type IN ('signup', 'error') THEN 'dim' "
          "ELSE 'fact' END AS route FROM events")
def route_dim_fact(spark: SparkSession, sf_dir: str):
    ev = events(spark, sf_dir).select("event_id", F.col("event_type").alias("topic"))
    return ev.withColumn("route", route_label("topic", DIM_TOPICS))


# ---------------------------------------------------------------- SNK3, FUN9
@register("dwd_topic_frame",
          "SELECT 'dwd' || event_type AS topic, CAST(NULL AS BLOB) IS NULL AS key_is_null, props AS value_text "
          "FROM events WHERE event_type NOT IN ('signup', 'error')")
def dwd_topic_frame(spark: SparkSession, sf_dir: str):
    # bus records as they come (binary values), decoded, routed and framed again
    raw = events(spark, sf_dir).select(F.col("event_type").alias("topic"), F.encode("props", "UTF-8").alias("value"))
    _, fact = route(decode_records(raw), "topic", DIM_TOPICS)
    frame = to_topic_frame(fact)
    return frame.select("topic", F.col("key").isNull().alias("key_is_null"),
                        F.decode("value", "UTF-8").alias("value_text"))


# ---------------------------------------------------------------- FLT3, FUN8
# every row's text is parsed: as it is, in an array, cut short, after blanks
_PAYLOAD = ("CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN '[' || props || ']' "
            "WHEN 2 THEN substr(props, 1, length(props) - 1) ELSE '  ' || props END")


@register("json_object_filter",
          f"SELECT event_id, payload FROM (SELECT event_id, {_PAYLOAD} AS payload FROM events) "
          "WHERE json_valid(payload) AND json_type(payload) = 'OBJECT'")
def json_object_filter(spark: SparkSession, sf_dir: str):
    ev = events(spark, sf_dir).select("event_id", F.expr(_PAYLOAD).alias("payload"))
    return json_objects_only(ev, "payload")


# ---------------------------------------------------------------- SET1, PRJ2
@register("connect_union",
          "SELECT event_id, user_id, value, 'highWarning' AS status FROM events WHERE value > 70 "
          "UNION ALL SELECT event_id, user_id, NULL AS value, 'health' AS status FROM events WHERE NOT value > 70")
def connect_union(spark: SparkSession, sf_dir: str):
    ev = events(spark, sf_dir)
    high, low = ev.where(F.col("value") > 70), ev.where(~(F.col("value") > 70))
    return connect_map(high, low,
                       [F.col("event_id"), F.col("user_id"), F.col("value"), F.lit("highWarning").alias("status")],
                       [F.col("event_id"), F.col("user_id"), F.lit("health").alias("status")])


# ---------------------------------------------------------------- FUN11
_SQL_HASH = ("CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INTEGER)")
_SQL_HASH_SRC = ("SELECT event_id, event_type, (list_reduce([0] || list_transform(string_split(event_type, ''), "
                 "lambda c: ord(c)), lambda a, x: (a * 31 + x) % 4294967296) * 10) % 4294967296 AS h FROM events")


@register("string_hash", f"SELECT event_id, event_type, {_SQL_HASH} AS hash_code FROM ({_SQL_HASH_SRC})")
def string_hash(spark: SparkSession, sf_dir: str):
    ev = events(spark, sf_dir)
    return ev.select("event_id", "event_type", java_string_hash(F.col("event_type"), 10).alias("hash_code"))


# ---------------------------------------------------------------- UDF1
@register("string_hash_sql", f"SELECT event_id, {_SQL_HASH} AS hash_code FROM ({_SQL_HASH_SRC})")
def string_hash_sql(spark: SparkSession, sf_dir: str):
    register_string_hash(spark, "hash_code10", 10)
    v = _view(spark, sf_dir)
    return spark.sql(f"SELECT event_id, hash_code10(event_type) AS hash_code FROM {v}")
