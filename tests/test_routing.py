"""Routing operators (RTE1-RTE3, SET1) on the sensor fixture."""

from pyspark.sql import functions as F

from fixtures import SENSORS, sensors
from eventide.operators.routing import branch_label, connect_map, route, route_label, side_output, split


def test_split_branches_partition_the_rows(spark):
    s = sensors(spark)
    parts = split(s, {"high": F.col("temperature") > 70, "mid": F.col("temperature") >= 65}, "low")
    counts = {k: v.count() for k, v in parts.items()}
    t = [r[3] for r in SENSORS]
    assert counts == {"high": sum(x > 70 for x in t), "mid": sum(65 <= x <= 70 for x in t), "low": sum(x < 65 for x in t)}
    labelled = s.select(branch_label({"high": F.col("temperature") > 70}, "low").alias("b"))
    assert {r.b: r["count"] for r in labelled.groupBy("b").count().collect()} == {"high": counts["high"], "low": len(t) - counts["high"]}


def test_side_output_keeps_every_main_row(spark):
    s = sensors(spark)
    main, side = side_output(s, F.col("temperature") < 40, F.concat(F.lit("alarm "), F.col("id")), ["line"])
    assert main.count() == len(SENSORS)
    assert sorted(r.line for r in side.collect()) == [r[0] for r in SENSORS if r[3] < 40]


def test_route_and_label_agree(spark):
    s = sensors(spark)
    dim, fact = route(s, "id", ["probe_a", "probe_c"])
    labels = {r.line: r.r for r in s.select("line", route_label("id", ["probe_a", "probe_c"]).alias("r")).collect()}
    assert {r.line for r in dim.collect()} == {k for k, v in labels.items() if v == "dim"}
    assert dim.count() + fact.count() == len(SENSORS)


def test_connect_map_two_shapes(spark):
    s = sensors(spark)
    out = connect_map(s.where("temperature > 70"), s.where("temperature <= 70"),
                      [F.col("id"), F.col("temperature"), F.lit("highWarning").alias("status")],
                      [F.col("id"), F.lit("health").alias("status")])
    rows = out.collect()
    assert len(rows) == len(SENSORS) and sum(r.temperature is None for r in rows) == sum(r[3] <= 70 for r in SENSORS)
