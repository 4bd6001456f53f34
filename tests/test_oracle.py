"""Every registered query against its DuckDB oracle at sf0.01 (the driver's correctness gate)."""

import pytest

import oracle_util
from conftest import SF001, SF01
from oracle_util import compare, duck

# compare doubles exactly, as a value hash does
oracle_util.STRICT = True
from eventide.operators import sequence  # noqa: E402
from eventide.plans import ORACLES, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    # 720 windows a row: millions of rows, so the smallest table does
    small = name == "geo_click_counts"
    r = compare(spark, name, SF001 if small else SF01, duck(SF001) if small else con)
    if name in ORACLES:
        assert r["cols_match"], r
        assert r["spark_rows"] == r["oracle_rows"], r
        assert r["values_match"], r
    else:
        assert r["spark_rows"] >= 0


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLES)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["window_end", "rank", "item_id", "cnt"]
    assert df.count() > 0
    assert set(QUERIES) <= set(e.queries()) and set(ORACLES) <= set(e.oracle_sql())
    # schema is stable across runs
    assert e.entry(spark).schema == df.schema
    assert QUERIES["hot_items_topn"](spark, SF001).count() == df.count()


SEQUENCE_QUERIES = ["over_last3", "jump_flag", "running_min", "flag_repeats", "late_rows", "rising_alert",
                    "rising_alert_rows", "rising_alert_repeat", "order_pay_result", "order_unpaid", "login_fail_pairs",
                    "login_fail_lists", "rise_pairs", "rise_timeouts", "not_next", "not_followed_by"]


@pytest.mark.parametrize("size", ["1 day", "10 minutes"])
@pytest.mark.parametrize("name", SEQUENCE_QUERIES)
def test_slice_length_does_not_change_results(spark, con, name, size, monkeypatch):
    monkeypatch.setattr(sequence, "HOT_ROWS", 5)      # users with more rows are cut into slices
    spark.conf.set("eventide.sequence.slice", size)
    try:
        r = compare(spark, name, SF01, con)
    finally:
        spark.conf.unset("eventide.sequence.slice")
    assert r["values_match"], r


WINDOW_QUERIES = ["sliding_count", "hot_items_topn", "marketing_counts", "url_topn", "geo_click_counts"]
MANY_WINDOWS = ("url_topn", "geo_click_counts")       # 120 and 720 windows a row: the smallest table, or the plain plan takes minutes


@pytest.mark.parametrize("plan,pane_min,delta_min", [("plain", 10**6, 10**6), ("pane", 2, 10**6),
                                                     ("delta", 2, 2)])
@pytest.mark.parametrize("name", WINDOW_QUERIES)
def test_window_plans_match_oracle(spark, con, name, plan, pane_min, delta_min):
    spark.conf.set("eventide.window.paneMinOverlap", str(pane_min))
    spark.conf.set("eventide.window.deltaMinOverlap", str(delta_min))
    small = name in MANY_WINDOWS
    try:
        r = compare(spark, name, SF001 if small else SF01, duck(SF001) if small else con)
    finally:
        spark.conf.unset("eventide.window.paneMinOverlap")
        spark.conf.unset("eventide.window.deltaMinOverlap")
    assert r["values_match"], (plan, r)
