from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pressgauge.functions.periods import span
from pressgauge.operators import exposure as ex
from pressgauge.plans import stock
from pressgauge.sources import logs

T = datetime(2024, 1, 10, 5)
NEWS = "url string, news_time timestamp, stock array<string>"


def ts(t):
    return F.lit(t)


@pytest.fixture()
def stocks(spark):
    return spark.createDataFrame([("A",), ("B",), ("C",)], "stock string")


@pytest.fixture()
def news(spark):
    return spark.createDataFrame([
        ("u1", T, ["A", "B", "A"]), ("u2", T + timedelta(hours=1), ["A", "X"]),
        ("u1", T + timedelta(hours=1, seconds=1), ["B"]),
    ], NEWS)


def test_links_complete_the_dictionary(news, stocks):
    got = sorted(map(tuple, ex.stock_links(news, stocks).select("stock", "url").collect()), key=str)
    assert got == sorted([("A", "u1"), ("A", "u1"), ("A", "u2"), ("B", "u1"), ("B", "u1"), ("C", None)], key=str)


def test_boundary_item_counts_in_both_hours_when_closed(news, stocks, rows):
    first = ex.exposure(news, stocks, ts(T))
    second = ex.exposure(news, stocks, ts(T + timedelta(hours=1)))
    assert rows(first, "stock", "exposure") == {("A", 3), ("B", 1), ("C", 0)}
    assert rows(second, "stock", "exposure") == {("A", 1), ("B", 1), ("C", 0)}
    half_open = ex.exposure(news, stocks, ts(T), closed=False)
    assert rows(half_open, "stock", "exposure") == {("A", 2), ("B", 1), ("C", 0)}


def test_hourly_counts_equal_single_hours(news, stocks, rows):
    hourly = ex.hourly_exposure_counts(news)
    for h in (T, T + timedelta(hours=1)):
        single = {r for r in rows(ex.exposure(news, stocks, ts(h)), "stock", "exposure") if r[1]}
        assert {(s, n) for t, s, n in rows(hourly, "hour", "stock", "exposure") if t == h and s != "X"} == single


def test_half_open_hours_sum_to_the_day(news, rows):
    hourly = ex.hourly_exposure_counts(news, closed=False)
    total = hourly.groupBy("stock").agg(F.sum("exposure").alias("n"))
    assert rows(total, "stock", "n") == {("A", 3), ("B", 2), ("X", 1)}


def test_visits_sum_over_all_news_and_repeats(spark, news, stocks, rows):
    visits = spark.createDataFrame([("u1", 10), ("u1", 5), ("u9", 99)], "url string, cnt bigint")
    # u1 is A's news twice in one list, B's in two items.
    assert rows(ex.visit(news, stocks, visits), "stock", "visit") == {("A", 30), ("B", 30), ("C", 0)}


def test_trend_and_rate(spark, rows):
    now = spark.createDataFrame([("A", 3), ("B", 1), ("C", 2), ("D", 7), ("E", 0)], "s string, v bigint")
    old = spark.createDataFrame([("A", 2), ("B", 4), ("C", 2), ("E", 0)], "s string, v bigint")
    assert rows(ex.trend_between(now, old, "s", "v"), "s", "trend") == {("A", 1), ("B", -1), ("C", 0), ("E", 0)}
    assert rows(ex.rate_between(now, old, "s", "v"), "s", "rate") == {
        ("A", 0.5), ("B", -0.75), ("C", 0.0), ("E", 1.0)
    }


def test_series_skip_gaps(spark, rows):
    df = spark.createDataFrame(
        [("A", T, 1), ("A", T + timedelta(hours=1), 5), ("A", T + timedelta(hours=3), 9)],
        "s string, t timestamp, v bigint",
    )
    got = ex.trend_series(df, "t", "v", span(hours=1), ["s"])
    assert rows(got, "s", "t", "trend") == {("A", T + timedelta(hours=1), 1)}


def test_roll_up_windows_may_overlap(spark, rows):
    days = [(datetime(2024, 1, d), "A", d) for d in range(1, 11)]
    daily = spark.createDataFrame(days, "day timestamp, stock string, visit bigint")
    starts = F.expr("array(date'2024-01-01', date'2024-01-03')")
    got = ex.roll_up(daily, "day", starts, 7, ["visit"], ["stock"])
    assert {(str(a), v) for a, v in rows(got, "period_start", "visit")} == {
        ("2024-01-01", sum(range(1, 8))), ("2024-01-03", sum(range(3, 10)))
    }


def test_daily_history_gives_zeros_for_missing_days(spark, news, stocks, rows):
    visits = spark.createDataFrame([(T, "u1", 4)], "hour timestamp, url string, cnt bigint")
    start, end = ts(datetime(2024, 1, 9)), ts(datetime(2024, 1, 11))
    kept = logs.without_periods(visits, ["2024-01-10"])
    got = stock.daily_history(news, stocks, kept, start, end)
    assert got.count() == 6
    assert {r["visit"] for r in got.collect()} == {0}
    got = stock.daily_history(news, stocks, visits, start, end)
    assert rows(got.where(F.dayofmonth("day") == 10), "stock", "visit", "trend") == {
        ("A", 8, 1), ("B", 8, 1), ("C", 0, 0)
    }


def test_hot_stock_is_aggregated_before_the_dictionary_join(news, stocks):
    plan = ex.exposure(news, stocks, ts(T))._jdf.queryExecution().executedPlan().toString()
    join = plan.index("Join")
    assert "partial_count" in plan[join:]


def test_links_join_can_split_a_hot_stock(news, stocks):
    plan = ex.stock_links(news, stocks)._jdf.queryExecution().optimizedPlan().toString()
    assert "RightOuter" not in plan and "Join Inner" in plan
