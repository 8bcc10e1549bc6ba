import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pressgauge.functions.periods import half_open_hours
from pressgauge.operators import exposure as ex
from pressgauge.operators.grid import complete_series

T = datetime(2024, 1, 1)


@pytest.fixture()
def hours():
    return lambda n: half_open_hours(F.lit(T), F.lit(T + timedelta(hours=n)))


def test_every_entity_and_period_once(spark, rows, hours):
    a = spark.createDataFrame([("A", T, 3), ("X", T, 9), ("A", T + timedelta(hours=9), 5)], "s string, h timestamp, n bigint")
    b = spark.createDataFrame([("A", T, "p"), ("B", T + timedelta(hours=1), "q")], "s string, h timestamp, t string")
    names = spark.createDataFrame([("A",), ("B",), ("C",), ("A",)], "s string")
    got = complete_series(
        a.unionByName(b, allowMissingColumns=True), names, ["s"], "h", hours(2),
        {"n": F.lit(0).cast("bigint"), "t": F.lit("")},
    )
    one = T + timedelta(hours=1)
    assert rows(got, "s", "h", "n", "t") == {
        ("A", T, 3, "p"), ("A", one, 0, ""), ("B", T, 0, ""), ("B", one, 0, "q"), ("C", T, 0, ""), ("C", one, 0, "")
    }
    assert got.count() == 6


def test_grid_is_not_shuffled(spark, hours):
    a = spark.createDataFrame([("A", T, 3)], "s string, h timestamp, n bigint")
    got = complete_series(a, a.select("s"), ["s"], "h", hours(24), {"n": F.lit(0).cast("bigint")})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[:plan.index("Generate")]


def test_time_bounds_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "news")
    spark.createDataFrame(
        [("u", T, ["A"], "t", 1)], "url string, news_time timestamp, stock array<string>, title string, type int"
    ).write.parquet(path)
    news = spark.read.parquet(path)
    names = spark.createDataFrame([("A",)], "stock string")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        plan = ex.exposure(news, names, F.lit(T))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(news_time" in plan and "LessThanOrEqual(news_time" in plan
    assert "ReadSchema: struct<news_time:timestamp,stock:array<string>>" in plan


def test_a_year_of_hours_takes_linear_time(spark):
    """The plan looks up no list for every element."""
    n = 24 * 365
    periods = half_open_hours(F.lit(T), F.lit(T + timedelta(hours=n)))
    a = spark.range(50 * n).select(
        (F.col("id") % 50).cast("string").alias("s"), F.timestamp_seconds(F.lit(int(T.timestamp())) + F.col("id") % n * 7200).alias("h"), F.lit(1).alias("n"),
    )
    got = complete_series(a, a.select("s"), ["s"], "h", periods, {"n": F.lit(0)})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "array_contains" not in plan
    start = time.monotonic()
    assert got.count() == 50 * n
    assert time.monotonic() - start < 60


def test_a_row_of_the_grid_runs_no_lambda_and_formats_nothing(spark, rows, hours):
    """Constant periods are one list for all rows, and how they are shown is computed once for each period."""
    a = spark.createDataFrame([("A", T, 3), ("A", T + timedelta(hours=1), 4), ("X", T, 9)], "s string, h timestamp, n bigint")
    names = spark.createDataFrame([("A",), ("B",), (None,)], "s string")
    got = complete_series(
        a, names, ["s"], "h", hours(3), {"n": F.lit(0).cast("bigint")}, shown=lambda h: F.date_format(h, "HH:mm"),
    )
    assert rows(got, "s", "h", "n") == {
        ("A", "00:00", 3), ("A", "01:00", 4), ("A", "02:00", 0), *((s, f"0{k}:00", 0) for s in ("B", None) for k in range(3)),
    }
    assert got.count() == 9
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "transform(" not in plan
    assert "date_format" not in plan[:plan.index("BroadcastExchange")]
    assert "date_format" not in plan[:plan.index("Generate")]


def test_no_periods_give_no_rows(spark, hours):
    a = spark.createDataFrame([("A", T, 3)], "s string, h timestamp, n bigint")
    for periods in (hours(0), F.lit(None).cast("array<timestamp>")):
        assert complete_series(a, a.select("s"), ["s"], "h", periods, {"n": F.lit(0).cast("bigint")}).count() == 0
