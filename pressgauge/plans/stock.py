"""Stock jobs: daily, hourly, weekly and monthly metrics, rankings and growth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgauge.functions.periods import half_open_hours, span
from pressgauge.operators import exposure as ex
from pressgauge.operators.grid import complete_series
from pressgauge.sources import rankings


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def _days(start: Column, end: Column) -> Column:
    return F.filter(F.sequence(start, end, span(days=1)), lambda d: d < end)


def daily_history(
    news: DataFrame, stock_dict: DataFrame, visits: DataFrame, start: Column, end: Column,
    exposure_hours: int = 1,
) -> DataFrame:
    """``day, stock, exposure, visit, trend`` for every dictionary stock and day in ``[start, end)``.

    Exposure counts the news from midnight to ``exposure_hours`` later, that point included; 24 gives
    the whole day. Trend compares visits with the day before and is null on the first day.
    """
    width = span(hours=exposure_hours)
    t = F.col("news_time")
    midnight = F.date_trunc("day", t)
    # A whole day's closed bound is the next midnight, which also belongs to that next day.
    on_edge = (t == midnight) & F.lit(exposure_hours == 24)
    days = F.when(on_edge, F.array(midnight, midnight - span(days=1))).otherwise(F.array(midnight))
    exposed = (
        news.where((t >= start) & (t <= end) & (t <= midnight + width))
        .select(F.explode(days).alias("day"), "stock").select("day", F.explode("stock").alias("stock"))
        .groupBy("day", "stock").agg(F.count(F.lit(1)).alias("exposure"))
    )
    in_range = visits.where((F.col("hour") >= start) & (F.col("hour") < end))
    visited = ex.visited_stocks(news, in_range.withColumn("day", F.date_trunc("day", "hour")), ["day"])
    full = complete_series(
        exposed.unionByName(visited, allowMissingColumns=True), stock_dict, ["stock"], "day", _days(start, end),
        {"exposure": _zero(), "visit": _zero()},
    )
    return _with_trend(full, "day", span(days=1))


def hourly_history(
    news: DataFrame, stock_dict: DataFrame, visits: DataFrame, start: Column, end: Column
) -> DataFrame:
    """``hour, stock, exposure, visit, trend`` for every dictionary stock and hour in ``[start, end)``."""
    t = F.col("news_time")
    exposed = ex.hourly_exposure_counts(news.where((t >= start) & (t <= end)))
    in_range = visits.where((F.col("hour") >= start) & (F.col("hour") < end))
    visited = ex.visited_stocks(news, in_range, ["hour"])
    full = complete_series(
        exposed.unionByName(visited, allowMissingColumns=True), stock_dict, ["stock"], "hour",
        half_open_hours(start, end), {"exposure": _zero(), "visit": _zero()},
    )
    return _with_trend(full, "hour", span(hours=1))


def _with_trend(full: DataFrame, period: str, step: Column) -> DataFrame:
    previous = ex.with_previous(full, period, "visit", step, ["stock"])
    return previous.select(
        period, "stock", "exposure", "visit", ex.trend(F.col("visit"), F.col("previous")).alias("trend")
    )


def hourly_visit_ranking(
    news: DataFrame, stock_dict: DataFrame, visits: DataFrame, start: Column, end: Column
) -> DataFrame:
    """``hour, stock, visit, place`` for every dictionary stock and hour."""
    return ex.hourly_ranking(_hourly_visits(news, stock_dict, visits, start, end))


def write_hourly_visit_ranking(
    news: DataFrame, stock_dict: DataFrame, visits: DataFrame, start: Column, end: Column, path: str, kind: str = "parquet",
) -> None:
    """The same as files, a sorted folder an hour, without any task that holds an hour."""
    rankings.write_ranking(_hourly_visits(news, stock_dict, visits, start, end), path, "hour", "visit", "stock", kind)


def _hourly_visits(news: DataFrame, stock_dict: DataFrame, visits: DataFrame, start: Column, end: Column) -> DataFrame:
    in_range = visits.where((F.col("hour") >= start) & (F.col("hour") < end))
    visited = ex.visited_stocks(news, in_range, ["hour"])
    return complete_series(
        visited, stock_dict, ["stock"], "hour", half_open_hours(start, end), {"visit": _zero()}
    )


def period_history(
    daily: DataFrame, starts: Column, length: int, step: Column, values: tuple[str, ...] = ("visit", "exposure")
) -> DataFrame:
    """``period_start, stock``, summed values and visit trend against the period one ``step`` earlier.

    ``daily`` has ``day, stock`` and the values. For weeks ``length`` is 7 and ``step`` seven days.
    """
    sums = ex.roll_up(daily, "day", starts, length, list(values), ["stock"])
    previous = ex.with_previous(sums, "period_start", values[0], step, ["stock"])
    return previous.select(
        "period_start", "stock", *values,
        ex.trend(F.col(values[0]), F.col("previous")).alias("trend"),
    )
