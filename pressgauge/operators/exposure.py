"""Stock metrics: exposure (how often news name a stock) and visits (how often that news is read).

Every measure is aggregated per stock *before* it meets the dictionary, so the completion join is
between two tables of dictionary size and no hot stock travels through a shuffle row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pressgauge.functions.metrics import increase_rate, trend
from pressgauge.functions.periods import span


def stock_links(news: DataFrame, stock_dict: DataFrame) -> DataFrame:
    """``stock, url, news_time``: one row per listing of a dictionary stock, a null row for a stock
    without news; stocks outside the dictionary vanish, repeats within a list stay.

    An inner join and the missing stocks rather than one right join: Spark can broadcast the
    dictionary or split a hot stock in the former, and in the latter neither.
    """
    links = news.select(F.explode("stock").alias("stock"), "url", "news_time")
    names = stock_dict.select("stock").distinct()
    unseen = names.join(links.select("stock").distinct(), "stock", "left_anti")
    return links.join(names, "stock").unionByName(unseen, allowMissingColumns=True)


def complete(stock_dict: DataFrame, measures: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """Every dictionary key with its measures, absent ones as zero."""
    keys = keys or ["stock"]
    full = stock_dict.select(*keys).distinct().join(measures, keys, "left")
    return full.select(*keys, *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in columns])


def exposure(
    news: DataFrame, stock_dict: DataFrame, start: Column, hours: int = 1, closed: bool = True
) -> DataFrame:
    """``stock, exposure``: news in ``[start, start + hours]``, zero if none.

    The upper bound is closed by default, so an item on it counts here and in the next window too.
    """
    t = F.col("news_time")
    end = start + span(hours=hours)
    upper = (t <= end) if closed else (t < end)
    counts = (
        news.where((t >= start) & upper)
        .select(F.explode("stock").alias("stock"))
        .groupBy("stock").agg(F.count(F.lit(1)).alias("exposure"))
    )
    return complete(stock_dict, counts, ["exposure"])


def hour_memberships(t: Column, closed: bool = True) -> Column:
    """Starts of the hour windows that hold ``t``: two of them when it lies on a closed boundary."""
    hour = F.date_trunc("hour", t)
    if not closed:
        return F.array(hour)
    return F.when(hour == t, F.array(hour, hour - span(hours=1))).otherwise(F.array(hour))


def hourly_exposure_counts(news: DataFrame, closed: bool = True) -> DataFrame:
    """``hour, stock, exposure`` for every hour with news, in one pass over the news."""
    return (
        news.select(F.explode(hour_memberships(F.col("news_time"), closed)).alias("hour"), "stock")
        .select("hour", F.explode("stock").alias("stock"))
        .groupBy("hour", "stock").agg(F.count(F.lit(1)).alias("exposure"))
    )


def visited_stocks(news: DataFrame, visits: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, stock, visit``: visits of all news of a stock, whatever the news time.

    ``visits`` is summed per url first. The join is many-to-one on the url, keeps only visited news
    and carries the unexploded stock list, so the shuffle is as narrow as it gets.
    """
    per_url = visits.groupBy(*keys, "url").agg(F.sum("cnt").alias("cnt"))
    return (
        news.select("url", "stock").join(per_url, "url")
        .select(*keys, F.explode("stock").alias("stock"), "cnt")
        .groupBy(*keys, "stock").agg(F.sum("cnt").alias("visit"))
    )


def visit(news: DataFrame, stock_dict: DataFrame, visits: DataFrame) -> DataFrame:
    """``stock, visit``: url visits summed over all news of the stock, zero if none."""
    return complete(stock_dict, visited_stocks(news, visits, []), ["visit"])


def trend_between(now: DataFrame, before: DataFrame, key: str, value: str) -> DataFrame:
    """``key, trend`` of entities present in both periods."""
    old = before.select(key, F.col(value).alias("_before"))
    return now.join(old, key).select(key, trend(F.col(value), F.col("_before")).alias("trend"))


def rate_between(now: DataFrame, before: DataFrame, key: str, value: str) -> DataFrame:
    """``key, rate`` of entities present in both periods."""
    old = before.select(key, F.col(value).alias("_before"))
    return now.join(old, key).select(key, increase_rate(F.col(value), F.col("_before")).alias("rate"))


def with_previous(df: DataFrame, period: str, value: str, step: Column, keys: list[str]) -> DataFrame:
    """Add ``previous``, the value exactly one ``step`` earlier (null when that period is absent).

    One shuffle for the whole history. ``df`` has one row per key and period.
    """
    w = W.partitionBy(*keys).orderBy(period)
    adjacent = F.lag(period).over(w) == F.col(period) - step
    return df.withColumn("previous", F.when(adjacent, F.lag(value).over(w)))


def trend_series(df: DataFrame, period: str, value: str, step: Column, keys: list[str]) -> DataFrame:
    """``keys, period, trend`` for each period whose predecessor exists."""
    return (
        with_previous(df, period, value, step, keys).where(F.col("previous").isNotNull())
        .select(*keys, period, trend(F.col(value), F.col("previous")).alias("trend"))
    )


def rate_series(df: DataFrame, period: str, value: str, step: Column, keys: list[str]) -> DataFrame:
    """``keys, period, rate`` for each period whose predecessor exists."""
    return (
        with_previous(df, period, value, step, keys).where(F.col("previous").isNotNull())
        .select(*keys, period, increase_rate(F.col(value), F.col("previous")).alias("rate"))
    )


def roll_up(daily: DataFrame, day: str, starts: Column, length: int, values: list[str], keys: list[str]) -> DataFrame:
    """Sums over ``length`` consecutive days from each of the ``starts`` (an array of dates) on.

    Day rows find their windows by arithmetic on the row, not by a join; windows may overlap.
    """
    d = F.col(day).cast("date")
    hit = F.filter(starts, lambda s: (d >= s) & (d < F.date_add(s, length)))
    return (
        daily.select(F.explode(hit).alias("period_start"), *keys, *values)
        .groupBy("period_start", *keys)
        .agg(*[F.sum(v).cast("bigint").alias(v) for v in values])
    )


def hourly_ranking(hourly: DataFrame, value: str = "visit") -> DataFrame:
    """Rows with their place within the hour, largest first, ties by stock.

    An hour holds one row per dictionary stock, so a window partition is of dictionary size.
    """
    w = W.partitionBy("hour").orderBy(F.desc(value), "stock")
    return hourly.withColumn("place", F.row_number().over(w))
