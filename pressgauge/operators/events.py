"""News-event metrics: exposure, platforms and visits of the news that an event gathers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgauge.functions.periods import half_open_hours, span
from pressgauge.operators.grid import complete_series
from pressgauge.operators.records import NO_NEWS

EVENT = ["event_id", "event_name"]


def event_links(events: DataFrame) -> DataFrame:
    """``event_id, event_name, news_id``, one row per listing."""
    return events.select(*EVENT, F.explode("related_news").alias("news_id"))


def expand_events(events: DataFrame, news: DataFrame) -> DataFrame:
    """Every listing with the platform and url of its news, ``no`` where the news is unknown."""
    found = event_links(events).join(news.select("news_id", "platform", "url"), "news_id", "left")
    return found.select(
        *EVENT, "news_id",
        F.coalesce("platform", F.lit(NO_NEWS)).alias("platform"),
        F.coalesce("url", F.lit(NO_NEWS)).alias("url"),
    )


def _exposed(events: DataFrame, news: DataFrame, keys: list[str]) -> DataFrame:
    known = news.where(F.col("platform") != NO_NEWS).select("news_id", "platform", *keys)
    # Per platform first: the platform list of a hot event is merged from at most one row per
    # platform and map task.
    per_platform = (
        event_links(events).join(known, "news_id")
        .groupBy(*keys, *EVENT, "platform").agg(F.count(F.lit(1)).alias("n"))
    )
    return per_platform.groupBy(*keys, *EVENT).agg(
        F.sum("n").alias("exposure"),
        F.array_join(F.array_sort(F.collect_list("platform")), ",").alias("platforms"),
    )


def exposure(events: DataFrame, news: DataFrame, as_of: Column, hours_back: int) -> DataFrame:
    """``event_id, event_name, exposure, platforms`` of the half-open hour that starts ``hours_back``
    before ``as_of``; events without news in it have zero and an empty list."""
    start = as_of - span(hours=hours_back)
    t = F.col("news_time")
    hit = _exposed(events, news.where((t >= start) & (t < start + span(hours=1))), [])
    return events.select(*EVENT).distinct().join(hit, EVENT, "left").select(
        *EVENT, F.coalesce("exposure", F.lit(0)).cast("bigint").alias("exposure"),
        F.coalesce("platforms", F.lit("")).alias("platforms"),
    )


def _visited(events: DataFrame, news: DataFrame, visits: DataFrame, keys: list[str]) -> DataFrame:
    per_url = visits.groupBy(*keys, "url").agg(F.sum("cnt").alias("cnt"))
    per_news = news.select("news_id", "url").join(per_url, "url").select(*keys, "news_id", "cnt")
    return (
        event_links(events).join(per_news, "news_id")
        .groupBy(*keys, *EVENT).agg(F.sum("cnt").alias("visit"))
    )


def visit(events: DataFrame, news: DataFrame, visits: DataFrame) -> DataFrame:
    """``event_id, event_name, visit``: visits of the event's urls, repeats counted, zero if none."""
    hit = _visited(events, news, visits, [])
    return events.select(*EVENT).distinct().join(hit, EVENT, "left").select(
        *EVENT, F.coalesce("visit", F.lit(0)).cast("bigint").alias("visit")
    )


def metrics(events: DataFrame, news: DataFrame, visits: DataFrame, as_of: Column, hours_back: int) -> DataFrame:
    """Exposure, platforms and visits per event for one hour."""
    return exposure(events, news, as_of, hours_back).join(visit(events, news, visits), EVENT)


def hourly_metrics(
    events: DataFrame, news: DataFrame, visits: DataFrame, start: Column, end: Column, hours_back: int = 0,
    shown: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """``hour``, event, ``exposure, platforms, visit`` for every event and each hour in ``[start, end)``.

    One pass instead of one run per hour; ``hours_back`` shifts the news window. The time bounds are
    plain comparisons, so they reach the scans of both logs. ``shown`` is how an hour is given in the result.
    """
    shift = span(hours=hours_back)
    t = F.col("news_time")
    in_range = news.where((t >= start - shift) & (t < end - shift))
    exposed = _exposed(events, in_range.withColumn("hour", F.date_trunc("hour", t) + shift), ["hour"])
    read = visits.where((F.col("hour") >= start) & (F.col("hour") < end))
    visited = _visited(events, news, read, ["hour"])
    zero = F.lit(0).cast("bigint")
    return complete_series(
        exposed.unionByName(visited, allowMissingColumns=True), events, EVENT, "hour", half_open_hours(start, end),
        {"exposure": zero, "platforms": F.lit(""), "visit": zero}, shown,
    )
