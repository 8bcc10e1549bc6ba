"""Event exposure, platforms, visits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pressgauge.operators import events as ev
from pressgauge.operators import records
from pressgauge.queries import inputs as i

AS_OF = "2024-01-10 06:00:00"


def _valid(spark: SparkSession, d: str) -> DataFrame:
    return records.valid_events(i.event_table(spark, d))


def event_expansion(spark: SparkSession, d: str) -> DataFrame:
    return ev.expand_events(_valid(spark, d), i.news_heads(spark, d))


def event_exposure(spark: SparkSession, d: str) -> DataFrame:
    return ev.exposure(_valid(spark, d), i.news_heads(spark, d), i.ts(AS_OF), 1)


def event_visit(spark: SparkSession, d: str) -> DataFrame:
    return ev.visit(_valid(spark, d), i.news_heads(spark, d), i.visits(spark, d))


def event_metrics(spark: SparkSession, d: str) -> DataFrame:
    return ev.metrics(_valid(spark, d), i.news_heads(spark, d), i.visits(spark, d), i.ts(AS_OF), 1)


def event_hourly(spark: SparkSession, d: str) -> DataFrame:
    return ev.hourly_metrics(
        _valid(spark, d), i.news_heads(spark, d), i.visits(spark, d), i.ts(i.START), i.ts(i.END), hours_back=1,
        shown=i.text_key,
    )


def event_news(spark: SparkSession, d: str) -> DataFrame:
    out = records.news_of_events(i.news_heads(spark, d), _valid(spark, d))
    return out.withColumn("news_time", i.text_key("news_time"))


_BASE = f"WITH {i.SQL_HEADS}, {i.SQL_EVENTS}, {i.SQL_VISITS}, valid AS (SELECT * FROM event_news WHERE is_valid = 1)"
_EXPOSURE = """
exposed AS (
  SELECT event_id, event_name, count(h.news_id) AS exposure,
    coalesce(string_agg(DISTINCT platform, ',' ORDER BY platform), '') AS platforms
  FROM valid LEFT JOIN (SELECT * FROM heads
    WHERE news_time >= TIMESTAMP '2024-01-10 05:00:00' AND news_time < TIMESTAMP '2024-01-10 06:00:00') h
  USING (news_id) GROUP BY ALL)"""
_VISIT = """
visited AS (
  SELECT event_id, event_name, CAST(coalesce(sum(cnt), 0) AS BIGINT) AS visit
  FROM valid LEFT JOIN heads USING (news_id) LEFT JOIN visits USING (url) GROUP BY ALL)"""

QUERIES = {
    "event_expansion": (event_expansion, f"""{_BASE}
SELECT event_id, event_name, valid.news_id, coalesce(platform, 'no') AS platform, coalesce(url, 'no') AS url
FROM valid LEFT JOIN heads USING (news_id)"""),
    "event_exposure": (event_exposure, f"{_BASE}, {_EXPOSURE} SELECT * FROM exposed"),
    "event_visit": (event_visit, f"{_BASE}, {_VISIT} SELECT * FROM visited"),
    "event_metrics": (event_metrics, f"""{_BASE}, {_EXPOSURE}, {_VISIT}
SELECT * FROM exposed JOIN visited USING (event_id, event_name)"""),
    "event_hourly": (event_hourly, f"""{_BASE},
e AS (SELECT date_trunc('hour', news_time) + INTERVAL 1 HOUR AS hour, event_id, count(*) AS exposure,
    string_agg(DISTINCT platform, ',' ORDER BY platform) AS platforms
  FROM valid JOIN heads USING (news_id) GROUP BY ALL),
v AS (SELECT hour, event_id, CAST(sum(cnt) AS BIGINT) AS visit
  FROM valid JOIN heads USING (news_id) JOIN visits USING (url) GROUP BY ALL),
g AS (SELECT hour, event_id, event_name FROM (SELECT DISTINCT event_id, event_name FROM valid),
  generate_series(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR) t(hour))
SELECT strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour, event_id, event_name, coalesce(exposure, 0) AS exposure,
  coalesce(platforms, '') AS platforms, coalesce(visit, 0) AS visit
FROM g LEFT JOIN e USING (hour, event_id) LEFT JOIN v USING (hour, event_id)"""),
    "event_news": (event_news, f"""{_BASE}
SELECT news_id, strftime(news_time, '%Y-%m-%d %H:%M:%S') AS news_time, platform, url FROM heads
WHERE news_id IN (SELECT news_id FROM valid)"""),
}
