"""Streaming queries, run over all input and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.functions.text import words
from pressgauge.queries import inputs as i
from pressgauge.session import run_path
from pressgauge.sources import tables
from pressgauge.streaming import hourly


def _visits(spark: SparkSession, d: str) -> DataFrame:
    # A glob, because a file stream wants a folder or a pattern rather than one file.
    raw = hourly.as_stream(spark, f"{d}/events*.parquet")
    return raw.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("http://n/"), F.col("event_id") % 5000).alias("url"), "user_id", "event_type", "props",
    )


def stream_hourly_visit(spark: SparkSession, d: str) -> DataFrame:
    out = hourly.drain_to_parquet(hourly.hourly_url_visits(_visits(spark, d)), "url-visits")
    return out.withColumn("hour", i.text_key("hour"))


def stream_stock_visit(spark: SparkSession, d: str) -> DataFrame:
    links = run_path(spark, "news-links")
    i.news(spark, d).select("url", "stock").write.parquet(links)
    visits = hourly.hourly_stock_visits(_visits(spark, d), spark.read.parquet(links))
    return hourly.drain_to_parquet(visits, "stock-visits").withColumn("hour", i.text_key("hour"))


def stream_exposure(spark: SparkSession, d: str) -> DataFrame:
    """News stream: the news table written to the shared folder as files, then streamed."""
    source = run_path(spark, "news-files")
    i.news(spark, d).select("news_id", "news_time", "stock").write.parquet(source)
    counts = hourly.hourly_stock_exposure(hourly.as_stream(spark, source))
    return hourly.drain_to_parquet(counts, "exposure").withColumn("hour", i.text_key("hour"))


def stream_terms(spark: SparkSession, d: str) -> DataFrame:
    """Terms of a visit: its event type and the words of its properties."""
    terms = _visits(spark, d).select(
        "ts", "user_id", F.explode(F.concat(F.array("event_type"), words(F.col("props")))).alias("term")
    )
    sums = hourly.drain_to_parquet(hourly.hourly_terms(terms), "terms")
    # What the stream has closed: an hour before its newest event.
    until = i.table(spark, d, "events").agg((F.max("ts").cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(1)))).first()[0]
    out = hourly.rolling_terms(sums, F.lit(until))
    return out.withColumn("window_start", i.text_key("window_start")).withColumn("window_end", i.text_key("window_end"))


def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Hourly visits per event type kept up to date in a metric table."""
    counts = (
        _visits(spark, d).withWatermark("ts", "1 hour").groupBy(F.window("ts", "1 day").alias("w"), "event_type")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "n")
    )
    path = run_path(spark, "stream-metrics")
    query = hourly.upsert_sink(counts, path, "visit", "day", "event_type", "n", run_path(spark, "stream-metrics-state"))
    query.awaitTermination()
    return tables.read_metric_table(spark, path)


def stream_hourly_open(spark: SparkSession, d: str) -> DataFrame:
    """Hourly visits per event type in a metric table, the last, still open hour included."""
    counts = (
        _visits(spark, d).withWatermark("ts", "1 hour").groupBy(F.window("ts", "1 hour").alias("w"), "event_type")
        .agg(F.count(F.lit(1)).alias("n")).select(hourly.hour_key(F.col("w.start")).alias("hour"), "event_type", "n")
    )
    path = run_path(spark, "stream-hours")
    query = hourly.upsert_sink(counts, path, "visitHour", "hour", "event_type", "n", run_path(spark, "stream-hours-state"))
    query.awaitTermination()
    return tables.read_metric_table(spark, path)


QUERIES = {
    "stream_hourly_open": (stream_hourly_open, """
SELECT 'visitHour' AS metric, strftime(ts, '%Y-%m-%d-%H') AS period, event_type AS entity, CAST(count(*) AS DOUBLE) AS value
FROM events GROUP BY ALL"""),
    "stream_hourly_visit": (stream_hourly_visit, """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, 'http://n/' || (event_id % 5000) AS url,
  count(*) AS visit FROM events
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY ALL"""),
    "stream_stock_visit": (stream_stock_visit, f"""WITH {i.SQL_NEWS}
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, stock, count(*) AS visit
FROM events JOIN heads ON url = 'http://n/' || (event_id % 5000) JOIN lines USING (news_id)
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY ALL"""),
    "stream_exposure": (stream_exposure, f"""WITH {i.SQL_NEWS}, n AS (SELECT * FROM heads JOIN lines USING (news_id))
SELECT strftime(date_trunc('hour', news_time), '%Y-%m-%d %H:%M:%S') AS hour, stock, count(*) AS exposure FROM n
WHERE date_trunc('hour', news_time) + INTERVAL 1 HOUR <= (SELECT max(news_time) FROM n) - INTERVAL 1 HOUR GROUP BY ALL"""),
    "stream_terms": (stream_terms, """
WITH t AS (SELECT ts, user_id, unnest(list_concat([event_type], regexp_extract_all(props, '[\\p{L}]+'))) AS term FROM events),
h AS (SELECT date_trunc('hour', ts) AS hour, user_id, term, count(*) AS n FROM t GROUP BY ALL),
w AS (SELECT hour - to_hours(CAST(k AS BIGINT)) AS s, user_id, term, CAST(sum(n) AS BIGINT) AS n FROM h, range(24) r(k) GROUP BY ALL)
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(s + INTERVAL 24 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
  user_id, term, n FROM w WHERE s + INTERVAL 24 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"""),
    "stream_upsert": (stream_upsert, """
SELECT 'visit' AS metric, strftime(ts, '%Y-%m-%d') AS period, event_type AS entity, CAST(count(*) AS DOUBLE) AS value
FROM events GROUP BY ALL"""),
}
