"""Stock exposure, visits, trends, rankings, roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.functions.periods import span
from pressgauge.operators import exposure as ex
from pressgauge.plans import stock
from pressgauge.queries import inputs as i
from pressgauge.session import run_path



def stock_links(spark: SparkSession, d: str) -> DataFrame:
    links = ex.stock_links(i.news(spark, d), i.stock_dict(spark, d))
    return links.select("stock", "url", i.text_key("news_time").alias("news_time"))


def stock_exposure(spark: SparkSession, d: str) -> DataFrame:
    return ex.exposure(i.news(spark, d), i.stock_dict(spark, d), i.ts("2024-01-10 05:00:00"))


def stock_visit(spark: SparkSession, d: str) -> DataFrame:
    return ex.visit(i.news(spark, d), i.stock_dict(spark, d), i.visits(spark, d))


def stock_daily(spark: SparkSession, d: str) -> DataFrame:
    out = stock.daily_history(
        i.news(spark, d), i.stock_dict(spark, d), i.visits(spark, d), i.ts(i.START), i.ts(i.END)
    )
    return out.withColumn("day", i.text_key("day", "yyyy-MM-dd"))


def stock_whole_day(spark: SparkSession, d: str) -> DataFrame:
    out = stock.daily_history(
        i.news(spark, d), i.stock_dict(spark, d), i.visits(spark, d), i.ts(i.START), i.ts(i.END), exposure_hours=24
    )
    return out.select(i.text_key("day", "yyyy-MM-dd").alias("day"), "stock", "exposure")


def stock_hourly(spark: SparkSession, d: str) -> DataFrame:
    out = stock.hourly_history(
        i.news(spark, d), i.stock_dict(spark, d), i.visits(spark, d), i.ts(i.START), i.ts(i.END)
    )
    return out.withColumn("hour", i.text_key("hour"))


def stock_hour_ranking(spark: SparkSession, d: str) -> DataFrame:
    """One window partition per hour, of as many rows as the dictionary has stocks."""
    out = stock.hourly_visit_ranking(
        i.news(spark, d), i.stock_dict(spark, d), i.visits(spark, d), i.ts(i.START), i.ts(i.END)
    )
    return out.withColumn("hour", i.text_key("hour"))


def stock_hour_ranking_files(spark: SparkSession, d: str) -> DataFrame:
    """The same, read from its files."""
    path = run_path(spark, "hour-ranking")
    stock.write_hourly_visit_ranking(
        i.news(spark, d), i.stock_dict(spark, d), i.visits(spark, d), i.ts(i.START), i.ts(i.END), path
    )
    fields = "place bigint, stock string, visit bigint, hour timestamp"
    out = spark.read.schema(fields).parquet(path)
    return out.withColumn("hour", i.text_key("hour")).withColumn("place", F.col("place").cast("int"))


def _history(spark: SparkSession, d: str, starts: str, length: int, step: str) -> DataFrame:
    daily = stock.daily_history(
        i.news(spark, d), i.stock_dict(spark, d), i.visits(spark, d), i.ts(i.START), i.ts(i.END)
    )
    out = stock.period_history(daily, F.expr(starts), length, F.expr(step))
    return out.withColumn("period_start", i.text_key("period_start", "yyyy-MM-dd"))


def stock_week(spark: SparkSession, d: str) -> DataFrame:
    return _history(
        spark, d, "sequence(date'2024-01-01', date'2024-01-22', interval 7 days)", 7, "interval 7 days"
    )


def stock_month(spark: SparkSession, d: str) -> DataFrame:
    # A month of num + 1 = 15 days, twice.
    return _history(spark, d, "array(date'2024-01-01', date'2024-01-16')", 15, "interval 15 days")


def _per_period(spark: SparkSession, d: str, unit: str, key: str) -> DataFrame:
    return (
        i.table(spark, d, "events").groupBy(F.date_trunc(unit, "ts").alias("period"), key)
        .agg(F.count(F.lit(1)).alias("value"))
    )


def stock_trend(spark: SparkSession, d: str) -> DataFrame:
    daily = _per_period(spark, d, "day", "event_type")
    out = ex.trend_series(daily, "period", "value", span(days=1), ["event_type"])
    return out.withColumn("period", i.text_key("period"))


def stock_rate(spark: SparkSession, d: str) -> DataFrame:
    hourly = _per_period(spark, d, "hour", "user_id")
    out = ex.rate_series(hourly, "period", "value", span(hours=1), ["user_id"])
    return out.select(i.text_key("period").alias("period"), "user_id", F.round("rate", 6).alias("rate"))


def trend_pair(spark: SparkSession, d: str) -> DataFrame:
    daily = _per_period(spark, d, "day", "user_id")
    now = daily.where(F.col("period") == i.ts("2024-01-16 00:00:00"))
    before = daily.where(F.col("period") == i.ts("2024-01-15 00:00:00"))
    rates = ex.rate_between(now, before, "user_id", "value")
    return ex.trend_between(now, before, "user_id", "value").join(rates, "user_id").select(
        "user_id", "trend", F.round("rate", 6).alias("rate")
    )


_DAILY = """
daily AS (
  SELECT day, stock,
    (SELECT count(*) FROM heads h JOIN lines USING (news_id)
      WHERE lines.stock = g.stock AND news_time >= g.day AND news_time <= g.day + INTERVAL 1 HOUR) AS exposure,
    coalesce((SELECT CAST(sum(cnt) AS BIGINT) FROM visits v JOIN heads h USING (url) JOIN lines USING (news_id)
      WHERE lines.stock = g.stock AND date_trunc('day', v.hour) = g.day), 0) AS visit
  FROM (SELECT day, stock FROM dict,
    generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY) t(day)) g)"""

_HOURLY = """
exposed AS (
  SELECT hour, stock, count(*) AS exposure FROM (
    SELECT date_trunc('hour', news_time) AS hour, news_id FROM heads
    UNION ALL
    SELECT news_time - INTERVAL 1 HOUR, news_id FROM heads WHERE news_time = date_trunc('hour', news_time))
  JOIN lines USING (news_id) GROUP BY ALL),
visited AS (
  SELECT hour, stock, CAST(sum(cnt) AS BIGINT) AS visit
  FROM visits JOIN heads USING (url) JOIN lines USING (news_id) GROUP BY ALL),
hourly AS (
  SELECT hour, stock, coalesce(exposure, 0) AS exposure, coalesce(visit, 0) AS visit
  FROM (SELECT hour, stock FROM dict,
    generate_series(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR) t(hour))
  LEFT JOIN exposed USING (hour, stock) LEFT JOIN visited USING (hour, stock))"""

_BASE = f"WITH {i.SQL_NEWS}, {i.SQL_DICT}, {i.SQL_VISITS}"


def _periods(starts: str, length: int, step: int) -> str:
    return f"""{_BASE}, {_DAILY},
sums AS (
  SELECT s AS period_start, stock, CAST(sum(visit) AS BIGINT) AS visit, CAST(sum(exposure) AS BIGINT) AS exposure
  FROM daily JOIN (SELECT unnest({starts}) AS s) ON day >= s AND day < s + INTERVAL {length} DAY
  GROUP BY ALL)
SELECT strftime(a.period_start, '%Y-%m-%d') AS period_start, a.stock, a.visit, a.exposure,
  CAST(sign(a.visit - b.visit) AS INTEGER) AS trend
FROM sums a LEFT JOIN sums b ON a.stock = b.stock AND b.period_start = a.period_start - INTERVAL {step} DAY"""


_RANKED = f"""{_BASE}, {_HOURLY}
SELECT strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour, stock, visit,
  CAST(row_number() OVER (PARTITION BY hour ORDER BY visit DESC, stock) AS INTEGER) AS place FROM hourly"""

QUERIES = {
    "stock_links": (stock_links, f"""WITH {i.SQL_NEWS}, {i.SQL_DICT}
SELECT dict.stock, url, strftime(news_time, '%Y-%m-%d %H:%M:%S') AS news_time
FROM dict LEFT JOIN (SELECT * FROM heads JOIN lines USING (news_id)) n ON n.stock = dict.stock"""),
    "stock_exposure": (stock_exposure, f"""WITH {i.SQL_NEWS}, {i.SQL_DICT}
SELECT dict.stock, count(n.stock) AS exposure FROM dict LEFT JOIN (
  SELECT stock FROM heads JOIN lines USING (news_id)
  WHERE news_time BETWEEN TIMESTAMP '2024-01-10 05:00:00' AND TIMESTAMP '2024-01-10 06:00:00') n
ON n.stock = dict.stock GROUP BY ALL"""),
    "stock_visit": (stock_visit, f"""{_BASE}
SELECT dict.stock, CAST(coalesce(sum(n.cnt), 0) AS BIGINT) AS visit FROM dict LEFT JOIN (
  SELECT stock, cnt FROM heads JOIN lines USING (news_id) JOIN visits USING (url)) n
ON n.stock = dict.stock GROUP BY ALL"""),
    "stock_daily": (stock_daily, f"""{_BASE}, {_DAILY}
SELECT strftime(a.day, '%Y-%m-%d') AS day, a.stock, a.exposure, a.visit,
  CAST(sign(a.visit - b.visit) AS INTEGER) AS trend
FROM daily a LEFT JOIN daily b ON a.stock = b.stock AND b.day = a.day - INTERVAL 1 DAY"""),
    "stock_whole_day": (stock_whole_day, f"""{_BASE}
SELECT strftime(g.day, '%Y-%m-%d') AS day, g.stock, count(n.stock) AS exposure
FROM (SELECT day, stock FROM dict,
    generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY) t(day)) g
LEFT JOIN (SELECT stock, news_time FROM heads JOIN lines USING (news_id)) n
ON n.stock = g.stock AND news_time >= g.day AND news_time <= g.day + INTERVAL 1 DAY
GROUP BY g.day, g.stock"""),
    "stock_hourly": (stock_hourly, f"""{_BASE}, {_HOURLY}
SELECT strftime(a.hour, '%Y-%m-%d %H:%M:%S') AS hour, a.stock, a.exposure, a.visit,
  CAST(sign(a.visit - b.visit) AS INTEGER) AS trend
FROM hourly a LEFT JOIN hourly b ON a.stock = b.stock AND b.hour = a.hour - INTERVAL 1 HOUR"""),
    "stock_hour_ranking": (stock_hour_ranking, _RANKED),
    "stock_hour_ranking_files": (stock_hour_ranking_files, _RANKED),
    "stock_week": (stock_week, _periods(
        "[TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-15', TIMESTAMP '2024-01-22']", 7, 7)),
    "stock_month": (stock_month, _periods("[TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-16']", 15, 15)),
    "stock_trend": (stock_trend, """
WITH p AS (SELECT date_trunc('day', ts)::TIMESTAMP AS period, event_type, count(*) AS value FROM events GROUP BY ALL)
SELECT strftime(a.period, '%Y-%m-%d %H:%M:%S') AS period, a.event_type,
  CAST(sign(a.value - b.value) AS INTEGER) AS trend
FROM p a JOIN p b ON a.event_type = b.event_type AND b.period = a.period - INTERVAL 1 DAY"""),
    "stock_rate": (stock_rate, """
WITH p AS (SELECT date_trunc('hour', ts) AS period, user_id, count(*) AS value FROM events GROUP BY ALL)
SELECT strftime(a.period, '%Y-%m-%d %H:%M:%S') AS period, a.user_id,
  round(CASE WHEN b.value = 0 THEN 1.0 ELSE (a.value - b.value) / CAST(b.value AS DOUBLE) END, 6) AS rate
FROM p a JOIN p b ON a.user_id = b.user_id AND b.period = a.period - INTERVAL 1 HOUR"""),
    "trend_pair": (trend_pair, """
WITH p AS (SELECT date_trunc('day', ts)::DATE AS period, user_id, count(*) AS value FROM events GROUP BY ALL)
SELECT a.user_id, CAST(sign(a.value - b.value) AS INTEGER) AS trend,
  round(CASE WHEN b.value = 0 THEN 1.0 ELSE (a.value - b.value) / CAST(b.value AS DOUBLE) END, 6) AS rate
FROM p a JOIN p b ON a.user_id = b.user_id
WHERE a.period = DATE '2024-01-16' AND b.period = DATE '2024-01-15'"""),
}
