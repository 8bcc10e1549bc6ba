"""Log parsing, selections, dictionaries, writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.functions import periods
from pressgauge.operators import records
from pressgauge.plans import stock
from pressgauge.queries import inputs as i
from pressgauge.session import run_path
from pressgauge.sources import logs, tables


def _visit_lines(spark: SparkSession, d: str) -> DataFrame:
    """Visit-log lines in several states of repair, by event type."""
    v = i.table(spark, d, "events").select(
        "event_type", F.date_trunc("hour", "ts").alias("hour"),
        F.concat(F.lit("http://n/"), F.col("event_id") % 5000).alias("url"), "user_id",
    )
    slot = periods.period_key(F.col("hour"), periods.LOG_HOUR_KEY)
    good = F.concat(slot, F.lit(","), "url", F.lit("\t"), "user_id")
    line = (
        F.when(F.col("event_type") == "signup", F.concat(slot, F.lit(",a,"), "url", F.lit("\t"), "user_id"))
        .when(F.col("event_type") == "error", F.concat(slot, F.lit(","), "url", F.lit("\t"), "user_id", F.lit("x")))
        .when(F.col("event_type") == "purchase", F.concat(slot, F.lit(","), "url", F.lit(" "), "user_id"))
        .when(F.col("event_type") == "view", F.concat(good, F.lit("\t")))
        .otherwise(good)
    )
    return v.select(line.alias("value"), periods.to_millis(F.col("hour")).cast("string").alias("file_name"))


def visit_log_parse(spark: SparkSession, d: str) -> DataFrame:
    parsed = logs.parse_day_visits(_visit_lines(spark, d))
    return logs.sum_visits(parsed, "hour").withColumn("hour", i.text_key("hour"))


def hour_file_visits(spark: SparkSession, d: str) -> DataFrame:
    """Hour files written to a shared folder, one per hour and named by it, and read back by name."""
    path = run_path(spark, "hour-files")
    _visit_lines(spark, d).write.partitionBy("file_name").text(path)
    lines = logs.read_lines(spark, f"{path}/*").withColumn(
        "file_name", F.regexp_extract("path", "file_name=(\\d+)", 1)
    )
    parsed = logs.parse_hour_visits(lines)
    day = logs.slice_hours(parsed, i.ts(i.START), i.ts(i.END))
    return logs.sum_visits(day, "hour").withColumn("hour", i.text_key("hour"))


def missing_days(spark: SparkSession, d: str) -> DataFrame:
    kept = logs.without_periods(i.visits(spark, d), ["2024-01-07", "2024-01-21"])
    return (
        kept.groupBy(i.text_key("hour", "yyyy-MM-dd").alias("day")).agg(F.sum("cnt").alias("cnt"))
    )


def missing_day_zeros(spark: SparkSession, d: str) -> DataFrame:
    """Visits of every dictionary stock on every day; days without a usable log are zeros."""
    kept = logs.without_periods(i.visits(spark, d), ["2024-01-07", "2024-01-21"])
    daily = stock.daily_history(i.news(spark, d), i.stock_dict(spark, d), kept, i.ts(i.START), i.ts(i.END))
    return daily.select(i.text_key("day", "yyyy-MM-dd").alias("day"), "stock", "visit")


def untyped_news(spark: SparkSession, d: str) -> DataFrame:
    """News of the plain type, 0; the other type is every third item."""
    typed = i.news_heads(spark, d).withColumn("type", F.when(F.col("news_id") % 3 == 0, 1).when(F.col("news_id") % 7 != 0, 0))
    return records.plain_type(typed).select("news_id", "platform")


def dictionary_files(spark: SparkSession, d: str) -> DataFrame:
    """The category dictionary and a tagged word list as files with a byte-order mark, read back."""
    names = records.category_dictionary(_board(spark, d))
    mark = F.lit("\ufeff")
    path, tagged = run_path(spark, "dictionary"), run_path(spark, "tagged")
    names.select(F.concat(mark, "category", F.lit("\t"), "name").alias("value")).write.text(path)
    i.table(spark, d, "part").select(F.concat(mark, "p_type", F.lit("/"), "p_brand").alias("value")).distinct().write.text(tagged)
    read = logs.parse_entity_dictionary(logs.read_lines(spark, path))
    words = logs.parse_tagged_word_list(logs.read_lines(spark, tagged))
    return read.unionByName(words.select(F.col("word").alias("category"), F.col("tag").alias("name")))


def tuple_text(spark: SparkSession, d: str) -> DataFrame:
    """Visits per url as ``(url,n)`` text lines, parsed again."""
    totals = logs.sum_visits(i.visits(spark, d).select("url", "cnt"))
    return logs.parse_tuple_text(logs.format_tuple_text(totals, "url", "cnt"))


def search_log(spark: SparkSession, d: str) -> DataFrame:
    return logs.parse_search_log(i.search_lines(spark, d))


def news_window(spark: SparkSession, d: str) -> DataFrame:
    recent = records.look_back(records.tagged_news(i.news(spark, d)), "news_time", i.ts("2024-01-20 12:00:00"), 72)
    return recent.select("news_id", i.text_key("news_time").alias("news_time"), "platform", F.size("stock").alias("n"))


def period_keys(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("ts").cast("timestamp")
    back = periods.parse_period_key(periods.period_key(t, periods.LOG_HOUR_KEY), periods.LOG_HOUR_KEY)
    series = F.transform(periods.day_series(t, 2, 7), lambda x: F.date_format(x, "yyyy-MM-dd"))
    return i.table(spark, d, "events").select(
        "event_id",
        periods.to_millis(t).alias("ms"),
        periods.period_key(t, periods.HOUR_KEY).alias("hour_key"),
        periods.period_key(t, periods.MONTH_KEY).alias("month_key"),
        periods.to_millis(back).alias("hour_ms"),
        i.text_key(periods.previous_day(t), "yyyy-MM-dd").alias("previous_day"),
        i.text_key(periods.previous_week(t), "yyyy-MM-dd").alias("previous_week"),
        i.text_key(periods.previous_hour(t)).alias("previous_hour"),
        F.array_join(series, ",").alias("week_starts"),
        F.size(periods.hours_of_day(t)).alias("hours"),
        i.text_key(periods.from_millis(periods.to_millis(t))).alias("from_ms"),
    )


def listed_filter(spark: SparkSession, d: str) -> DataFrame:
    codes = i.table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("symbol"),
        F.when(F.col("p_type") == "ECONOMY", "001002").when(F.col("p_type") == "SMALL", "001003")
        .otherwise("001004").alias("exchange"),
        F.when(F.col("p_size") <= 40, "101").otherwise("102").alias("setype"),
        F.when(F.col("p_name").startswith("red"), "USD").otherwise("CNY").alias("cur"),
        F.when(F.col("p_size") > 3, 1).otherwise(0).alias("isvalid"),
        F.when(F.col("p_brand") == "Brand#7", "2").otherwise("1").alias("liststatus"),
    )
    return records.listed_stocks(codes)


def _board(spark: SparkSession, d: str) -> DataFrame:
    return i.table(spark, d, "part").select(
        F.col("p_brand").alias("symbol"),
        F.when(F.col("p_size") <= 20, "1105").when(F.col("p_size") <= 40, "1109").otherwise("1111").alias("boardcode"),
        F.concat_ws(" ", "p_type", "p_name").alias("keyname"),
    )


def category_dictionary(spark: SparkSession, d: str) -> DataFrame:
    return records.category_dictionary(_board(spark, d))


def truncate_insert(spark: SparkSession, d: str) -> DataFrame:
    """The section dictionary replaced by the industry one; the new version is read back."""
    names = records.category_dictionary(_board(spark, d))
    path = run_path(spark, "industry")
    tables.replace(names.where(F.col("category") == "section").select("name"), path)
    tables.replace(names.where(F.col("category") == "industry").select("name"), path)
    return tables.read_current(spark, path)


def dictionary_merge(spark: SparkSession, d: str) -> DataFrame:
    added = i.table(spark, d, "part").select(F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("value"))
    existing = i.table(spark, d, "part").select(F.col("p_type").alias("word"))
    return records.merge_dictionary(added, existing)


def _daily_values(spark: SparkSession, d: str) -> DataFrame:
    return (
        i.table(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("user_id")).alias("m"))
    )


def metric_upsert(spark: SparkSession, d: str) -> DataFrame:
    """All days written, then the values of busy rows replaced and a second metric added."""
    path = run_path(spark, "metrics")
    daily = _daily_values(spark, d)
    tables.upsert_metrics(spark, path, tables.metric_rows(daily, "visit", "day", "event_type", "n"))
    busy = daily.where(F.col("event_type").isin("click", "view"))
    tables.upsert_metrics(spark, path, tables.metric_rows(busy, "visit", "day", "event_type", "m"))
    tables.upsert_metrics(spark, path, tables.metric_rows(busy, "exposure", "day", "event_type", "n"))
    return tables.read_metric_table(spark, path)


def metric_periods(spark: SparkSession, d: str) -> DataFrame:
    path = run_path(spark, "metrics")
    tables.upsert_metrics(spark, path, tables.metric_rows(_daily_values(spark, d), "visit", "day", "event_type", "n"))
    week = tables.read_periods(spark, path, "visit", "2024-01-08", 6)
    one = tables.read_period(spark, path, "visit", "2024-01-08").select(F.lit("single").alias("period"), "entity", "value")
    return week.unionByName(one)


def append_stamped(spark: SparkSession, d: str) -> DataFrame:
    """Two appends under their own dates, read back."""
    path = run_path(spark, "stamped")
    rows = _daily_values(spark, d).groupBy("event_type").agg(F.sum("n").alias("n"))
    tables.append_stamped(rows, path, date="2024-02-01")
    tables.append_stamped(rows.withColumn("n", F.col("n") * 2), path, date="2024-02-02")
    return spark.read.schema("event_type string, n bigint, date string").parquet(path)


_LINES = """src AS (
  SELECT date_trunc('hour', ts) AS hour, 'http://n/' || (event_id % 5000) AS url, user_id, event_type FROM events)"""
_PARSED = f"""WITH {_LINES}
SELECT strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour, url, CAST(sum(user_id) AS BIGINT) AS cnt
FROM src WHERE event_type IN ('click', 'view') GROUP BY ALL"""
_DAILY = """daily AS (
  SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS m
  FROM events GROUP BY ALL)"""
_BOARD = """board AS (
  SELECT p_brand AS symbol, p_type || ' ' || p_name AS keyname,
    CASE WHEN p_size <= 20 THEN '1105' WHEN p_size <= 40 THEN '1109' ELSE '1111' END AS boardcode FROM part)"""

QUERIES = {
    "visit_log_parse": (visit_log_parse, _PARSED),
    "hour_file_visits": (hour_file_visits, _PARSED),
    "missing_days": (missing_days, """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS cnt FROM events
WHERE strftime(ts, '%Y-%m-%d') NOT IN ('2024-01-07', '2024-01-21') GROUP BY ALL"""),
    "missing_day_zeros": (missing_day_zeros, f"""WITH {i.SQL_HEADS}, {i.SQL_LINES}, {i.SQL_DICT}, {i.SQL_VISITS},
days AS (SELECT strftime(TIMESTAMP '2024-01-01' + to_days(CAST(k AS INTEGER)), '%Y-%m-%d') AS day FROM range(30) r(k)),
counted AS (SELECT strftime(hour, '%Y-%m-%d') AS day, stock, sum(cnt) AS visit FROM visits JOIN heads USING (url) JOIN lines USING (news_id)
  WHERE strftime(hour, '%Y-%m-%d') NOT IN ('2024-01-07', '2024-01-21') GROUP BY ALL)
SELECT day, stock, CAST(coalesce(visit, 0) AS BIGINT) AS visit FROM days CROSS JOIN dict LEFT JOIN counted USING (day, stock)"""),
    "untyped_news": (untyped_news, f"""WITH {i.SQL_HEADS}
SELECT news_id, platform FROM heads WHERE news_id % 3 <> 0 AND news_id % 7 <> 0"""),
    "dictionary_files": (dictionary_files, f"""WITH {_BOARD}
SELECT DISTINCT 'stock' AS category, symbol AS name FROM board
UNION ALL SELECT DISTINCT 'section', keyname FROM board WHERE boardcode = '1105'
UNION ALL SELECT DISTINCT 'industry', keyname FROM board WHERE boardcode = '1109'
UNION ALL SELECT DISTINCT p_type, p_brand FROM part"""),
    "tuple_text": (tuple_text, """
SELECT 'http://n/' || (event_id % 5000) AS entity, CAST(count(*) AS DOUBLE) AS value FROM events GROUP BY ALL"""),
    "search_log": (search_log, "SELECT CAST(conv_id AS VARCHAR) AS user_id, text AS query FROM conversations"),
    "news_window": (news_window, f"""WITH {i.SQL_NEWS}
SELECT news_id, strftime(news_time, '%Y-%m-%d %H:%M:%S') AS news_time, platform, CAST(count(*) AS INTEGER) AS n
FROM heads JOIN lines USING (news_id)
WHERE news_time > TIMESTAMP '2024-01-17 12:00:00' AND news_time < TIMESTAMP '2024-01-20 12:00:00' GROUP BY ALL"""),
    "period_keys": (period_keys, """
SELECT event_id, epoch_us(ts) // 1000 AS ms, strftime(ts, '%Y%m%d%H') AS hour_key, strftime(ts, '%Y-%m') AS month_key,
  epoch_ms(date_trunc('hour', ts)) AS hour_ms,
  strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d') AS previous_day,
  strftime(ts - INTERVAL 7 DAY, '%Y-%m-%d') AS previous_week,
  strftime(date_trunc('hour', ts) - INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS previous_hour,
  strftime(ts, '%Y-%m-%d') || ',' || strftime(ts + INTERVAL 7 DAY, '%Y-%m-%d') || ','
    || strftime(ts + INTERVAL 14 DAY, '%Y-%m-%d') AS week_starts,
  24 AS hours, strftime(ts, '%Y-%m-%d %H:%M:%S') AS from_ms
FROM events"""),
    "listed_filter": (listed_filter, """
SELECT CAST(p_partkey AS VARCHAR) AS stock FROM part
WHERE p_type IN ('ECONOMY', 'SMALL') AND p_size <= 40 AND p_size > 3 AND p_name NOT LIKE 'red%' AND p_brand <> 'Brand#7'"""),
    "category_dictionary": (category_dictionary, f"""WITH {_BOARD}
SELECT DISTINCT 'stock' AS category, symbol AS name FROM board
UNION ALL SELECT DISTINCT 'section', keyname FROM board WHERE boardcode = '1105'
UNION ALL SELECT DISTINCT 'industry', keyname FROM board WHERE boardcode = '1109'"""),
    "truncate_insert": (truncate_insert, f"""WITH {_BOARD}
SELECT DISTINCT keyname AS name FROM board WHERE boardcode = '1109'"""),
    "dictionary_merge": (dictionary_merge, """
SELECT unnest(string_split(p_name, ' ')) AS word FROM part UNION SELECT p_type FROM part"""),
    "metric_upsert": (metric_upsert, f"""WITH {_DAILY}
SELECT 'visit' AS metric, day AS period, event_type AS entity,
  CAST(CASE WHEN event_type IN ('click', 'view') THEN m ELSE n END AS DOUBLE) AS value FROM daily
UNION ALL SELECT 'exposure', day, event_type, CAST(n AS DOUBLE) FROM daily WHERE event_type IN ('click', 'view')"""),
    "metric_periods": (metric_periods, f"""WITH {_DAILY}
SELECT day AS period, event_type AS entity, n AS value FROM daily WHERE day BETWEEN '2024-01-08' AND '2024-01-14'
UNION ALL SELECT 'single', event_type, n FROM daily WHERE day = '2024-01-08'"""),
    "append_stamped": (append_stamped, """
WITH t AS (SELECT event_type, count(*) AS n FROM events GROUP BY ALL)
SELECT event_type, n, '2024-02-01' AS date FROM t UNION ALL SELECT event_type, n * 2, '2024-02-02' FROM t"""),
}
