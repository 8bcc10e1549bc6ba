"""The logical tables (news, events, visits, search log, ...) as selections of the given tables.

``SQL_*`` are the same selections as DuckDB common table expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.sources.logs import spread

# The 30 days that the events table covers.
START, END = "2024-01-01 00:00:00", "2024-01-31 00:00:00"
DAYS = 30


def ts(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _splits(spark: SparkSession) -> int | None:
    """Tasks for a text table, where the session asks for it: the test tables are files of one row group."""
    asked = spark.conf.get("spark.pressgauge.inputSplits", None)
    return int(asked) if asked else None


def documents(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Some columns of the documents."""
    rows = table(spark, d, "documents").select("doc_id", *[c for c in columns if c != "doc_id"])
    return spread(rows, _splits(spark), "doc_id")


def text_key(c: Column | str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(c, fmt)


def _news_time() -> Column:
    hours = F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % (24 * DAYS)).cast("int"))
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), ((F.col("o_custkey") % 4) * 20).cast("int"))
    return ts(START) + hours + minutes


def news_heads(spark: SparkSession, d: str) -> DataFrame:
    """``news_id, news_time, platform, url``: one news item per order."""
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("news_id"), _news_time().alias("news_time"),
        F.col("o_orderpriority").alias("platform"),
        F.concat(F.lit("http://n/"), F.col("o_orderkey")).alias("url"),
    )


def news(spark: SparkSession, d: str) -> DataFrame:
    """News with property lists: the brands, types and names of the order's parts."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_name")
    lists = (
        lines.join(parts, lines.l_partkey == parts.p_partkey)
        .groupBy(F.col("l_orderkey").alias("news_id"))
        .agg(
            F.collect_list("p_brand").alias("stock"), F.collect_list("p_type").alias("industry"),
            F.collect_list("p_name").alias("section"),
        )
    )
    return news_heads(spark, d).join(lists, "news_id")


def stock_dict(spark: SparkSession, d: str) -> DataFrame:
    """All brands and, per brand, a twin that no news names."""
    brand = table(spark, d, "part").select("p_brand").distinct()
    return brand.select(F.explode(F.array("p_brand", F.concat("p_brand", F.lit("-unlisted")))).alias("stock"))


def event_table(spark: SparkSession, d: str) -> DataFrame:
    """One event per customer: its orders as news, and one id that does not exist."""
    orders = table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list("o_orderkey").alias("ids"))
    return (
        table(spark, d, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            F.col("c_custkey").alias("event_id"), F.col("c_name").alias("event_name"),
            F.concat(F.coalesce("ids", F.array().cast("array<bigint>")), F.array(-1 - F.col("c_custkey")))
            .alias("related_news"),
            F.when(F.col("c_mktsegment") == "MACHINERY", 0).otherwise(1).alias("is_valid"),
        )
    )


def visit_events(spark: SparkSession, d: str) -> DataFrame:
    """``ts, url`` of single visits."""
    return table(spark, d, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("http://n/"), F.col("event_id") % 5000).alias("url"),
    )


def visits(spark: SparkSession, d: str) -> DataFrame:
    """``hour, url, cnt``."""
    v = visit_events(spark, d)
    return v.groupBy(F.date_trunc("hour", "ts").alias("hour"), "url").agg(F.count(F.lit(1)).alias("cnt"))


def search_lines(spark: SparkSession, d: str) -> DataFrame:
    """Search-log lines: a conversation is a user and each of its turns a url-encoded query, spaces as
    %20. Every turn also gives a line without a query and a line with a field too few."""
    c = spread(table(spark, d, "conversations"), _splits(spark), "conv_id", "turn")
    head = F.concat_ws("\t", F.col("turn"), F.col("conv_id"), F.col("role"), *[F.lit("-")] * 4)
    return c.select(F.explode(F.array(
        F.concat(head, F.lit("\t"), F.regexp_replace(F.url_encode("text"), "\\+", "%20")), F.concat(head, F.lit("\tNoDef")), head,
    )).alias("value"))


def title_and_body(spark: SparkSession, d: str) -> DataFrame:
    """Documents split at the first line break."""
    at = F.instr("text", "\n")
    return documents(spark, d, "text").select(
        "doc_id",
        F.when(at > 0, F.expr("substring(text, 1, instr(text, '\n') - 1)")).otherwise(F.col("text")).alias("title"),
        F.when(at > 0, F.expr("substring(text, instr(text, '\n') + 1)")).otherwise(F.lit("")).alias("content"),
    )


SQL_HEADS = """heads AS (
  SELECT o_orderkey AS news_id,
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(o_orderkey % 720 AS BIGINT))
           + to_minutes(CAST((o_custkey % 4) * 20 AS BIGINT)) AS news_time,
         o_orderpriority AS platform, 'http://n/' || o_orderkey AS url
  FROM orders)"""

SQL_LINES = """lines AS (
  SELECT l_orderkey AS news_id, p_brand AS stock, p_type AS industry, p_name AS section
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

SQL_NEWS = SQL_HEADS + ",\n" + SQL_LINES

SQL_DICT = """dict AS (
  SELECT DISTINCT p_brand AS stock FROM part
  UNION ALL SELECT DISTINCT p_brand || '-unlisted' FROM part)"""

SQL_VISITS = """visits AS (
  SELECT date_trunc('hour', ts) AS hour, 'http://n/' || (event_id % 5000) AS url, count(*) AS cnt
  FROM events GROUP BY ALL)"""

SQL_EVENTS = """event_news AS (
  SELECT c_custkey AS event_id, c_name AS event_name, o_orderkey AS news_id,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 0 ELSE 1 END AS is_valid
  FROM customer JOIN orders ON o_custkey = c_custkey
  UNION ALL
  SELECT c_custkey, c_name, -1 - c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 0 ELSE 1 END FROM customer)"""

SQL_TITLES = """titles AS (
  SELECT doc_id,
    CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, 1, instr(text, chr(10)) - 1) ELSE text END AS title,
    CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END AS content
  FROM documents)"""
