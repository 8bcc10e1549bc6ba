"""Streaming hourly metrics: visits, exposure, rolling search terms, idempotent metric upserts."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pressgauge.session import run_path
from pressgauge.sources import tables


def hourly_url_visits(visits: DataFrame, time: str = "ts", delay: str = "1 hour") -> DataFrame:
    """``hour, url, visit`` from a stream of single visits; rows later than ``delay`` are dropped."""
    return (
        visits.withWatermark(time, delay).groupBy(F.window(time, "1 hour").alias("w"), "url")
        .agg(F.count(F.lit(1)).alias("visit")).select(F.col("w.start").alias("hour"), "url", "visit")
    )


def hourly_stock_visits(visits: DataFrame, news: DataFrame, time: str = "ts", delay: str = "1 hour") -> DataFrame:
    """``hour, stock, visit``: visits are counted by hour and url, the counts meet the static news table on the url,
    then are summed by stock. The news table is read in each micro-batch, so it should be a written one."""
    counted = (
        visits.withWatermark(time, delay).groupBy(F.window(time, "1 hour").alias("w"), "url").agg(F.count(F.lit(1)).alias("n"))
    )
    linked = counted.join(news.select("url", "stock"), "url").select("w", "n", F.explode("stock").alias("stock"))
    return (
        linked.groupBy(F.window(F.window_time("w"), "1 hour").alias("h"), "stock")
        .agg(F.sum("n").alias("visit")).select(F.col("h.start").alias("hour"), "stock", "visit")
    )


def hourly_stock_exposure(news: DataFrame, time: str = "news_time", delay: str = "1 hour") -> DataFrame:
    """``hour, stock, exposure`` from a news stream, half-open hours."""
    return (
        news.withWatermark(time, delay).select(time, F.explode("stock").alias("stock"))
        .groupBy(F.window(time, "1 hour").alias("w"), "stock")
        .agg(F.count(F.lit(1)).alias("exposure")).select(F.col("w.start").alias("hour"), "stock", "exposure")
    )


def hourly_terms(terms: DataFrame, time: str = "ts", delay: str = "1 hour") -> DataFrame:
    """``hour, user_id, term, n`` from a stream of terms. State is one counter per hour, user and term."""
    return (
        terms.withWatermark(time, delay).groupBy(F.window(time, "1 hour").alias("h"), "user_id", "term")
        .agg(F.count(F.lit(1)).alias("n")).select(F.col("h.start").alias("hour"), "user_id", "term", "n")
    )


def rolling_terms(hourly: DataFrame, until: Column, hours: int = 24) -> DataFrame:
    """``window_start, window_end, user_id, term, n``: sums of the last 24 hours for every full hour up to ``until``,
    from the table that :func:`hourly_terms` keeps.

    A count enters the windows that start ``hours - 1`` hours before it and leaves those that start after it. These two
    changes are summed and shuffled; running sums and the hours between two changes are made behind the shuffle."""
    hour = F.make_dt_interval(F.lit(0), F.lit(1))
    changes = hourly.select("user_id", "term", F.inline(F.array(
        F.struct((F.col("hour") - hour * (hours - 1)).alias("start"), F.col("n").alias("change")),
        F.struct((F.col("hour") + hour).alias("start"), (-F.col("n")).alias("change")),
    )))
    # Columns of the shuffle: a term of a user, whose hours are few.
    summed = changes.groupBy("user_id", "term", "start").agg(F.sum("change").alias("change"))
    w = W.partitionBy("user_id", "term").orderBy("start")
    runs = summed.select(
        "user_id", "term", "start", F.sum("change").over(w).alias("n"), F.lead("start").over(w).alias("next"),
    ).where("n > 0")
    starts = runs.select("user_id", "term", "n", F.explode(F.sequence("start", F.col("next") - hour, hour)).alias("window_start"))
    end = F.col("window_start") + hour * hours
    return starts.where(end <= until).select("window_start", end.alias("window_end"), "user_id", "term", "n")


def upsert_sink(stream: DataFrame, path: str, metric: str, period: str, entity: str, value: str,
                checkpoint: str) -> StreamingQuery:
    """Keep a metric table up to date from an update-mode aggregate.

    A batch holds the newest value per (period, entity) and replaces it. It is evaluated once, by the write, and
    committed with the id of the query and its own, so one that runs again after a failure is recognised and not
    written twice. Periods that are still open are there.
    """
    def write(batch: DataFrame, number: int) -> None:
        rows = tables.metric_rows(batch, metric, period, entity, value)
        # The id that the checkpoint was made with: a new checkpoint begins anew.
        stream_id = json.loads(tables.read_text(batch.sparkSession, f"{checkpoint}/metadata"))["id"]
        tables.upsert_metrics(batch.sparkSession, path, rows, stream_id, number)

    return (
        stream.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def drain_to_parquet(stream: DataFrame, name: str) -> DataFrame:
    """Run an append-mode stream over all available input and read its sink back."""
    spark: SparkSession = stream.sparkSession
    out, state = run_path(spark, f"{name}-out"), run_path(spark, f"{name}-state")
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("path", out)
        .option("checkpointLocation", state).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def as_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A parquet path as a file stream with the schema of its files."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def hour_key(hour: Column) -> Column:
    return F.date_format(hour, "yyyy-MM-dd-HH")
