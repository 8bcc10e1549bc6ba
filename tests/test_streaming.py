from datetime import datetime

from pyspark.sql import functions as F

from pressgauge.sources import tables
from pressgauge.streaming import hourly

SCHEMA = "ts timestamp, url string"


def write(spark, path, rows, mode="append"):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode(mode).parquet(str(path))


def test_late_rows_are_dropped(spark, tmp_path, rows):
    src = tmp_path / "in"
    write(spark, src, [(datetime(2024, 1, 1, 0, 5), "u"), (datetime(2024, 1, 1, 9), "u")])
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        counts = hourly.hourly_url_visits(hourly.as_stream(spark, str(src)))
        q = (counts.writeStream.format("parquet").outputMode("append").option("path", out)
             .option("checkpointLocation", state).trigger(availableNow=True).start())
        q.awaitTermination()

    run()
    # Hour 0 closed; a second visit to it comes too late, one to hour 8 is in time.
    write(spark, src, [(datetime(2024, 1, 1, 0, 30), "u"), (datetime(2024, 1, 1, 8, 30), "v"), (datetime(2024, 1, 1, 12), "u")])
    run()
    got = spark.read.parquet(out)
    assert rows(got, "hour", "url", "visit") == {
        (datetime(2024, 1, 1, 0), "u", 1), (datetime(2024, 1, 1, 8), "v", 1), (datetime(2024, 1, 1, 9), "u", 1)
    }


def test_upsert_over_several_batches(spark, tmp_path, rows):
    src, path = tmp_path / "in", str(tmp_path / "m")
    write(spark, src, [(datetime(2024, 1, 1, 0, 5), "u"), (datetime(2024, 1, 1, 1, 5), "u")])

    def run():
        counts = hourly.hourly_url_visits(hourly.as_stream(spark, str(src)))
        keyed = counts.withColumn("hour", hourly.hour_key(F.col("hour")))
        hourly.upsert_sink(keyed, path, "visitHour", "hour", "url", "visit", str(tmp_path / "state")).awaitTermination()

    run()
    write(spark, src, [(datetime(2024, 1, 1, 1, 30), "u"), (datetime(2024, 1, 1, 1, 40), "v")])
    run()
    assert rows(tables.read_metric_table(spark, path), "period", "entity", "value") == {
        ("2024-01-01-00", "u", 1.0), ("2024-01-01-01", "u", 2.0), ("2024-01-01-01", "v", 1.0)
    }


def test_rolling_terms(spark, tmp_path, rows):
    src = tmp_path / "in"
    spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 5), "u", "a"), (datetime(2024, 1, 1, 3), "u", "a"), (datetime(2024, 1, 4), "u", "z")],
        "ts timestamp, user_id string, term string",
    ).coalesce(1).write.parquet(str(src))
    sums = hourly.drain_to_parquet(hourly.hourly_terms(hourly.as_stream(spark, str(src))), "test-terms")
    got = hourly.rolling_terms(sums, F.lit(datetime(2024, 1, 3, 23)))
    a = got.where("term = 'a'")
    assert a.count() == 27
    assert {r["n"] for r in a.where(F.col("window_start") == F.lit(datetime(2023, 12, 31, 1))).collect()} == {1}
    assert {r["n"] for r in a.where(F.col("window_start") == F.lit(datetime(2023, 12, 31, 12))).collect()} == {2}
