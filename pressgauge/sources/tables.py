"""Parquet tables: append, replace, keyed update, metric upsert.

Parquet has no in-place update. Whatever replaces rows writes a *new version folder* beside the old
ones and readers take the newest complete version, so a plan never overwrites the
files it reads and a lost executor or a failed job leaves the old version untouched. The metric table keeps a log of
commits, each naming the parts that make up the table.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METRIC_COLUMNS = ("metric", "period", "entity", "value")


def append_stamped(df: DataFrame, path: str, **stamps: str) -> None:
    """Append rows with literal period columns; the table is partitioned by them."""
    for name, value in stamps.items():
        df = df.withColumn(name, F.lit(value))
    df.write.mode("append").partitionBy(*stamps).parquet(path)


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, p = _hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    done = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if name.startswith("v=") and fs.exists(_hadoop_path(spark, f"{path}/{name}/_SUCCESS")[1]):
            done.append(int(name[2:]))
    return sorted(done)


def replace(df: DataFrame, path: str) -> str:
    """Truncate and insert: write the next version of the table at ``path``."""
    versions = _versions(df.sparkSession, path)
    target = f"{path}/v={(versions[-1] if versions else 0) + 1}"
    df.write.mode("overwrite").parquet(target)
    return target


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of a replaced table."""
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(path)
    return spark.read.parquet(f"{path}/v={versions[-1]}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared folder."""
    fs, p = _hadoop_path(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file of the shared folder."""
    fs, p = _hadoop_path(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_bucketed(df: DataFrame, keys: list[str], name: str) -> tuple[DataFrame, str, str]:
    """Write ``df`` to the shared folder, bucketed by ``keys`` into as many buckets as the session has
    shuffle partitions, and return the table with its name and its path.

    A join or aggregation on the keys then reads it without a shuffle, as often as needed, and an
    executor that is lost takes nothing with it. The caller drops the name when it is done.
    """
    from pressgauge.session import run_path, shuffle_tasks

    spark = df.sparkSession
    buckets = shuffle_tasks(spark)
    path = run_path(spark, name)
    table = f"pressgauge_{path.rsplit('/', 1)[1].replace('-', '_')}"
    (
        df.repartition(buckets, *keys).write.option("path", path)
        .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    )
    return spark.table(table), table, path


def keyed_update(current: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """``current`` with the columns of matching ``changes`` rows; unmatched changes are not inserted.

    A matching row replaces every value, nulls included. ``changes`` holds one row per key.
    """
    values = [c for c in changes.columns if c not in keys]
    new = changes.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in values])
    joined = current.join(new, keys, "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in current.columns
        ]
    )


def metric_rows(df: DataFrame, metric: str, period: str, entity: str, value: str) -> DataFrame:
    """Rows in the metric-table layout."""
    return df.select(
        F.lit(metric).alias("metric"), F.col(period).cast("string").alias("period"),
        F.col(entity).cast("string").alias("entity"), F.col(value).cast("double").alias("value"),
    )


#: Parts of a level of the metric table that are merged into one of the next.
FANOUT = 8
#: Commits after which parts that were merged, and the commits before, are deleted.
RETAIN = 10


def upsert_metrics(spark: SparkSession, path: str, rows: DataFrame, stream: str | None = None, batch: int | None = None) -> bool:
    """Add or replace values per ``(metric, period, entity)``; of repeated keys the largest value counts.

    The rows are evaluated once and written as a part of their own; a commit then names all parts that make up the
    table, so nothing that is read is ever overwritten and a failed write is not seen. Readers take each key's newest
    value. Whenever a level holds FANOUT parts these are merged, so a table of n writes has fewer than FANOUT parts in
    each of its log n levels, and a row is rewritten log n times.

    ``stream`` and ``batch`` name where the rows come from. A batch that was committed already is not written again,
    and the result is False. Two writers may meet: the later one goes on from the other's commit.
    """
    written = None
    while True:
        number, state = _table_state(spark, path)
        if stream is not None and batch is not None and state["streams"].get(stream, -1) >= batch:
            return False
        version = state["next"]
        if written is None:
            single = rows.groupBy("metric", "period", "entity").agg(F.max("value").alias("value"))
            written = _write_part(single, path, 0, version)
        elif written["v"] != version:
            written = _write_part(_read_parts(spark, path, [written]), path, 0, version)
        parts = [*state["parts"], written]
        parts, merged = _levelled(spark, path, parts)
        after = {
            "next": version + 1, "parts": parts, "streams": dict(state["streams"]),
            "gone": [*state["gone"], *({**p, "since": number + 1} for p in merged)],
        }
        if stream is not None and batch is not None:
            after["streams"][stream] = batch
        if _commit(spark, path, number + 1, after):
            return True


def compact_metrics(spark: SparkSession, path: str) -> None:
    """Merge all parts into one and delete what is not read any more, parts of failed writes included. No other
    writer may be at work, nor a reader that began before."""
    number, state = _table_state(spark, path)
    if not state["parts"]:
        return
    whole = _merged(spark, path, state["parts"], max(p["level"] for p in state["parts"]) + 1)
    if not _commit(spark, path, number + 1, {**state, "parts": [whole], "gone": []}):
        raise RuntimeError("the table was changed meanwhile")
    for level in names(spark, f"{path}/data"):
        for version in names(spark, f"{path}/data/{level}"):
            for attempt in names(spark, f"{path}/data/{level}/{version}"):
                folder = f"{level}/{version}/{attempt}"
                if folder != _folder(whole):
                    remove(spark, f"{path}/data/{folder}")
    forget_commits(spark, path, number + 1)


def _folder(part: dict) -> str:
    return f"level={part['level']}/v={part['v']}/attempt={part['attempt']}"


def _write_part(rows: DataFrame, path: str, level: int, version: int) -> dict:
    part = {"level": level, "v": version, "attempt": uuid.uuid4().hex}
    # The runtime splits large partitions of a rebalance, so a period of any size has as many writers as it needs.
    (
        rows.select(*METRIC_COLUMNS).hint("rebalance", "metric", "period")
        .write.partitionBy("metric", "period").parquet(f"{path}/data/{_folder(part)}")
    )
    return part


def _merged(spark: SparkSession, path: str, parts: list[dict], level: int) -> dict:
    """One part of the newest values of some, as old as the newest of them."""
    return _write_part(_read_parts(spark, path, parts), path, level, max(p["v"] for p in parts))


def _levelled(spark: SparkSession, path: str, parts: list[dict]) -> tuple[list[dict], list[dict]]:
    """The parts with full levels merged, and those that went into others. Parts of a level are newer than those above."""
    gone: list[dict] = []
    level = 0
    while any(p["level"] >= level for p in parts):
        own = [p for p in parts if p["level"] == level]
        if len(own) >= FANOUT:
            whole = _merged(spark, path, own, level + 1)
            gone += own
            parts = sorted([*(p for p in parts if p["level"] != level), whole], key=lambda p: p["v"])
        level += 1
    return parts, gone


def names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _hadoop_path(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def commits(spark: SparkSession, path: str) -> list[int]:
    return [int(name) for name in names(spark, f"{path}/commits") if name.isdigit()]


def commit_content(spark: SparkSession, path: str, number: int) -> dict:
    return json.loads(read_text(spark, f"{path}/commits/{number:012d}"))


def _table_state(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number and content of the newest commit: the parts that make up the table, the last batch of each stream, and
    merged parts that readers of earlier commits may still read."""
    done = commits(spark, path)
    if not done:
        return 0, {"next": 1, "parts": [], "streams": {}, "gone": []}
    return done[-1], commit_content(spark, path, done[-1])


def _commit(spark: SparkSession, path: str, number: int, state: dict) -> bool:
    """Make a state the table's; False if another writer has taken the number. Old commits and parts go."""
    old = [p for p in state["gone"] if p["since"] <= number - RETAIN]
    state = {**state, "gone": [p for p in state["gone"] if p not in old]}
    if not publish(spark, path, number, state):
        return False
    for part in old:
        remove(spark, f"{path}/data/{_folder(part)}")
    forget_commits(spark, path, number - RETAIN)
    return True


def publish(spark: SparkSession, path: str, number: int, state: dict) -> bool:
    """Write a commit of a number, whole or not at all; False if there is one."""
    fs, draft = _hadoop_path(spark, f"{path}/commits/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(state), "utf-8"))
    out.close()
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{path}/commits/{number:012d}")
    if fs.exists(target):
        fs.delete(draft, False)
        return False
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), options)
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(e.java_exception):
            return False
        raise
    return True


def forget_commits(spark: SparkSession, path: str, before: int) -> None:
    for number in commits(spark, path):
        if number < before:
            remove(spark, f"{path}/commits/{number:012d}")


def _read_parts(spark: SparkSession, path: str, parts: list[dict]) -> DataFrame:
    # Partition values are text: dates must not be turned into another type by inference.
    schema = "entity string, value double, level int, v bigint, attempt string, metric string, period string"
    if not parts:
        return spark.createDataFrame([], schema).select(*METRIC_COLUMNS)
    rows = spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*(f"{path}/data/{_folder(p)}" for p in parts))
    if len(parts) == 1:
        return rows.select(*METRIC_COLUMNS)
    newest = rows.groupBy("metric", "period", "entity").agg(F.max_by("value", "v").alias("value"))
    return newest.select(*METRIC_COLUMNS)


def read_metric_table(spark: SparkSession, path: str) -> DataFrame:
    """``metric, period, entity, value``: the newest value of each key, by one scan of the table's parts. A filter on
    metric and period reaches the folders of all parts."""
    return _read_parts(spark, path, _table_state(spark, path)[1]["parts"])


def read_period(spark: SparkSession, path: str, metric: str, period: str) -> DataFrame:
    """``entity, value`` of one period, the value cut to an integer. Partition-pruned."""
    return (
        read_metric_table(spark, path)
        .where((F.col("metric") == metric) & (F.col("period") == period))
        .select("entity", F.col("value").cast("bigint").alias("value"))
    )


def read_periods(spark: SparkSession, path: str, metric: str, first_day: str, num: int) -> DataFrame:
    """``period, entity, value`` of the ``num + 1`` days from ``first_day`` on. Partition-pruned."""
    last = F.date_format(F.date_add(F.lit(first_day).cast("date"), num), "yyyy-MM-dd")
    return (
        read_metric_table(spark, path)
        .where((F.col("metric") == metric) & (F.col("period") >= first_day) & (F.col("period") <= last))
        .select("period", "entity", F.col("value").cast("bigint").alias("value"))
    )


def export_text(lines: DataFrame, path: str) -> None:
    """One text file. Only for results small enough for a single writer, such as a top list."""
    lines.select("value").coalesce(1).write.mode("errorifexists").text(path)
