"""Rankings as files: one folder a group, whose files, in the order of their names, hold its rows in the order of their places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressgauge.session import run_path, shuffle_tasks
from pressgauge.sources.tables import remove


def write_ranking(rows: DataFrame, path: str, group: str, value: str, name: str, kind: str = "parquet") -> None:
    """Rows with their ``place`` in the group, largest value first, ties by name, nulls last and as text first.

    Rows are dealt to ranges of (group, value, name), so a group of any size is the work of many tasks. A place is the
    row's number in its range and group, plus the group's rows in the ranges before, of which there is one count for
    each range and group.
    """
    spark = rows.sparkSession
    tasks, order = shuffle_tasks(spark), (F.desc(value), F.asc(name))
    dealt = run_path(spark, "ranking")
    # Written once: what is counted and what is placed must be the same ranges.
    rows.repartitionByRange(tasks, F.asc(group), *order).withColumn("pg_range", F.spark_partition_id()).write.parquet(dealt)
    ranges = spark.read.schema(T.StructType([*rows.schema, T.StructField("pg_range", T.IntegerType())])).parquet(dealt)
    before = W.partitionBy("pg_group").orderBy("pg_no").rowsBetween(W.unboundedPreceding, -1)
    counts = (
        ranges.groupBy(F.col(group).alias("pg_group"), F.col("pg_range").alias("pg_no")).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("pg_before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    )
    both = ranges.join(counts, (F.col("pg_range") == F.col("pg_no")) & F.col(group).eqNullSafe(F.col("pg_group")))
    within = W.partitionBy(group, "pg_range").orderBy(*order)
    (
        # Window and writer keep these ranges, so a task's rows are in order and tasks follow one another.
        both.repartitionByRange(tasks, group, "pg_range")
        .withColumn("place", F.row_number().over(within) + F.col("pg_before"))
        .select("place", *rows.columns).write.partitionBy(group).format(kind).save(path)
    )
    remove(spark, dealt)
