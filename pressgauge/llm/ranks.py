"""Places in a global order, without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressgauge.llm.graph import written
from pressgauge.session import shuffle_tasks


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """The rows with ``rank``, from 0 on, in the given order.

    Ranges of rows are sorted each by itself; the rank is the place in the range plus the rows of the ranges before,
    which are as many as there are shuffle partitions. Equal rows get different ranks."""
    parts = shuffle_tasks(rows.sparkSession)
    placed = written(
        rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()), "ranked",
    )
    part, place = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    # One row for each shuffle partition.
    return placed.withColumn("_part", part).join(F.broadcast(sizes), "_part").withColumn(
        "rank", place + F.col("_before"),
    ).drop("_part", "_place", "_before")
