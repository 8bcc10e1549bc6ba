"""Connected components of very large edge lists, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressgauge.session import run_path
from pressgauge.sources.tables import remove


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, with no lineage to lose."""
    path = run_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def forget(table: DataFrame) -> None:
    """Remove a table made by `written`; what reads it must have been computed."""
    for folder in {path.rsplit("/", 1)[0] for path in table.inputFiles()}:
        remove(table.sparkSession, folder)


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``id, root`` for every vertex that has an edge to another: root is the smallest vertex of its component.

    Each round hangs every vertex's larger neighbours on its smallest one, then the smaller ones as well, until
    nothing changes. Minima are combined before the shuffle, the joins with them can be split by the runtime, and
    no neighbour list is ever gathered. Loops, repeated edges and edges with a null end say nothing and are left out.
    """
    now = written(
        edges.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges",
    )
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("low"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").filter("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        now = written(small.union(low.select("u", F.col("low").alias("v"))).distinct(), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    stars = now.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return stars.union(stars.select("root", "root").distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
