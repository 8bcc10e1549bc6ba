"""One-versus-rest training sets for text categories, and word counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _unit_hash(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the joined parts; stable across engines and runs."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


#: Documents of a bin of the circle, about.
BIN = 1000


def training_sets(docs: DataFrame, seed: int = 0, doc: str = "doc_id", category: str = "category",
                  keep: tuple[str, ...] = (), bins: int | None = None) -> DataFrame:
    """``target, doc, label`` (and ``keep``): for each category all its documents with label 1 and a random choice of
    the others with label 0, exactly as many, or all others where there are fewer.

    Every document gets a random point on a circle of ``bins`` bins (one for about BIN documents) and every category
    a random bin to start from; a category's negatives are the first other documents from there on, ties by ``doc``.
    Counts by bin and by bin and category tell in which bin the last of them lies. The bins before are taken whole and
    that one's documents are placed in order, so nothing but one bin a category is ever sorted. Drawing is an
    equi-join by bin whose work follows the result, not documents times categories. Documents without a category take
    no part.
    """
    docs = docs.where(F.col(category).isNotNull())
    total = docs.count()
    bins = bins or max(4096, -(-total // BIN))
    point = docs.select(doc, category, *keep, _unit_hash(F.col(doc), F.lit(f"doc{seed}")).alias("point")).withColumn(
        "b", F.floor(F.col("point") * bins),
    )
    own = point.groupBy("b", category).agg(F.count(F.lit(1)).alias("own"))
    every = own.groupBy("b").agg(F.sum("own").alias("every"))
    wanted = own.groupBy(F.col(category).alias("target")).agg(F.sum("own").alias("pos")).select(
        "target", F.least("pos", F.lit(total) - F.col("pos")).alias("need"),
        F.floor(_unit_hash(F.col("target"), F.lit(f"start{seed}")) * bins).alias("start"),
        (F.col("pos") / F.nullif(F.lit(total) - F.col("pos"), F.lit(0))).alias("share"),
    ).where("need > 0")
    cut = _arcs(wanted, own, every, category, bins, F.col("share") * 1.25 * bins + 16)
    # Where the documents lie so unevenly that this is too short an arc, the whole circle is looked at.
    short = wanted.join(cut.where("upto >= need").select("target").distinct(), "target", "left_anti")
    cut = cut.join(short, "target", "left_anti").unionByName(_arcs(short, own, every, category, bins, F.lit(bins)))
    cut = cut.where("before < need").select("target", "b", (F.col("need") - F.col("before")).alias("left"), "others")
    drawn = point.join(cut, "b").where(F.col(category) != F.col("target"))
    whole = drawn.where("others <= left")
    last = drawn.where("others > left").withColumn(
        "place", F.row_number().over(W.partitionBy("target").orderBy("point", doc)),
    ).where(F.col("place") <= F.col("left"))
    columns = ["target", doc, F.lit(0).alias("label"), *keep]
    positives = docs.select(F.col(category).alias("target"), doc, F.lit(1).alias("label"), *keep)
    return positives.unionByName(whole.select(columns)).unionByName(last.select(columns))


def _arcs(wanted: DataFrame, own: DataFrame, every: DataFrame, category: str, bins: int, length: Column) -> DataFrame:
    """``target, need, b, others, before, upto``: the bins from each category's start on with their documents of other
    categories, and how many of these lie before each bin and up to its end."""
    steps = F.sequence(F.lit(0).cast("long"), F.least(F.ceil(length), F.lit(bins)).cast("long") - 1)
    arcs = wanted.select("target", "need", "start", F.explode(steps).alias("r")).withColumn(
        "b", F.pmod(F.col("start") + F.col("r"), F.lit(bins)),
    )
    counted = arcs.join(every, "b").join(own.withColumnRenamed(category, "target"), ["b", "target"], "left")
    others = F.col("every") - F.coalesce("own", F.lit(0))
    upto = F.sum("others").over(W.partitionBy("target").orderBy("r"))
    return counted.withColumn("others", others).withColumn("upto", upto).select(
        "target", "need", "b", "others", (F.col("upto") - F.col("others")).alias("before"), "upto",
    ).where("others > 0")


def training_summary(sets: DataFrame) -> DataFrame:
    """``target, positives, negatives``."""
    return sets.groupBy("target").agg(
        F.sum("label").cast("bigint").alias("positives"),
        F.sum(1 - F.col("label")).cast("bigint").alias("negatives"),
    )


def word_frequency(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``word, n`` over all documents, most frequent first, ties by word."""
    return (
        # The outer form: for the plain one Spark adds a test for empty lists that computes the tokens again.
        docs.select(F.explode_outer(tokens).alias("word")).where(F.col("word").isNotNull())
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "word")
    )
