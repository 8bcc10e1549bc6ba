"""Iterative graph operators: PageRank and two-class label propagation.

Both are repeated sparse matrix-vector products. The edges are written once to a table bucketed by the
vertex they read from, so a step reads them without a shuffle and moves only the vertex values and the map-side-combined
messages. Lineage is cut with reliable checkpoints every few steps.

A vertex may touch any share of all edges. Its edges are cut into slices of about ``slice_edges``, each a bucketing
key of its own, and its value is sent to each slice; ordinary vertices have one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgauge.session import ensure_checkpoint_dir, run_path, shuffles_dropped
from pressgauge.sources.tables import remove, write_bucketed


class EdgeLayout:
    """Edges ``(at, to, ...)`` bucketed by ``at`` and ``slice``, and ``sizes``: ``at, degree, slices`` of the vertices
    that edges read from. The edges are read twice, so they should be a table."""

    def __init__(self, edges: DataFrame, slice_edges: int):
        ensure_checkpoint_dir(edges.sparkSession)
        edges = edges.where(F.col("at").isNotNull())
        slices = F.ceil(F.col("degree") / F.lit(slice_edges)).cast("int").alias("slices")
        self.sizes = edges.groupBy("at").agg(F.count(F.lit(1)).alias("degree")).select("at", "degree", slices).checkpoint()
        # At most one row for each slice_edges edges; the others have one slice. So edges move once, to their buckets.
        hubs = F.broadcast(self.sizes.where(F.col("slices") > 1).select("at", "slices"))
        slice_of = F.coalesce(F.pmod(F.xxhash64("to"), "slices").cast("int"), F.lit(0))
        placed = edges.join(hubs, "at", "left").withColumn("slice", slice_of).drop("slices")
        self.edges, self._table, self._path = write_bucketed(placed, ["at", "slice"], "edges")

    def read(self, state: DataFrame) -> DataFrame:
        """Each edge with the columns of the ``state`` row of its ``at`` vertex; state has ``vertex`` and ``slices``."""
        spread = (
            state.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices")
            .withColumnRenamed("vertex", "at")
        )
        # A bucket's vertices are far fewer than its edges, which so need not be sorted in every step.
        return self.edges.join(spread.hint("shuffle_hash"), ["at", "slice"])

    def forget(self) -> None:
        """Drop the table and its files; results that read it must have been computed."""
        spark = self.edges.sparkSession
        spark.sql(f"DROP TABLE IF EXISTS {self._table}")
        remove(spark, self._path)


def _table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = run_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def distinct_edges(pairs: DataFrame) -> DataFrame:
    return pairs.select("src", "dst").distinct()


def sinks(edges: DataFrame) -> DataFrame:
    """``vertex`` that is a target and never a source."""
    targets = edges.select(F.col("dst").alias("vertex")).distinct()
    return targets.join(edges.select(F.col("src").alias("vertex")), "vertex", "left_anti")


def adjacency(edges: DataFrame) -> DataFrame:
    """``vertex, out_degree`` of all vertices, sinks with zero. Neighbours stay as edge rows."""
    plus = edges.select(F.explode(F.array(
        F.struct(F.col("src").alias("vertex"), F.lit(1).alias("one")),
        F.struct(F.col("dst").alias("vertex"), F.lit(0).alias("one")),
    )).alias("v")).select("v.*")
    return plus.groupBy("vertex").agg(F.sum("one").cast("bigint").alias("out_degree"))


def edges_from_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Distinct ``src, dst`` of space-separated lines with exactly two fields."""
    parts = F.split(F.trim(F.col(line)), " ")
    return distinct_edges(lines.where(F.size(parts) == 2).select(parts[0].alias("src"), parts[1].alias("dst")))


def pagerank(
    pairs: DataFrame, steps: int, damping: float = 0.85, keep_sources: bool = False,
    checkpoint_every: int = 5, slice_edges: int = 1_000_000,
) -> DataFrame:
    """``vertex, rank`` after ``steps`` rounds of ``(1 - damping) + damping * sum(rank / out_degree)``.

    All ranks start at 1 and are not normalised; rank on a sink is lost. A vertex that receives
    nothing in a round drops out and sends nothing in the next; with ``keep_sources`` it stays at
    ``1 - damping`` instead. Repeated pairs count once. Computed eagerly.
    """
    edges = distinct_edges(pairs)
    if steps == 0:
        return _ends(edges, "src", "dst").withColumn("rank", F.lit(1.0))
    edges, path = _table(edges.select(F.col("src").alias("at"), F.col("dst").alias("to")), "pairs")
    layout = EdgeLayout(edges, slice_edges)
    remove(edges.sparkSession, path)
    sources = layout.sizes.withColumnRenamed("at", "vertex")
    vertices = None
    if keep_sources:
        every = sources.select("vertex").union(layout.edges.select("to").distinct()).distinct()
        vertices = every.select("vertex", F.lit(0.0).alias("share")).checkpoint()
    ranks, state = None, sources.withColumn("rank", F.lit(1.0))
    for step in range(1, steps + 1):
        share = (F.col("rank") / F.col("degree")).alias("share")
        sent = layout.read(state.select("vertex", "slices", share)).select(F.col("to").alias("vertex"), "share")
        if vertices is not None:
            sent = sent.unionByName(vertices)
        ranks = sent.groupBy("vertex").agg((F.sum("share") * damping + (1.0 - damping)).alias("rank"))
        if step % checkpoint_every == 0 or step == steps:
            ranks = ranks.checkpoint()
        state = ranks.join(sources, "vertex")
    layout.forget()
    return ranks


def by_rank(ranks: DataFrame, name: str = "vertex", rank: str = "rank") -> DataFrame:
    """The rows in descending rank, ties by name."""
    return ranks.orderBy(F.desc(rank), name)


def _ends(edges: DataFrame, a: str, b: str) -> DataFrame:
    return edges.select(F.explode(F.array(a, b)).alias("vertex")).distinct()


def _both_ways(pairs: DataFrame) -> DataFrame:
    w = F.col("w").cast("double").alias("w")
    return pairs.select(F.inline(F.array(
        F.struct(F.col("src").alias("src"), F.col("dst").alias("dst"), w),
        F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"), w),
    )))


def similarity_graph(pairs: DataFrame) -> DataFrame:
    """``src, dst, w``: pairs in both directions and a self loop of weight 1 for each vertex."""
    both = _both_ways(pairs)
    loops = both.select("src").distinct().select("src", F.col("src").alias("dst"), F.lit(1.0).alias("w"))
    return both.unionByName(loops)


def row_normalise(graph: DataFrame) -> DataFrame:
    """Weights divided by the sum over their row.

    Sums are combined map-side and joined back, so a row of any length is spread over tasks.
    """
    totals = graph.groupBy("src").agg(F.sum("w").alias("total"))
    return graph.join(totals, "src").select("src", "dst", (F.col("w") / F.nullif("total", F.lit(0.0))).alias("w"))


def _one_hot(label: Column) -> tuple[Column, Column]:
    p1 = F.when(label == 1, 1.0).otherwise(0.0)
    return 1.0 - p1, p1


def label_propagation(
    pairs: DataFrame, labels: DataFrame, iterations: int = 50, tolerance: float | None = None,
    checkpoint_every: int = 5, slice_edges: int = 1_000_000,
) -> tuple[DataFrame, DataFrame]:
    """Two-class label propagation: ``(scores, trace)``.

    ``pairs`` are undirected ``src, dst, w``; ``labels`` are ``id, known, label``. One product and then
    ``iterations`` further ones; known vertices are reset to their label after each, others are scaled
    to sum to one. Vertices without edges are absent. ``scores`` is ``id, known, label, p0, p1, final``
    with final 0.0 where p0 >= 0.5, else 1.0; ``trace`` is ``step, difference``, the sum of absolute
    changes of p1 per iteration. With ``tolerance`` the run ends after the first step that is a multiple of
    ``checkpoint_every`` and changed less than that. Computed eagerly.

    A vertex's own values travel along its self loop, so a step reads the state once; labels are joined to the sums.
    A step's state is a table that the next one's replaces, and its messages are deleted with the step, so that only one
    step's are on disk at a time.
    """
    spark = pairs.sparkSession
    with shuffles_dropped(spark):
        state, moves = _propagated(pairs, labels, iterations, tolerance, checkpoint_every, slice_edges)
    trace = spark.createDataFrame(moves, "step int, difference double")
    scores = state.select(
        F.col("vertex").alias("id"), "known", "label", "p0", "p1", F.when(F.col("p0") >= 0.5, 0.0).otherwise(1.0).alias("final")
    )
    return scores, trace


def _propagated(
    pairs: DataFrame, labels: DataFrame, iterations: int, tolerance: float | None, checkpoint_every: int, slice_edges: int,
) -> tuple[DataFrame, list[tuple[int, float]]]:
    """The state after the last step as a table, and the steps with their differences."""
    spark = pairs.sparkSession
    pairs, path = _table(pairs.select("src", "dst", "w"), "pairs")
    both = _both_ways(pairs).select(F.col("dst").alias("at"), F.col("src").alias("to"), "w", F.lit(False).alias("own"))
    # Scores of a vertex are rescaled to sum to one, so its row sum cancels and the raw weights do.
    loops = both.select("at").distinct().select("at", F.col("at").alias("to"), F.lit(1.0).alias("w"), F.lit(True).alias("own"))
    layout = EdgeLayout(both.unionByName(loops), slice_edges)
    remove(spark, path)
    start0, start1 = _one_hot(F.col("label"))
    state = labels.join(layout.sizes, F.col("id") == F.col("at")).select(
        F.col("id").alias("vertex"), "slices", start0.alias("p0"), start1.alias("p1"),
    )
    # What stays the same is not sent along the edges.
    fixtures = labels.groupBy("id").agg(F.max("known").alias("known"), F.max("label").alias("label"))
    fixtures = fixtures.join(layout.sizes, F.col("id") == F.col("at")).select(F.col("id").alias("vertex"), "slices", "known", "label").checkpoint()
    moves: list[tuple[int, float]] = []
    last = None
    for step in range(0, iterations + 1):
        before = [F.max(F.when(F.col("own"), F.col("p1"))).alias("before")] if step else []
        sums = layout.read(state.select("vertex", "slices", "p0", "p1")).groupBy(F.col("to").alias("vertex")).agg(
            *before, F.sum(F.col("w") * F.col("p0")).alias("s0"), F.sum(F.col("w") * F.col("p1")).alias("s1"),
        ).join(fixtures, "vertex")
        total = F.nullif(F.col("s0") + F.col("s1"), F.lit(0.0))
        fixed = F.col("known") == 1
        p1 = F.when(fixed, start1).otherwise(F.col("s1") / total)
        # The first product has no predecessor in the trace.
        move = [F.abs(p1 - F.col("before")).alias("move")] if step else []
        state, path = _table(sums.select(
            "vertex", "slices", "known", "label", F.when(fixed, start0).otherwise(F.col("s0") / total).alias("p0"), p1.alias("p1"), *move,
        ), "state")
        if last is not None:
            remove(spark, last)
        last = path
        if step:
            there, difference = state.agg(F.count(F.lit(1)), F.sum("move")).first()
            moves += [(step, difference)] if there else []
            if tolerance is not None and step % checkpoint_every == 0 and (not there or difference < tolerance):
                break
    layout.forget()
    return state, moves
