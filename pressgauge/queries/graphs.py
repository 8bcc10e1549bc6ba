"""PageRank, TextRank, label propagation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.functions.text import words
from pressgauge.operators import graph, textrank
from pressgauge.queries import inputs as i

RANK_STEPS = 5
PROPAGATION_STEPS = 10
WINDOW = 3


def _links(spark: SparkSession, d: str) -> DataFrame:
    """``src, dst``: customer -> part ordered, part -> supplier, supplier -> nation.

    Parts and suppliers share their numbers, so that there are cycles; customers are never targets,
    nations never sources.
    """
    lines = i.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    orders = i.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    bought = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.concat(F.lit("c"), "o_custkey").alias("src"), F.col("l_partkey").cast("string").alias("dst")
    )
    supplied = lines.select(F.col("l_partkey").cast("string").alias("src"), F.col("l_suppkey").cast("string").alias("dst"))
    placed = i.table(spark, d, "supplier").select(
        F.col("s_suppkey").cast("string").alias("src"), F.concat(F.lit("n"), "s_nationkey").alias("dst")
    )
    return bought.unionByName(supplied).unionByName(placed)


def graph_build(spark: SparkSession, d: str) -> DataFrame:
    return graph.adjacency(graph.distinct_edges(_links(spark, d)))


def graph_sinks(spark: SparkSession, d: str) -> DataFrame:
    return graph.sinks(_links(spark, d))


def pagerank(spark: SparkSession, d: str) -> DataFrame:
    ranks = graph.pagerank(_links(spark, d), RANK_STEPS)
    return graph.by_rank(ranks.withColumn("rank", F.round("rank", 6)))


def pagerank_first(spark: SparkSession, d: str) -> DataFrame:
    ranks = graph.pagerank(_links(spark, d), 1)
    return ranks.withColumn("rank", F.round("rank", 6))


def pagerank_keep_sources(spark: SparkSession, d: str) -> DataFrame:
    ranks = graph.pagerank(_links(spark, d), RANK_STEPS, keep_sources=True)
    return ranks.withColumn("rank", F.round("rank", 6))


def word_graph(spark: SparkSession, d: str) -> DataFrame:
    return textrank.degrees(i.documents(spark, d, "text"), WINDOW, tokens=words(F.col("text")))


def _scores(spark: SparkSession, d: str) -> DataFrame:
    docs = i.table(spark, d, "documents").select("doc_id", "text")
    scores = textrank.textrank(docs, WINDOW, RANK_STEPS, tokens=words(F.col("text")))
    return scores.withColumn("score", F.round("score", 6))


def text_rank(spark: SparkSession, d: str) -> DataFrame:
    return textrank.by_score(_scores(spark, d))


def text_top_words(spark: SparkSession, d: str) -> DataFrame:
    # Rounded before placing, so that equal scores tie whatever the order of their sums.
    return textrank.top_words(_scores(spark, d), 10)


def _similarities(spark: SparkSession, d: str) -> DataFrame:
    """Part and supplier vertices (even and odd ids), joined by the quantity they share."""
    lines = i.table(spark, d, "lineitem")
    return (
        lines.groupBy((F.col("l_partkey") * 2).alias("src"), (F.col("l_suppkey") * 2 + 1).alias("dst"))
        .agg((F.sum("l_quantity") / 50.0).alias("w"))
    )


def _vertices(spark: SparkSession, d: str) -> DataFrame:
    parts = i.table(spark, d, "part").select(
        (F.col("p_partkey") * 2).alias("id"), F.when(F.col("p_size") <= 15, 1).otherwise(0).alias("known"),
        F.when(F.col("p_size") <= 8, 1).otherwise(0).alias("label"),
    )
    suppliers = i.table(spark, d, "supplier").select(
        (F.col("s_suppkey") * 2 + 1).alias("id"), F.lit(0).alias("known"), F.lit(0).alias("label")
    )
    return parts.unionByName(suppliers)


def label_propagation(spark: SparkSession, d: str) -> DataFrame:
    scores, _ = graph.label_propagation(_similarities(spark, d), _vertices(spark, d), PROPAGATION_STEPS)
    return scores.withColumn("p0", F.round("p0", 6)).withColumn("p1", F.round("p1", 6))


def label_trace(spark: SparkSession, d: str) -> DataFrame:
    _, trace = graph.label_propagation(_similarities(spark, d), _vertices(spark, d), PROPAGATION_STEPS)
    return trace.withColumn("difference", F.round("difference", 6))


def transition_weights(spark: SparkSession, d: str) -> DataFrame:
    weights = graph.row_normalise(graph.similarity_graph(_similarities(spark, d)))
    return weights.withColumn("w", F.round("w", 9))


_LINKS = """edges AS (
  SELECT DISTINCT 'c' || o_custkey AS src, CAST(l_partkey AS VARCHAR) AS dst
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION SELECT CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR) FROM lineitem
  UNION SELECT CAST(s_suppkey AS VARCHAR), 'n' || s_nationkey FROM supplier),
vertices AS (SELECT src AS vertex FROM edges UNION SELECT dst FROM edges),
deg AS (SELECT src, count(*) AS degree FROM edges GROUP BY ALL)"""


def _rank_sql(steps: int, keep: bool) -> str:
    parts = [f"WITH {_LINKS}", "r0 AS (SELECT vertex, 1.0::DOUBLE AS rank FROM vertices)"]
    for k in range(1, steps + 1):
        sent = f"""SELECT dst AS vertex, rank / degree AS share
  FROM edges JOIN deg USING (src) JOIN r{k - 1} ON vertex = src"""
        if keep:
            sent += " UNION ALL SELECT vertex, 0.0 FROM vertices"
        parts.append(f"r{k} AS MATERIALIZED (SELECT vertex, 0.15 + 0.85 * sum(share) AS rank FROM ({sent}) GROUP BY ALL)")
    return ",\n".join(parts) + f"\nSELECT vertex, round(rank, 6) AS rank FROM r{steps}"


_WORDS = f"""tok AS (
  SELECT doc_id, generate_subscripts(ws, 1) AS pos, unnest(ws) AS word
  FROM (SELECT doc_id, regexp_extract_all(text, '[\\p{{L}}]+') AS ws FROM documents)),
wedges AS MATERIALIZED (
  SELECT DISTINCT a.doc_id, a.word AS src, b.word AS dst
  FROM tok a JOIN (SELECT unnest([-3, -2, -1, 1, 2, 3]) AS step) ON true
  JOIN tok b ON b.doc_id = a.doc_id AND b.pos = a.pos + step),
wdeg AS (SELECT doc_id, src, count(*) AS degree FROM wedges GROUP BY ALL)"""


def _text_rank_sql(steps: int) -> str:
    parts = [f"WITH {_WORDS}", "t0 AS (SELECT doc_id, src AS word, 1.0::DOUBLE AS score FROM wdeg)"]
    for k in range(1, steps + 1):
        parts.append(f"""t{k} AS MATERIALIZED (SELECT e.doc_id, e.dst AS word, 0.15 + 0.85 * sum(score / degree) AS score
  FROM wedges e JOIN wdeg USING (doc_id, src) JOIN t{k - 1} t ON t.doc_id = e.doc_id AND t.word = e.src GROUP BY ALL)""")
    return ",\n".join(parts) + f",\nranked AS (SELECT doc_id, word, round(score, 6) AS score FROM t{steps})"


_GRAPH = """pairs AS (
  SELECT l_partkey * 2 AS src, l_suppkey * 2 + 1 AS dst, sum(l_quantity) / 50.0 AS w FROM lineitem GROUP BY ALL),
both_ways AS (SELECT src, dst, w FROM pairs UNION ALL SELECT dst, src, w FROM pairs),
looped AS (SELECT * FROM both_ways UNION ALL SELECT DISTINCT src, src, 1.0 FROM both_ways),
weights AS MATERIALIZED (SELECT src, dst, w / sum(w) OVER (PARTITION BY src) AS w FROM looped),
labels0 AS (
  SELECT p_partkey * 2 AS id, CASE WHEN p_size <= 15 THEN 1 ELSE 0 END AS known,
    CASE WHEN p_size <= 8 THEN 1 ELSE 0 END AS label FROM part
  UNION ALL SELECT s_suppkey * 2 + 1, 0, 0 FROM supplier)"""


def _propagation_sql(steps: int) -> str:
    parts = [
        f"WITH {_GRAPH}",
        "y0 AS (SELECT *, CASE WHEN label = 1 THEN 0.0 ELSE 1.0 END::DOUBLE AS p0, CASE WHEN label = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS p1 FROM labels0)",
    ]
    for k in range(1, steps + 2):
        parts.append(f"""y{k} AS MATERIALIZED (
  SELECT l.id, l.known, l.label,
    CASE WHEN known = 1 THEN CASE WHEN label = 1 THEN 0.0 ELSE 1.0 END ELSE s0 / (s0 + s1) END AS p0,
    CASE WHEN known = 1 THEN CASE WHEN label = 1 THEN 1.0 ELSE 0.0 END ELSE s1 / (s0 + s1) END AS p1
  FROM labels0 l JOIN (SELECT src AS id, sum(w * p0) AS s0, sum(w * p1) AS s1
    FROM weights JOIN y{k - 1} ON id = dst GROUP BY ALL) USING (id))""")
    return ",\n".join(parts)


QUERIES = {
    "graph_build": (graph_build, f"""WITH {_LINKS}
SELECT vertex, coalesce(degree, 0) AS out_degree FROM vertices LEFT JOIN deg ON src = vertex"""),
    "graph_sinks": (graph_sinks, f"WITH {_LINKS} SELECT vertex FROM vertices WHERE vertex NOT IN (SELECT src FROM edges)"),
    "pagerank": (pagerank, _rank_sql(RANK_STEPS, False)),
    "pagerank_first": (pagerank_first, _rank_sql(1, False)),
    "pagerank_keep_sources": (pagerank_keep_sources, _rank_sql(RANK_STEPS, True)),
    "word_graph": (word_graph, f"WITH {_WORDS} SELECT doc_id, src AS word, degree FROM wdeg"),
    "textrank": (text_rank, _text_rank_sql(RANK_STEPS) + "\nSELECT * FROM ranked"),
    "text_top_words": (text_top_words, _text_rank_sql(RANK_STEPS) + """
SELECT doc_id, word, score, CAST(place AS INTEGER) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, word) AS place FROM ranked) WHERE place <= 10"""),
    "label_propagation": (label_propagation, _propagation_sql(PROPAGATION_STEPS) + f"""
SELECT id, known, label, round(p0, 6) AS p0, round(p1, 6) AS p1,
  CASE WHEN p0 >= 0.5 THEN 0.0 ELSE 1.0 END::DOUBLE AS final FROM y{PROPAGATION_STEPS + 1}"""),
    "label_trace": (label_trace, _propagation_sql(PROPAGATION_STEPS) + "\n" + " UNION ALL ".join(
        f"SELECT {k} AS step, round(sum(abs(a.p1 - b.p1)), 6) AS difference FROM y{k + 1} a JOIN y{k} b USING (id)"
        for k in range(1, PROPAGATION_STEPS + 1))),
    "transition_weights": (transition_weights, f"WITH {_GRAPH} SELECT src, dst, round(w, 9) AS w FROM weights"),
}
