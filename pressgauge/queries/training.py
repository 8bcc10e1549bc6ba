"""Training sets, cleaning, word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.functions import text as tx
from pressgauge.operators import training
from pressgauge.queries import inputs as i
from pressgauge.session import run_path
from pressgauge.sources import logs

STOP_WORDS = ["the", "of", "and", "la", "de", "der", "die"]
# The test documents hold no CJK text: lower-case words take its place.
LOWER_WORD = "^\\p{Ll}+\\z"


def _corpus(spark: SparkSession, d: str) -> DataFrame:
    return i.table(spark, d, "documents").select("doc_id", F.col("source").alias("category"))


def training_sets(spark: SparkSession, d: str) -> DataFrame:
    return training.training_sets(_corpus(spark, d), seed=7)


def training_summary(spark: SparkSession, d: str) -> DataFrame:
    return training.training_summary(training.training_sets(_corpus(spark, d), seed=7))


def training_by_language(spark: SparkSession, d: str) -> DataFrame:
    """Few, uneven categories: one of them holds most documents, so all others are its negatives."""
    docs = i.table(spark, d, "documents").select("doc_id", F.col("lang").alias("category"))
    return training.training_summary(training.training_sets(docs, seed=7))


def labelled_corpus(spark: SparkSession, d: str) -> DataFrame:
    """``category,text`` lines written per category, read back; lines with a comma in the text drop out."""
    path = run_path(spark, "corpus")
    line = F.concat("source", F.lit(","), F.regexp_replace("text", "[\r\n]", " "))
    i.table(spark, d, "documents").select(line.alias("value"), "source").write.partitionBy("source").text(path)
    return logs.parse_labelled_lines(logs.read_lines(spark, f"{path}/*")).groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")
    )


def token_clean(spark: SparkSession, d: str) -> DataFrame:
    cleaned = tx.clean_document(F.col("text"), STOP_WORDS, patterns=(LOWER_WORD, tx.SIX_DIGITS))
    return i.documents(spark, d, "text").select("doc_id", cleaned.alias("cleaned"))


def word_frequency(spark: SparkSession, d: str) -> DataFrame:
    tokens = tx.remove_stop_words(tx.words(F.col("text")), STOP_WORDS)
    return training.word_frequency(i.documents(spark, d, "text").select(tokens.alias("tokens")))


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)


def _unit(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 12) AS BIGINT) / 281474976710656.0"


def _sets(column: str) -> str:
    """Others in the order of their points from the category's first bin (of 4096) on, as many as there are positives."""
    return f"""WITH docs AS (SELECT doc_id, {column} AS category, {_unit("doc_id || '|doc7'")} AS point FROM documents),
sizes AS (SELECT category AS target, count(*) AS pos, floor({_unit("category || '|start7'")} * 4096) AS start
  FROM docs GROUP BY category),
placed AS (SELECT target, doc_id, pos, row_number() OVER (
    PARTITION BY target ORDER BY CASE WHEN floor(point * 4096) < start THEN 1 ELSE 0 END, point, doc_id) AS place
  FROM docs JOIN sizes ON category <> target),
drawn AS (SELECT target, doc_id, 0 AS label FROM placed WHERE place <= pos
  UNION ALL SELECT category, doc_id, 1 FROM docs)"""


_SUMMARY = """
SELECT target, CAST(sum(label) AS BIGINT) AS positives, CAST(sum(1 - label) AS BIGINT) AS negatives
FROM drawn GROUP BY ALL"""

QUERIES = {
    "training_sets": (training_sets, _sets("source") + " SELECT target, doc_id, label FROM drawn"),
    "training_summary": (training_summary, _sets("source") + _SUMMARY),
    "training_by_language": (training_by_language, _sets("lang") + _SUMMARY),
    "labelled_corpus": (labelled_corpus, """
SELECT source AS category, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents
WHERE NOT contains(text, ',') AND text <> '' GROUP BY ALL"""),
    "token_clean": (token_clean, f"""
WITH t AS (SELECT doc_id, generate_subscripts(ws, 1) AS k, unnest(ws) AS w
  FROM (SELECT doc_id, regexp_extract_all(text, '[\\p{{L}}]+') AS ws FROM documents))
SELECT doc_id, coalesce(string_agg(w, '/' ORDER BY k)
  FILTER (WHERE regexp_full_match(w, '\\p{{Ll}}+') AND w NOT IN ({_STOP})), '') AS cleaned
FROM documents LEFT JOIN t USING (doc_id) GROUP BY ALL"""),
    "word_frequency": (word_frequency, f"""
SELECT w AS word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[\\p{{L}}]+')) AS w FROM documents)
WHERE w NOT IN ({_STOP}) GROUP BY ALL"""),
}
