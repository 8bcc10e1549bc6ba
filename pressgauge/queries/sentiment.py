"""Lexicon and rule sentiment, Naive-Bayes classification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.functions import text as tx
from pressgauge.operators import classify, sentiment
from pressgauge.queries import inputs as i
from pressgauge.session import run_path
from pressgauge.sources import logs

# Frequent words of the test documents as a lexicon.
POSITIVE = ["the", "de", "and", "la", "is", "que"]
NEGATIVE = ["of", "to", "der", "en", "that", "que"]
NEGATORS = ["in", "a", "it"]


def _lexicon(spark: SparkSession) -> DataFrame:
    rows = [("Pos", w) for w in POSITIVE] + [("Neg", w) for w in NEGATIVE] + [("Fou", w) for w in NEGATORS]
    return spark.createDataFrame(rows, "polarity string, word string")


def sentence_split(spark: SparkSession, d: str) -> DataFrame:
    docs = i.documents(spark, d, "text")
    return docs.select("doc_id", F.posexplode(tx.sentences(F.col("text"))).alias("sentence", "text"))


def sentence_polarity(spark: SparkSession, d: str) -> DataFrame:
    return sentiment.sentence_polarities(i.documents(spark, d, "text"), _lexicon(spark))


def sentence_polarity_joined(spark: SparkSession, d: str) -> DataFrame:
    """The same against a lexicon larger than any list: every word of the documents that is in no list, thrice
    over under kinds that don't count, besides the lists."""
    rest = i.documents(spark, d, "text").select(F.explode(tx.words(F.col("text"))).alias("word")).distinct()
    noise = rest.select(F.explode(F.array(*[F.lit(f"Other{k}") for k in range(3)])).alias("polarity"), "word")
    return sentiment.sentence_polarities(i.documents(spark, d, "text"), _lexicon(spark).union(noise))


def doc_sentiment(spark: SparkSession, d: str) -> DataFrame:
    return sentiment.document_sentiment(i.documents(spark, d, "text"), _lexicon(spark))


def title_sentiment(spark: SparkSession, d: str) -> DataFrame:
    texts, lexicon = i.title_and_body(spark, d), _lexicon(spark)
    both = sentiment.title_sentiment(texts, lexicon)
    only = sentiment.title_sentiment(texts, lexicon, title_only=True)
    return both.join(only.withColumnRenamed("label", "title_label"), "doc_id")


def lexicon_file_sentiment(spark: SparkSession, d: str) -> DataFrame:
    """Three word-list files written to the shared folder, read back as a lexicon, to document labels."""
    lists = []
    for name, listed in (("positive", POSITIVE), ("negative", NEGATIVE), ("negators", NEGATORS)):
        path = run_path(spark, f"words-{name}")
        lines = ["\ufeff" + listed[0], *[f" {w} " for w in listed[1:]], ""]
        spark.createDataFrame([(w,) for w in lines], "value string").write.text(path)
        lists.append(logs.parse_word_list(logs.read_lines(spark, path)))
    lexicon = sentiment.lexicon_from_word_lists(*lists)
    return sentiment.document_sentiment(i.documents(spark, d, "text"), lexicon)


def _tagged(text):
    """Tokens with a made-up word class: verbs have an even length."""
    return F.transform(tx.words(text), lambda w: F.struct(
        w.alias("word"), F.when(F.length(w) % 2 == 0, "v").otherwise("n").alias("tag")
    ))


def pos_rule_score(spark: SparkSession, d: str) -> DataFrame:
    return sentiment.rule_scores(i.documents(spark, d, "text"), _lexicon(spark), tagged=_tagged(F.col("text")))


def pos_rule_sentiment(spark: SparkSession, d: str) -> DataFrame:
    lexicon = _lexicon(spark)
    return sentiment.rule_sentiment(i.title_and_body(spark, d), lexicon, lexicon, tagged=_tagged(F.col("title")))


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    docs = i.documents(spark, d, "text").select("doc_id", tx.words(F.col("text")).alias("tokens"))
    return docs.join(i.table(spark, d, "labels"), "doc_id")


def _unlabelled(spark: SparkSession, d: str) -> DataFrame:
    return i.documents(spark, d, "text").select("doc_id", tx.words(F.col("text")).alias("tokens"))


def nb_predict(spark: SparkSession, d: str) -> DataFrame:
    """Quality classes (1 low, 3 high) learned from the labelled documents, predicted for all."""
    train = _labelled(spark, d).select("tokens", (F.col("quality") * 2 + 1).alias("label"))
    return classify.predict(classify.fit(train), _unlabelled(spark, d))


def nb_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Toxic or other first, then low or high quality."""
    docs = _labelled(spark, d)
    first = classify.fit(docs.select("tokens", F.when(F.col("toxic") == 1, 1).otherwise(4).alias("label")))
    second = classify.fit(docs.select("tokens", (F.col("quality") + 2).alias("label")))
    return classify.predict_cascade(first, second, _unlabelled(spark, d))


def nb_probability(spark: SparkSession, d: str) -> DataFrame:
    train = _labelled(spark, d).select("tokens", F.col("quality").alias("label"))
    return classify.class_probabilities(classify.fit(train), _unlabelled(spark, d))


_SPLIT = "[,。\\t\\n，：]"


def _lists(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _scored(table: str, column: str, name: str) -> str:
    """Sentence polarity by token rows and window functions."""
    return f"""{name}_s AS (
  SELECT doc_id, generate_subscripts(ss, 1) - 1 AS sentence, unnest(ss) AS s
  FROM (SELECT doc_id, regexp_split_to_array({column}, '{_SPLIT}') AS ss FROM {table})),
{name}_t AS (
  SELECT doc_id, sentence, generate_subscripts(ws, 1) - 1 AS i, unnest(ws) AS w
  FROM (SELECT doc_id, sentence, regexp_extract_all(s, '[\\p{{L}}]+') AS ws FROM {name}_s)),
{name}_h AS (
  SELECT doc_id, sentence,
    (CAST(w IN ({_lists(POSITIVE)}) AS INTEGER) - CAST(w IN ({_lists(NEGATIVE)}) AS INTEGER))
    * CASE WHEN (i - 1 > 0 AND lag(w, 1) OVER o IN ({_lists(NEGATORS)}))
             OR (i - 2 > 0 AND lag(w, 2) OVER o IN ({_lists(NEGATORS)}))
             OR coalesce(lead(w, 1) OVER o IN ({_lists(NEGATORS)}), false)
             OR coalesce(lead(w, 2) OVER o IN ({_lists(NEGATORS)}), false) THEN -1 ELSE 1 END AS hit
  FROM {name}_t WINDOW o AS (PARTITION BY doc_id, sentence ORDER BY i)),
{name} AS (
  SELECT s.doc_id, s.sentence, CAST(sign(coalesce(sum(hit), 0)) AS INTEGER) AS polarity
  FROM {name}_s s LEFT JOIN {name}_h h ON s.doc_id = h.doc_id AND s.sentence = h.sentence GROUP BY ALL)"""


def _voted(name: str) -> str:
    return f"""{name}_v AS (
  SELECT doc_id, CASE WHEN p > 1 AND n > 1 AND p = n THEN 'pos' WHEN p >= 2 AND p > n THEN 'pos'
    WHEN n >= 2 AND n > p THEN 'neg' END AS label
  FROM (SELECT doc_id, count(*) FILTER (WHERE polarity = 1) AS p, count(*) FILTER (WHERE polarity = -1) AS n
    FROM {name} GROUP BY ALL))"""


# A title is one sentence: its delimiters are no word characters, so it can be scored unsplit.
_TITLE = _scored("titles", "title", "unused").replace("regexp_split_to_array(title, '" + _SPLIT + "')", "[title]").replace("unused", "head")


def _rules(table: str, column: str) -> str:
    return f"""rtok AS (
  SELECT doc_id, generate_subscripts(ws, 1) - 1 AS i, unnest(ws) AS w
  FROM (SELECT doc_id, list_reverse(regexp_extract_all({column}, '[\\p{{L}}]+')) AS ws FROM {table})),
rneg AS (
  SELECT doc_id, i, w, length(w) % 2 = 0 AS verb, w IN ({_lists(NEGATIVE)}) AS bad,
    w IN ({_lists(NEGATIVE + POSITIVE)}) AS charged,
    CASE WHEN (i - 1 > 0 AND lag(w, 1) OVER o IN ({_lists(NEGATORS)}))
           OR (i - 2 > 0 AND lag(w, 2) OVER o IN ({_lists(NEGATORS)}))
           OR coalesce(lead(w, 1) OVER o IN ({_lists(NEGATORS)}), false)
           OR coalesce(lead(w, 2) OVER o IN ({_lists(NEGATORS)}), false) THEN -1 ELSE 1 END AS flip
  FROM rtok WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
rplaced AS (SELECT *, first_value(flip) OVER (PARTITION BY doc_id, w ORDER BY i) AS at_first FROM rneg),
rcharged AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM rplaced WHERE charged),
ropen AS (SELECT * FROM rcharged WHERE k = 1),
rfired AS (
  SELECT c.doc_id, c.k, c.at_first, CASE
      WHEN o.verb AND NOT o.bad AND NOT c.verb AND c.bad THEN -2
      WHEN o.verb AND o.bad AND NOT c.verb AND c.bad THEN 1
      WHEN NOT o.verb AND o.bad AND NOT c.verb AND NOT c.bad THEN -1 END AS delta
  FROM rcharged c JOIN ropen o USING (doc_id) WHERE c.k > 1),
rclose AS (SELECT doc_id, arg_min(delta * at_first, k) AS delta FROM rfired WHERE delta IS NOT NULL GROUP BY ALL),
rscore AS (
  SELECT d.doc_id, CAST(coalesce(CASE WHEN o.bad THEN -1 ELSE 1 END * o.at_first, 0) + coalesce(c.delta, 0) AS INTEGER) AS score
  FROM {table} d LEFT JOIN ropen o USING (doc_id) LEFT JOIN rclose c USING (doc_id))"""


def _bayes(name: str, label: str, low: int, high: int) -> str:
    """Joint log scores of two classes by document: name_score(doc_id, s_low, s_high)."""
    def chi(k: str) -> str:
        off = f"(df_{k} - df * n_{k} / n)"
        return f"{off} * {off} / (df * n_{k} / n) + CASE WHEN df = n THEN 0 ELSE {off} * {off} / ((n - df) * n_{k} / n) END"

    return f"""{name}_train AS (SELECT doc_id, {label} AS label FROM documents JOIN labels USING (doc_id)),
{name}_size AS (SELECT count(*)::DOUBLE AS n, (count(*) FILTER (WHERE label = {low}))::DOUBLE AS n_low,
  (count(*) FILTER (WHERE label = {high}))::DOUBLE AS n_high FROM {name}_train),
{name}_word AS (SELECT w, count(*) AS df, count(*) FILTER (WHERE label = {low}) AS df_low, count(*) FILTER (WHERE label = {high}) AS df_high,
  sum(tf) FILTER (WHERE label = {low}) AS tf_low, sum(tf) FILTER (WHERE label = {high}) AS tf_high
  FROM nb_tf JOIN {name}_train USING (doc_id) GROUP BY w),
{name}_chosen AS (SELECT w, ln((n + 1) / (df + 1)) AS idf, coalesce(tf_low, 0) AS tf_low, coalesce(tf_high, 0) AS tf_high
  FROM {name}_word, {name}_size ORDER BY round({chi("low")} + {chi("high")}, 9) DESC, w LIMIT 1000),
{name}_total AS (SELECT sum(tf_low * idf) + count(*) AS t_low, sum(tf_high * idf) + count(*) AS t_high FROM {name}_chosen),
{name}_weight AS (SELECT w, idf * (ln(tf_low * idf + 1) - ln(t_low)) AS w_low, idf * (ln(tf_high * idf + 1) - ln(t_high)) AS w_high
  FROM {name}_chosen, {name}_total),
{name}_score AS (SELECT d.doc_id, ln((n_low + 1) / (n + 2)) + coalesce(sum(tf * w_low), 0) AS s_low,
  ln((n_high + 1) / (n + 2)) + coalesce(sum(tf * w_high), 0) AS s_high
  FROM documents d CROSS JOIN {name}_size LEFT JOIN (SELECT doc_id, tf, w_low, w_high FROM nb_tf JOIN {name}_weight USING (w)) x USING (doc_id)
  GROUP BY d.doc_id, n, n_low, n_high)"""


_NB_TF = """nb_tf AS MATERIALIZED (SELECT doc_id, w, count(*) AS tf
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[\\p{L}]+')) AS w FROM documents) GROUP BY ALL)"""


QUERIES = {
    "sentence_split": (sentence_split, f"""
SELECT doc_id, CAST(generate_subscripts(ss, 1) - 1 AS INTEGER) AS sentence, unnest(ss) AS text
FROM (SELECT doc_id, regexp_split_to_array(text, '{_SPLIT}') AS ss FROM documents)"""),
    "sentence_polarity": (sentence_polarity, f"""WITH {_scored("documents", "text", "sent")}
SELECT doc_id, CAST(sentence AS INTEGER) AS sentence, polarity FROM sent"""),
    "sentence_polarity_joined": (sentence_polarity_joined, f"""WITH {_scored("documents", "text", "sent")}
SELECT doc_id, CAST(sentence AS INTEGER) AS sentence, polarity FROM sent"""),
    "doc_sentiment": (doc_sentiment, f"""WITH {_scored("documents", "text", "sent")}, {_voted("sent")}
SELECT doc_id, label FROM sent_v"""),
    "lexicon_file_sentiment": (lexicon_file_sentiment, f"""WITH {_scored("documents", "text", "sent")}, {_voted("sent")}
SELECT doc_id, label FROM sent_v"""),
    "title_sentiment": (title_sentiment, f"""WITH {i.SQL_TITLES},
{_TITLE}, {_scored("titles", "content", "body")}, {_voted("body")},
titled AS (SELECT doc_id, CASE WHEN polarity > 0 THEN 'pos' WHEN polarity < 0 THEN 'neg' END AS title_label FROM head)
SELECT doc_id, coalesce(title_label, label) AS label, title_label FROM titled JOIN body_v USING (doc_id)"""),
    "pos_rule_score": (pos_rule_score, f"WITH {_rules('documents', 'text')} SELECT doc_id, score FROM rscore"),
    "pos_rule_sentiment": (pos_rule_sentiment, f"""WITH {i.SQL_TITLES},
{_rules("titles", "title")}, {_scored("titles", "content", "body")}, {_voted("body")}
SELECT doc_id, CASE WHEN score = 1 THEN 'pos' WHEN score <> 0 THEN 'neg' ELSE label END AS label
FROM rscore JOIN body_v USING (doc_id)"""),
    "nb_predict": (nb_predict, f"""WITH {_NB_TF}, {_bayes("q", "quality * 2 + 1", 1, 3)}
SELECT doc_id, CASE WHEN s_low >= s_high THEN 'neg' ELSE 'pos' END AS label_text FROM q_score"""),
    "nb_cascade": (nb_cascade, f"""WITH {_NB_TF}, {_bayes("a", "CASE WHEN toxic = 1 THEN 1 ELSE 4 END", 1, 4)},
{_bayes("b", "quality + 2", 2, 3)}
SELECT doc_id, CASE WHEN a.s_low >= a.s_high THEN 'neg' WHEN b.s_low >= b.s_high THEN 'neu' ELSE 'pos' END AS label_text
FROM a_score a JOIN b_score b USING (doc_id)"""),
    "nb_probability": (nb_probability, f"""WITH {_NB_TF}, {_bayes("q", "quality", 0, 1)},
p AS (SELECT doc_id, CAST(round(1 / (1 + exp(s_high - s_low)), 9) AS DECIMAL(20, 18)) AS p0,
  CAST(round(1 / (1 + exp(s_low - s_high)), 9) AS DECIMAL(20, 18)) AS p1 FROM q_score),
f AS (SELECT doc_id, floor(p0 * 10000) / 10000 AS a, floor(p1 * 10000) / 10000 AS b FROM p)
SELECT doc_id, printf('%.4f', CAST(CASE WHEN a >= b THEN a ELSE 1 - b END AS DOUBLE)) AS neg,
  printf('%.4f', CAST(CASE WHEN a >= b THEN 1 - a ELSE b END AS DOUBLE)) AS neu_pos FROM f"""),
}
