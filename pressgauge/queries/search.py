"""Escapes, search terms, baskets, term cosine."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.functions import periods
from pressgauge.functions import text as tx
from pressgauge.operators import similarity
from pressgauge.queries import inputs as i
from pressgauge.session import run_path
from pressgauge.sources import logs

STOP_WORDS = ["the", "of", "and", "la", "de", "der", "die"]
SUPPORT = 3


def url_decode(spark: SparkSession, d: str) -> DataFrame:
    """Documents url-encoded once, and twice, and decoded; a broken escape only tells once decoding starts.

    Text without any escape is left alone, so a plus from a space stays in it.
    """
    once = F.url_encode("text")
    return i.documents(spark, d, "text").select(
        "doc_id",
        tx.decode_escapes(once).alias("once"),
        tx.decode_escapes(F.url_encode(once)).alias("twice"),
        tx.decode_escapes(F.concat(once, F.lit("%zz"))).alias("broken"),
    )


def url_decode_units(spark: SparkSession, d: str) -> DataFrame:
    """Documents written as %uXXXX escapes throughout, turned into byte escapes and decoded."""
    escaped = F.regexp_replace(F.hex(F.encode("text", "UTF-16BE")), "(....)", "%u$1")
    docs = i.documents(spark, d, "text").select("doc_id", escaped.alias("e"))
    return docs.select(
        "doc_id", tx.unit_escapes_to_bytes(F.col("e")).alias("bytes"), tx.decode_escapes(F.col("e")).alias("text")
    )


def term_normalise(spark: SparkSession, d: str) -> DataFrame:
    """Every document's text cut at normalised delimiters; long words that are not Latin segmented."""
    raw = F.split(tx.normalise_delimiters(F.col("text")), ",")
    terms = F.flatten(F.transform(raw, lambda w: tx.segment_gate(w)))
    return i.documents(spark, d, "text").select(
        "doc_id", F.array_join(F.filter(terms, lambda t: t != ""), "|").alias("terms")
    )


def _baskets(spark: SparkSession, d: str) -> DataFrame:
    queries = logs.parse_search_log(i.search_lines(spark, d))
    return similarity.cap_baskets(similarity.search_terms(queries, STOP_WORDS))


def user_baskets(spark: SparkSession, d: str) -> DataFrame:
    baskets = similarity.user_baskets(_baskets(spark, d))
    return baskets.select("user_id", F.array_join("terms", "|").alias("terms"))


def basket_cap(spark: SparkSession, d: str) -> DataFrame:
    """A cap that some users exceed: they are left out whole, with their stop words counted."""
    queries = logs.parse_search_log(i.search_lines(spark, d))
    capped = similarity.cap_baskets(similarity.search_terms(queries, STOP_WORDS), max_distinct=400)
    return capped.groupBy("user_id").agg(F.count(F.lit(1)).alias("terms"))


def term_cosine(spark: SparkSession, d: str) -> DataFrame:
    pairs = similarity.term_cosine(_baskets(spark, d), SUPPORT)
    return pairs.withColumn("cosine", F.round("cosine", 6))


def term_cosine_close(spark: SparkSession, d: str) -> DataFrame:
    """Only close pairs."""
    pairs = similarity.term_cosine(_baskets(spark, d), SUPPORT, min_cosine=0.25)
    return pairs.withColumn("cosine", F.round("cosine", 6))


def term_cosine_day(spark: SparkSession, d: str) -> DataFrame:
    """The search log as hour folders of three days, a conversation in one hour; read are the 24 hours before one
    that are there."""
    root, now = run_path(spark, "search-log"), datetime(2024, 1, 3, 5)
    user = F.get(F.split("value", "\t"), F.lit(1)).cast("int")
    at = i.ts(i.START) + F.make_dt_interval(F.lit(0), user % 72)
    lines = i.search_lines(spark, d).withColumn("day", F.date_format(at, "yyyy-MM-dd")).withColumn("hour", F.hour(at))
    lines.write.partitionBy("day", "hour").text(root)
    folders = logs.present(spark, periods.past_hour_paths(root, now, folder="day={day}/hour={hour}"))
    queries = logs.parse_search_log(logs.read_lines(spark, folders))
    pairs = similarity.term_cosine(similarity.cap_baskets(similarity.search_terms(queries, STOP_WORDS)), SUPPORT)
    return pairs.withColumn("cosine", F.round("cosine", 6))


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_SEGMENTED = """CASE WHEN length(w) >= 6 AND NOT regexp_full_match(w, '[a-zA-Z.'' ]+')
      THEN regexp_extract_all(w, '[\\p{L}]+') ELSE [w] END"""


def _raw_words(table: str, key: str) -> str:
    return f"""SELECT {key}, unnest(string_split(regexp_replace(replace(text, ' ', ','), '[，。;；、]', ',', 'g'), ',')) AS w
  FROM {table}"""


_TERMS = f"""WITH raw AS ({_raw_words("conversations", "conv_id")}),
terms AS (SELECT DISTINCT CAST(conv_id AS VARCHAR) AS user_id, term FROM (
  SELECT conv_id, unnest({_SEGMENTED}) AS term FROM raw) WHERE term <> ''),
basket AS (SELECT user_id, term FROM terms WHERE term NOT IN ({_STOP})
  AND user_id IN (SELECT user_id FROM terms GROUP BY ALL HAVING count(*) <= CAP))"""

_BASKETS = _TERMS.replace("\n  AND user_id IN (SELECT user_id FROM terms GROUP BY ALL HAVING count(*) <= CAP)", "")
_COSINE = f"""counts AS (SELECT term, count(*) AS n FROM basket GROUP BY ALL HAVING count(*) >= {SUPPORT}),
kept AS (SELECT user_id, term, n FROM basket JOIN counts USING (term)),
pairs AS (SELECT a.term AS term_a, b.term AS term_b, count(*) AS together,
  count(*) / sqrt(CAST(a.n * b.n AS DOUBLE)) AS cosine
FROM kept a JOIN kept b ON a.user_id = b.user_id AND a.term < b.term GROUP BY a.term, b.term, a.n, b.n)"""

QUERIES = {
    "url_decode": (url_decode, """
SELECT doc_id, CASE WHEN regexp_matches(text, '[^A-Za-z0-9 .*_-]') THEN text ELSE replace(text, ' ', '+') END AS once,
  CASE WHEN regexp_matches(text, '[^A-Za-z0-9.*_-]')
    THEN CASE WHEN regexp_matches(text, '[^A-Za-z0-9 .*_-]') THEN text ELSE replace(text, ' ', '+') END
    ELSE text END AS twice,
  CASE WHEN NOT regexp_matches(text, '[^A-Za-z0-9 .*_-]') THEN replace(text, ' ', '+') || '%zz' END AS broken
FROM documents"""),
    "url_decode_units": (url_decode_units, """
SELECT doc_id, text, (SELECT string_agg(CASE WHEN cp < 65536 THEN
    '%' || printf('%02X', cp // 256) || '%' || printf('%02X', cp % 256) ELSE '' END, '' ORDER BY k)
  FROM (SELECT unicode(c) AS cp, k FROM (SELECT unnest(string_split(text, '')) AS c, generate_subscripts(string_split(text, ''), 1) AS k))) AS bytes
FROM documents"""),
    "term_normalise": (term_normalise, f"""WITH raw AS (
  SELECT doc_id, generate_subscripts(ws, 1) AS k, unnest(ws) AS w FROM (SELECT doc_id,
    string_split(regexp_replace(replace(text, ' ', ','), '[，。;；、]', ',', 'g'), ',') AS ws FROM documents)),
cut AS (SELECT doc_id, k, {_SEGMENTED} AS ts FROM raw),
terms AS (SELECT doc_id, k, generate_subscripts(ts, 1) AS j, unnest(ts) AS term FROM cut)
SELECT doc_id, coalesce(string_agg(term, '|' ORDER BY k, j) FILTER (WHERE term <> ''), '') AS terms
FROM documents LEFT JOIN terms USING (doc_id) GROUP BY ALL"""),
    "user_baskets": (user_baskets, f"""{_BASKETS}
SELECT user_id, string_agg(term, '|' ORDER BY term) AS terms FROM basket GROUP BY ALL"""),
    "basket_cap": (basket_cap, f"""{_TERMS.replace("CAP", "400")}
SELECT user_id, count(*) AS terms FROM basket GROUP BY ALL"""),
    "term_cosine": (term_cosine, f"""{_BASKETS}, {_COSINE}
SELECT term_a, term_b, together, round(cosine, 6) AS cosine FROM pairs"""),
    "term_cosine_close": (term_cosine_close, f"""{_BASKETS}, {_COSINE}
SELECT term_a, term_b, together, round(cosine, 6) AS cosine FROM pairs WHERE cosine >= 0.25"""),
    "term_cosine_day": (term_cosine_day, f"""{_BASKETS.replace("conversations", "(SELECT * FROM conversations WHERE conv_id % 72 BETWEEN 29 AND 52)")}, {_COSINE}
SELECT term_a, term_b, together, round(cosine, 6) AS cosine FROM pairs"""),
}
