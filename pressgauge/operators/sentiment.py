"""Lexicon sentiment of sentences, documents and titles.

A lexicon is a table ``polarity, word`` of any size with polarity Pos, Neg or Fou (negating). Tokens meet it in a
join, which Spark broadcasts when it measures the table as small; only lexicon words go on from there, so the shuffle
that brings a document's words together carries those and not its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pressgauge.functions.text import Tokeniser, sentences, words
from pressgauge.session import run_path


def flags(lexicon: DataFrame) -> DataFrame:
    """``word, pos, neg, fou``: one row per word of these kinds; the words of others would meet tokens for nothing.

    A table in the shared folder, so that its size is known: of a lexicon of unknown size Spark rather broadcasts or
    shuffles all tokens of the documents."""
    kinds = ("Pos", "Neg", "Fou")
    found = lexicon.where(F.col("polarity").isin(*kinds)).groupBy("word").agg(*[
        F.max((F.col("polarity") == p).cast("int")).alias(p.lower()) for p in kinds
    ])
    path = run_path(lexicon.sparkSession, "lexicon")
    found.write.parquet(path)
    return lexicon.sparkSession.read.parquet(path)


def _flip(sequence: list[str]) -> Column:
    """-1 where a negator stands one or two places before or after, else 1.

    The first token of a sequence never counts as a negator before a word."""
    near = W.partitionBy(*sequence).orderBy("i")
    before = F.max(F.when(F.col("i") > 0, F.col("fou")).otherwise(0)).over(near.rangeBetween(-2, -1))
    after = F.max("fou").over(near.rangeBetween(1, 2))
    return F.when(F.greatest(F.coalesce(before, F.lit(0)), F.coalesce(after, F.lit(0))) == 1, -1).otherwise(1)


def _polarities(tokens: DataFrame, lexicon: DataFrame, doc: str) -> DataFrame:
    """``doc, sentence, polarity`` of the sentences that hold a lexicon word, from ``doc, sentence, i, word``.

    Positive minus negative words, each flipped when negated; a word in both lists cancels out."""
    known = tokens.join(flags(lexicon), "word").drop("word").repartition(doc)
    hits = known.select(doc, "sentence", ((F.col("pos") - F.col("neg")) * _flip([doc, "sentence"])).alias("hit"))
    return hits.groupBy(doc, "sentence").agg(F.signum(F.sum("hit")).cast("int").alias("polarity"))


def _sentence_rows(docs: DataFrame, doc: str, text: str) -> DataFrame:
    # The outer form: for the plain one Spark adds a test for empty lists that splits the text again.
    rows = docs.select(doc, F.posexplode_outer(sentences(F.col(text))).alias("sentence", "_s"))
    return rows.where(F.col("_s").isNotNull())


def _tokens(rows: DataFrame, doc: str, sentence: Column, text: str, tokeniser: Tokeniser) -> DataFrame:
    return rows.select(doc, sentence.alias("sentence"), F.posexplode_outer(tokeniser(F.col(text))).alias("i", "word"))


def sentence_polarities(docs: DataFrame, lexicon: DataFrame, doc: str = "doc_id", text: str = "text",
                        tokeniser: Tokeniser = words) -> DataFrame:
    """``doc, sentence, polarity`` (1, -1 or 0) for every sentence of every document."""
    rows = _sentence_rows(docs, doc, text)
    found = _polarities(_tokens(rows, doc, F.col("sentence"), "_s", tokeniser), lexicon, doc)
    every = rows.select(doc, "sentence", F.lit(0).alias("polarity"))
    return found.unionByName(every).groupBy(doc, "sentence").agg(F.sum("polarity").cast("int").alias("polarity"))


def vote(positive: Column, negative: Column) -> Column:
    """Document label from its numbers of positive and negative sentences."""
    return (
        F.when((positive > 1) & (negative > 1) & (positive == negative), "pos")
        .when((positive >= 2) & (positive > negative), "pos")
        .when((negative >= 2) & (negative > positive), "neg")
    )


def document_sentiment(docs: DataFrame, lexicon: DataFrame, doc: str = "doc_id", text: str = "text",
                       tokeniser: Tokeniser = words) -> DataFrame:
    """``doc, label`` of every document: pos, neg or null by sentence vote."""
    rows = _sentence_rows(docs, doc, text)
    found = _polarities(_tokens(rows, doc, F.col("sentence"), "_s", tokeniser), lexicon, doc)
    counts = found.select(
        doc, (F.col("polarity") == 1).cast("int").alias("p"), (F.col("polarity") == -1).cast("int").alias("n"),
    ).groupBy(doc).agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    every = docs.select(doc, F.lit(0).alias("p"), F.lit(0).alias("n"))
    total = counts.unionByName(every).groupBy(doc).agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    return total.select(doc, vote(F.col("p"), F.col("n")).alias("label"))


def title_polarities(docs: DataFrame, lexicon: DataFrame, doc: str = "doc_id", title: str = "title",
                     tokeniser: Tokeniser = words) -> DataFrame:
    """``doc, polarity`` of every title, as one sentence."""
    found = _polarities(_tokens(docs, doc, F.lit(0), title, tokeniser), lexicon, doc).select(doc, "polarity")
    every = docs.select(doc, F.lit(0).alias("polarity"))
    return found.unionByName(every).groupBy(doc).agg(F.sum("polarity").cast("int").alias("polarity"))


def sign_label(score: Column) -> Column:
    return F.when(score > 0, "pos").when(score < 0, "neg")


def _title_first(titles: DataFrame, docs: DataFrame, lexicon: DataFrame, title_only: bool, doc: str, content: str,
                 tokeniser: Tokeniser) -> DataFrame:
    """The title's label where it has one, else the body's; null for good when ``title_only``."""
    if title_only:
        return titles.select(doc, F.col("title_label").alias("label"))
    bodies = document_sentiment(docs, lexicon, doc, content, tokeniser)
    return titles.join(bodies, doc).select(doc, F.coalesce("title_label", "label").alias("label"))


def title_sentiment(docs: DataFrame, lexicon: DataFrame, title_only: bool = False, doc: str = "doc_id",
                    title: str = "title", content: str = "content", tokeniser: Tokeniser = words) -> DataFrame:
    """``doc, label`` of (title, content) texts: the title's polarity decides when it is not zero."""
    titles = title_polarities(docs, lexicon, doc, title, tokeniser)
    titles = titles.select(doc, sign_label(F.col("polarity")).alias("title_label"))
    return _title_first(titles, docs, lexicon, title_only, doc, content, tokeniser)


def rule_scores(docs: DataFrame, lexicon: DataFrame, doc: str = "doc_id", tagged: str | Column = "tagged") -> DataFrame:
    """``doc, score`` of tagged tokens ``array<struct<word, tag>>`` by word order and word class.

    Read from the end, the first sentiment word gives 1 or -1. The next one that completes a rule with
    it adds: verb positive, then noun negative: -2; verb negative, then noun negative: 1; noun
    negative, then noun positive: -1. Either part is flipped when its word is negated. A word in both
    lists is negative; the place of a word is that of its first equal token in reading order.
    """
    tokens = docs.select(doc, F.posexplode_outer(F.reverse(tagged)).alias("i", "t")).select(doc, "i", "t.word", "t.tag")
    known = tokens.join(flags(lexicon), "word")
    # A negator marks two places on either side, the first token only those before it.
    own = F.array(F.struct("i", "word", "tag", (F.col("neg") == 1).alias("bad"), F.lit(False).alias("mark")))
    text, flag = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    marks = F.transform(
        F.when(F.col("i") > 0, F.array(F.lit(-2), F.lit(-1), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(-2), F.lit(-1))),
        lambda k: F.struct((F.col("i") + k).alias("i"), text.alias("word"), text.alias("tag"), flag.alias("bad"), F.lit(True).alias("mark")),
    )
    none = F.slice(own, 1, 0)
    rows = known.select(doc, F.inline(F.concat(
        F.when((F.col("pos") == 1) | (F.col("neg") == 1), own).otherwise(none), F.when(F.col("fou") == 1, marks).otherwise(none),
    )))
    # A row of its own keeps a document without such words; what follows is grouped within the document.
    alone = docs.select(doc, F.lit(None).cast("int").alias("i"), text.alias("word"), text.alias("tag"), flag.alias("bad"), F.lit(False).alias("mark"))
    placed = rows.unionByName(alone).repartition(doc).groupBy(doc, "i").agg(
        *(F.max(c).alias(c) for c in ("word", "tag", "bad", "mark")),
    ).where("word IS NOT NULL OR i IS NULL")
    equal = W.partitionBy(doc, "word", "tag").orderBy("i")
    # The first two of equal tokens: one may open, the other one complete a rule. Both flip as the first does.
    firsts = placed.withColumn("place", F.row_number().over(equal)).withColumn(
        "flip", F.first(F.when(F.col("mark"), -1).otherwise(1)).over(equal),
    ).where("place <= 2")
    verb, noun, bad = F.contains("tag", F.lit("v")), F.contains("tag", F.lit("n")), F.col("bad")
    entry = F.struct("i", "flip")
    # Few entries a document: the opening word, negative nouns (lexicon words, twice at most), the first positive noun.
    folded = firsts.groupBy(doc).agg(
        F.min(F.when(F.col("word").isNotNull(), F.struct("i", bad, verb.alias("verb"), noun.alias("noun"), "flip"))).alias("o"),
        F.array_sort(F.collect_list(F.when(noun & bad, entry))).alias("nouns_bad"),
        F.min(F.when(noun & ~bad, entry)).alias("noun_good"),
    )
    o = F.col("o")
    next_bad = F.get(F.filter("nouns_bad", lambda x: x["i"] > o["i"]), F.lit(0))

    def rule(when: Column, found: Column, delta: int) -> Column:
        return F.when(when & found.isNotNull(), F.struct(found["i"].alias("i"), (found["flip"] * delta).alias("delta")))

    added = F.array_min(F.array_compact(F.array(
        rule(o["verb"] & ~o["bad"], next_bad, -2), rule(o["verb"] & o["bad"], next_bad, 1),
        rule(o["noun"] & o["bad"], F.col("noun_good"), -1),
    )))
    score = F.when(o["bad"], -1).otherwise(1) * o["flip"] + F.coalesce(added["delta"], F.lit(0))
    return folded.select(doc, F.coalesce(score, F.lit(0)).cast("int").alias("score"))


def rule_sentiment(docs: DataFrame, rule_lexicon: DataFrame, body_lexicon: DataFrame, title_only: bool = False,
                   doc: str = "doc_id", tagged: str | Column = "tagged", content: str = "content",
                   tokeniser: Tokeniser = words) -> DataFrame:
    """``doc, label`` by the title's rule score: 1 is pos, any other non-zero is neg, zero asks the body."""
    score = F.col("score")
    titles = rule_scores(docs, rule_lexicon, doc, tagged).select(
        doc, F.when(score == 1, "pos").when(score != 0, "neg").alias("title_label"),
    )
    return _title_first(titles, docs, body_lexicon, title_only, doc, content, tokeniser)


def lexicon_from_word_lists(positive: DataFrame, negative: DataFrame, negators: DataFrame) -> DataFrame:
    """A lexicon table of three ``word`` tables, such as word-list files."""
    parts = [
        w.select(F.lit(p).alias("polarity"), "word") for p, w in (("Pos", positive), ("Neg", negative), ("Fou", negators))
    ]
    return parts[0].union(parts[1]).union(parts[2])
