"""Naive-Bayes text classification: word counts, IDF, chi-square selection, multinomial Bayes, all as aggregations.

The vocabulary is exact. Words are selected by the chi-square statistic of their *presence* against the class, which
has few distinct values whatever the counts; ties go by word. Training is two aggregations over the words (document
and term frequency by word and class); a model has at most ``selected`` rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.functions.metrics import class_label, two_class_scores
from pressgauge.session import ensure_checkpoint_dir

OTHER = 4
SMOOTHING = 1.0


@dataclass(frozen=True)
class NaiveBayes:
    """``words``: word, weights, the weight of one occurrence for each class; ``classes``: code and logarithm of the
    prior, in ascending order of the code."""

    words: DataFrame
    classes: list[tuple[float, float]]

    def save(self, path: str) -> None:
        codes = F.lit([c for c, _ in self.classes]), F.lit([p for _, p in self.classes])
        self.words.write.parquet(f"{path}/words")
        spark = self.words.sparkSession
        spark.range(1).select(codes[0].alias("codes"), codes[1].alias("priors")).write.parquet(f"{path}/classes")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "NaiveBayes":
        row = spark.read.parquet(f"{path}/classes").first()
        return cls(spark.read.parquet(f"{path}/words"), list(zip(row["codes"], row["priors"])))


def fit(train: DataFrame, label: str = "label", tokens: str = "tokens", selected: int = 1000) -> NaiveBayes:
    """A model of ``tokens`` and a class code ``label``. The driver sees one row for each class."""
    ensure_checkpoint_dir(train.sparkSession)
    sizes = {r[label]: r["n"] for r in train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    codes, total = sorted(sizes), sum(sizes.values())
    # Words of a document with their counts: both sums below come from one pass.
    numbered = train.select(label, tokens, F.monotonically_increasing_id().alias("_d"))
    counts = numbered.select("_d", label, F.explode(tokens).alias("word")).groupBy("_d", label, "word").agg(F.count(F.lit(1)).alias("tf"))

    def by_class(value: Column) -> Column:
        return F.array(*[F.coalesce(F.sum(F.when(F.col(label) == c, value)), F.lit(0)) for c in codes])

    words = counts.groupBy("word").agg(by_class(F.lit(1)).alias("df"), by_class(F.col("tf")).alias("tf"))
    df_all = F.aggregate("df", F.lit(0).cast("bigint"), lambda a, x: a + x)
    chi = F.lit(0.0)
    for k, c in enumerate(codes):
        expected = df_all * F.lit(sizes[c]) / F.lit(total)
        absent = (F.lit(total) - df_all) * F.lit(sizes[c]) / F.lit(total)
        off = F.col("df")[k] - expected
        chi = chi + off * off / expected + F.when(absent == 0, 0.0).otherwise(off * off / F.nullif(absent, F.lit(0.0)))
    chosen = (
        words.select("word", "tf", F.log((F.lit(total) + 1) / (df_all + 1)).alias("idf"), F.round(chi, 9).alias("chi"))
        .orderBy(F.desc("chi"), "word").limit(selected).select("word", "tf", "idf").checkpoint()
    )
    sums = chosen.agg(*[F.sum(F.col("tf")[k] * F.col("idf")).alias(f"s{k}") for k in range(len(codes))], F.count(F.lit(1)).alias("v")).first()
    weights = F.array(*[
        F.col("idf") * (
            F.log(F.col("tf")[k] * F.col("idf") + SMOOTHING) - F.log(F.lit((sums[f"s{k}"] or 0.0) + SMOOTHING * sums["v"]))
        )
        for k in range(len(codes))
    ])
    priors = [
        F.log((F.lit(float(sizes[c])) + SMOOTHING) / (F.lit(float(total)) + SMOOTHING * len(codes))) for c in codes
    ]
    row = train.sparkSession.range(1).select(*priors).first()
    return NaiveBayes(chosen.select("word", weights.alias("weights")), list(zip(codes, row)))


def scores(model: NaiveBayes, docs: DataFrame, doc: str, tokens: str = "tokens") -> DataFrame:
    """``doc, scores``: the logarithms of the classes' joint probabilities. A document is one row."""
    found = docs.select(doc, F.explode(tokens).alias("word")).join(model.words, "word")
    sums = [F.sum(F.col("weights")[k]).alias(f"s{k}") for k in range(len(model.classes))]
    parts = found.groupBy(doc).agg(*sums)
    prior = docs.select(doc, *[F.lit(p).alias(f"s{k}") for k, (_, p) in enumerate(model.classes)])
    total = parts.unionByName(prior).groupBy(doc).agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(len(model.classes))])
    return total.select(doc, F.array(*[f"s{k}" for k in range(len(model.classes))]).alias("scores"))


def _code(model: NaiveBayes) -> Column:
    """The class of the largest score, the smaller code when equal."""
    codes = F.array(*[F.lit(int(c)) for c, _ in model.classes])
    return F.element_at(codes, F.array_position("scores", F.array_max("scores")).cast("int"))


def predict(model: NaiveBayes, docs: DataFrame, doc: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """``doc, label_text``, the label of the predicted class code."""
    return scores(model, docs, doc, tokens).select(doc, class_label(_code(model)).alias("label_text"))


def predict_cascade(first: NaiveBayes, second: NaiveBayes, docs: DataFrame, doc: str = "doc_id",
                    tokens: str = "tokens") -> DataFrame:
    """``doc, label_text`` in two stages: the first tells neg from the rest (code 4), the second splits the rest."""
    one = scores(first, docs, doc, tokens).select(doc, _code(first).alias("p1"))
    two = scores(second, docs, doc, tokens).select(doc, _code(second).alias("p2"))
    code = F.when(F.col("p1") == OTHER, F.col("p2")).otherwise(F.col("p1"))
    return one.join(two, doc).select(doc, class_label(code).alias("label_text"))


def class_probabilities(model: NaiveBayes, docs: DataFrame, doc: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """``doc`` and the probabilities of the first two classes, ``neg`` and ``neu_pos``."""
    top = F.array_max("scores")
    total = F.aggregate("scores", F.lit(0.0), lambda a, s: a + F.exp(s - top))
    p = [F.round(F.exp(F.get("scores", F.lit(k)) - top) / total, 9) for k in (0, 1)]
    return scores(model, docs, doc, tokens).select(doc, two_class_scores(*p).alias("s")).select(doc, "s.neg", "s.neu_pos")
