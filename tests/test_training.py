import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pressgauge.operators import classify, training


def test_sets_are_balanced_and_whole(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 4000, "big").otherwise(F.concat(F.lit("c"), F.col("id") % 10)).alias("category")
    )
    sets = training.training_sets(docs, seed=1).cache()
    got = {r["target"]: r for r in training.training_summary(sets).collect()}
    assert got["big"]["positives"] == 4000 and got["big"]["negatives"] == 2000
    for c in (f"c{k}" for k in range(10)):
        assert got[c]["positives"] == got[c]["negatives"] == 200
    assert sets.groupBy("target", "doc_id").count().where("count > 1").count() == 0


@pytest.mark.parametrize("bins", [1, 7, 4096])
def test_sets_against_brute_force(spark, bins):
    """Negatives by sorting all others from the category's start on, whatever the bins; uneven points and ties too."""
    rng = random.Random(bins)
    docs = [(k, rng.choice("aaaaaabbcdefg")) for k in range(500)] + [(k, "a") for k in range(20)] + [(900, "lone"), (901, None)]
    df = spark.createDataFrame(docs, "doc_id int, category string")

    def unit(text):
        return int(hashlib.md5(text.encode()).hexdigest()[:12], 16) / 16**12

    known, expected = [x for x in docs if x[1]], []
    for target in {c for _, c in known}:
        own = sum(c == target for _, c in known)
        start = int(unit(f"{target}|start3") * bins)
        others = [(k, unit(f"{k}|doc3")) for k, c in known if c != target]
        others.sort(key=lambda x: (int(x[1] * bins) < start, x[1], x[0]))
        expected += [(target, k, 0) for k, _ in others[:own]] + [(target, k, 1) for k, c in known if c == target]
    got = [tuple(r) for r in training.training_sets(df, seed=3, bins=bins).collect()]
    assert sorted(got) == sorted(expected)


def test_single_category_has_no_negatives(spark):
    docs = spark.range(5).select(F.col("id").alias("doc_id"), F.lit("only").alias("category"))
    got = training.training_summary(training.training_sets(docs)).collect()
    assert [tuple(r) for r in got] == [("only", 5, 0)]


def test_classifier_learns_and_round_trips(spark, tmp_path):
    rows = [(["up", "gain", f"w{k % 5}"], 3) for k in range(40)] + [(["down", "loss", f"w{k % 5}"], 1) for k in range(40)]
    train = spark.createDataFrame(rows, "tokens array<string>, label int")
    model = classify.fit(train, selected=20)
    docs = spark.createDataFrame([(1, ["gain", "up"]), (2, ["loss"]), (3, []), (4, None)], "doc_id int, tokens array<string>")
    found = {r["doc_id"]: r["label_text"] for r in classify.predict(model, docs).collect()}
    assert found == {1: "pos", 2: "neg", 3: "neg", 4: "neg"}
    model.save(str(tmp_path / "model"))
    again = classify.NaiveBayes.load(spark, str(tmp_path / "model"))
    assert {r["doc_id"]: r["label_text"] for r in classify.predict(again, docs).collect()} == found


def test_cascade_asks_the_second_model_only_for_the_rest(spark):
    first = spark.createDataFrame([(["bad"], 1), (["ok"], 4), (["fine"], 4)] * 10, "tokens array<string>, label int")
    second = spark.createDataFrame([(["ok"], 2), (["fine"], 3), (["bad"], 3)] * 10, "tokens array<string>, label int")
    m1, m2 = classify.fit(first, selected=10), classify.fit(second, selected=10)
    docs = spark.createDataFrame([(1, ["bad"]), (2, ["ok"]), (3, ["fine"])], "doc_id int, tokens array<string>")
    assert {r["doc_id"]: r["label_text"] for r in classify.predict_cascade(m1, m2, docs).collect()} == {1: "neg", 2: "neu", 3: "pos"}


def test_many_distinct_counts_of_a_word(spark):
    """The selection looks at presence, so a word may have any number of different counts."""
    n = 10_100
    counted = spark.range(n).repartition(16).select(
        F.array_repeat(F.lit("often"), (F.col("id") + 1).cast("int")).alias("tokens"), F.lit(1).alias("label")
    )
    without = spark.range(300).select(F.array(F.lit("else")).alias("tokens"), F.lit(3).alias("label"))
    model = classify.fit(counted.union(without), selected=5)
    assert {r["word"] for r in model.words.collect()} == {"often", "else"}
    docs = spark.createDataFrame([(1, ["often"]), (2, ["else"])], "doc_id int, tokens array<string>")
    assert {r["doc_id"]: r["label_text"] for r in classify.predict(model, docs).collect()} == {1: "neg", 2: "pos"}
