import random

import pytest
from pyspark.sql import functions as F

from pressgauge.operators import sentiment

@pytest.fixture()
def lex(spark):
    rows = [("Pos", "good"), ("Pos", "both"), ("Neg", "bad"), ("Neg", "both"), ("Fou", "not")]
    return spark.createDataFrame(rows, "polarity string, word string")


def polarity(spark, lex, text):
    docs = spark.createDataFrame([(1, text)], "doc_id int, title string")
    return sentiment.title_polarities(docs, lex).first()["polarity"]


@pytest.mark.parametrize("text, expected", [
    ("good", 1), ("bad", -1), ("both", 0), ("", 0), ("plain words", 0),
    ("not good", 1), ("x not good", -1), ("x y not z good", -1), ("not x good", 1), ("x not x good", -1),
    ("good not", -1), ("good x not", -1), ("good x y not", 1), ("good bad good", 1), ("x x not bad", 1),
])
def test_sentence(spark, lex, text, expected):
    assert polarity(spark, lex, text) == expected


@pytest.mark.parametrize("text, expected", [
    ("good,good,bad,bad", "pos"), ("good", None), ("bad,bad", "neg"), ("good,good,bad", "pos"),
    ("good,bad", None), ("good,good", "pos"), ("bad,bad,good", "neg"), ("bad", None),
])
def test_vote(spark, lex, text, expected):
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    assert sentiment.document_sentiment(df, lex).first()["label"] == expected


def test_title_first(spark, lex):
    df = spark.createDataFrame([(1, "good", "bad,bad"), (2, "none", "bad,bad"), (3, "none", "x"), (4, None, None)],
                               "doc_id int, title string, content string")
    both = {r["doc_id"]: r["label"] for r in sentiment.title_sentiment(df, lex).collect()}
    only = {r["doc_id"]: r["label"] for r in sentiment.title_sentiment(df, lex, title_only=True).collect()}
    assert both == {1: "pos", 2: "neg", 3: None, 4: None}
    assert only == {1: "pos", 2: None, 3: None, 4: None}


RULE = [("Pos", "up"), ("Pos", "gain"), ("Neg", "risk"), ("Neg", "fall"), ("Fou", "not")]


@pytest.mark.parametrize("tagged, expected", [
    ([], 0),
    (["x/n"], 0),
    (["up/v"], 1),
    (["risk/n"], -1),
    # Read from the end: verb positive, then noun negative.
    (["risk/n", "up/v"], -1),
    (["risk/n", "fall/v"], 0),
    (["up/n", "risk/n"], -2),
    (["up/v", "risk/n"], -1),
    # Only one rule fires.
    (["risk/n", "risk/n", "x/n", "up/v"], -1),
    # A negator within two places of the first equal token flips; the very first token read does not count.
    (["up/v", "not/d"], -1 * -1),
    (["up/v", "not/d", "z/n"], -1),
    (["not/d", "up/v", "z/n"], -1),
])
def test_rule_score(spark, tagged, expected):
    tokens = [tuple(t.split("/")) for t in tagged]
    df = spark.createDataFrame([(1, tokens)], "doc_id int, tagged array<struct<word: string, tag: string>>")
    table = spark.createDataFrame(RULE, "polarity string, word string")
    assert sentiment.rule_scores(df, table).first()["score"] == expected


def brute_polarity(text):
    total = 0
    tokens = text.split()
    for k, w in enumerate(tokens):
        value = (w in ("good", "both")) - (w in ("bad", "both"))
        near = [j for j in (k - 2, k - 1) if j > 0] + [k + 1, k + 2]
        total += -value if any(j < len(tokens) and tokens[j] == "not" for j in near) else value
    return (total > 0) - (total < 0)


def test_sentences_equal_brute_force(spark, lex):
    rng = random.Random(5)
    texts = [(k, ",".join(" ".join(rng.choices(["good", "bad", "both", "not", "x"], k=rng.randint(0, 7)))
                          for _ in range(rng.randint(1, 4)))) for k in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = sorted(map(tuple, sentiment.sentence_polarities(docs, lex).collect()))
    assert got == sorted((k, n, brute_polarity(s)) for k, t in texts for n, s in enumerate(t.split(",")))


def test_only_lexicon_words_are_shuffled(spark, lex):
    docs = spark.createDataFrame([(1, "good day")], "doc_id int, text string")
    plan = sentiment.document_sentiment(docs, lex)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "SortMergeJoin" in plan
    assert plan.index("REPARTITION_BY_COL") < plan.index("Join")


def brute_rule(tagged):
    """Over all tokens from the end, without any aggregate."""
    tokens = tagged[::-1]
    good, bad, no = ({w for p, w in RULE if p == x} for x in ("Pos", "Neg", "Fou"))

    def flip(j):
        j = tokens.index(tokens[j])
        near = [k for k in (j - 2, j - 1) if k > 0] + [k for k in (j + 1, j + 2) if k < len(tokens)]
        return -1 if any(tokens[k][0] in no for k in near) else 1

    opening = None
    for j, (word, tag) in enumerate(tokens):
        if word not in good | bad:
            continue
        if opening is None:
            opening, score = (word in bad, tag), (-1 if word in bad else 1) * flip(j)
            continue
        was_bad, was = opening
        if "n" in tag and word in bad and "v" in was:
            return score + (1 if was_bad else -2) * flip(j)
        if "n" in tag and word not in bad and "n" in was and was_bad:
            return score - flip(j)
    return score if opening else 0


def test_rule_scores_equal_brute_force(spark):
    rng = random.Random(9)
    words, tags = ["up", "gain", "risk", "fall", "not", "x", "y"], ["v", "n", "vn", "a"]
    docs = [(k, [(rng.choice(words), rng.choice(tags)) for _ in range(rng.randint(0, 14))]) for k in range(400)]
    df = spark.createDataFrame(docs, "doc_id int, tagged array<struct<word: string, tag: string>>")
    scores = sentiment.rule_scores(df, spark.createDataFrame(RULE, "polarity string, word string"))
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(doc_id") == 1
    assert {r["doc_id"]: r["score"] for r in scores.collect()} == {k: brute_rule(t) for k, t in docs}


def test_words_of_other_kinds_meet_no_tokens(spark, rows):
    lexicon = spark.createDataFrame(
        [("Pos", "good"), ("Other", "good"), ("Other", "plain"), (None, "void"), ("Fou", "not")], "polarity string, word string",
    )
    assert rows(sentiment.flags(lexicon), "word", "pos", "neg", "fou") == {("good", 1, 0, 0), ("not", 0, 0, 1)}
    docs = spark.createDataFrame([(1, "plain good,very not good,plain void")], "doc_id int, text string")
    assert rows(sentiment.sentence_polarities(docs, lexicon), "doc_id", "sentence", "polarity") == {(1, 0, 1), (1, 1, -1), (1, 2, 0)}


def test_tokens_are_neither_broadcast_nor_shuffled_to_a_small_lexicon(spark):
    docs = spark.createDataFrame([(1, "good not bad")], "doc_id int, text string")
    lexicon = spark.createDataFrame([("Pos", "good"), ("Neg", "bad"), ("Fou", "not")], "polarity string, word string")
    tagged = F.transform(F.split("text", " "), lambda w: F.struct(w.alias("word"), F.lit("n").alias("tag")))
    for df in (sentiment.rule_scores(docs, lexicon, tagged=tagged), sentiment.sentence_polarities(docs, lexicon)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "BuildRight" in plan and "SortMergeJoin" not in plan
        assert "hashpartitioning(word" not in plan
        assert df.count() >= 1
