import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pressgauge.functions import metrics, text


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "s string").select(fn(F.col("s")).alias("r")).first()["r"]


# Escapes with known results.
@pytest.mark.parametrize("given_text, expected", [
    ("%u94fe%ufefe", "%94%fe%fe%fe"), ("%u94fe%u94fe", "%94%fe%94%fe"), ("ab%u94fetail", "ab"),
    ("%41%u94fe", "A%94%fe"), ("%zz", None), ("plain", "plain"),
])
def test_unit_escapes(spark, given_text, expected):
    assert one(spark, given_text, text.unit_escapes_to_bytes) == expected


# Escapes with known results.
@pytest.mark.parametrize("given_text, expected", [
    ("%u94fe%u94fe", "链链"), ("%E9%93%BE", "链"), ("%25E9%2593%25BE", "链"), ("%252541", "A"),
    ("%25252525252541", "A"), ("100% sure", "100% sure"), ("a+b", "a+b"), ("a+b%21", "a b!"),
    ("%41%zz", None), ("%ud83d%ude00", "😀"), ("%ud83d%u0041", "\ufffdA"), ("abc%u94fe tail", "abc"),
    ("%ufeff%u0041", "A"),
])
def test_decode(spark, given_text, expected):
    assert one(spark, given_text, text.decode_escapes) == expected


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="%+\x00"), max_size=30), min_size=1, max_size=20))
def test_encode_decode_round_trip(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    encoded = F.regexp_replace(F.url_encode("s"), "\\+", "%20")
    units = F.regexp_replace(F.hex(F.encode("s", "UTF-16BE")), "(....)", "%u$1")
    got = df.select("s", text.decode_escapes(encoded).alias("a"), text.decode_escapes(units).alias("b")).collect()
    for r in got:
        assert r["a"] == r["s"]
        # A leading byte-order mark is read as such.
        assert r["b"] == (r["s"][1:] if r["s"][:1] in ("\ufeff",) else r["s"]) or r["s"][:1] == "\ufffe"


def test_delimiters_and_gate(spark):
    assert one(spark, "a b，c。d;e；f、g", text.normalise_delimiters) == "a,b,c,d,e,f,g"
    assert one(spark, "short", text.segment_gate) == ["short"]
    assert one(spark, "Latin Word's.", text.segment_gate) == ["Latin Word's."]
    assert one(spark, "abc-def", text.segment_gate) == ["abc", "def"]


def test_stop_words_keep_order_and_repeats(spark):
    got = one(spark, "b a c b", lambda c: text.remove_stop_words(F.split(c, " "), ["a"]))
    assert got == ["b", "c", "b"]


def test_clean_document(spark):
    words = lambda c: F.split(c, " ")
    got = one(spark, "  股票 600000 12345 abc 始##始 的 上涨 x股 ", lambda c: text.clean_document(c, ["的"], words))
    assert got == "股票/600000/上涨"


def test_sentences(spark):
    assert one(spark, "a,b。c\td\ne，f：g.h", text.sentences) == ["a", "b", "c", "d", "e", "f", "g.h"]


def test_strip_bom(spark):
    assert one(spark, "\ufeff词", text.strip_bom) == "词"


@pytest.mark.parametrize("p0, p1, expected", [
    (0.99999, 0.00001, ("0.9999", "0.0001")), (0.3, 0.7, ("0.3000", "0.7000")),
    (0.12349, 0.87651, ("0.1235", "0.8765")), (0.5, 0.5, ("0.5000", "0.5000")),
])
def test_two_class_scores(spark, p0, p1, expected):
    df = spark.createDataFrame([(p0, p1)], "a double, b double")
    got = df.select(metrics.two_class_scores(F.col("a"), F.col("b")).alias("r")).first()["r"]
    assert (got["neg"], got["neu_pos"]) == expected


def test_class_labels(spark):
    df = spark.range(1, 5).select(metrics.class_label(F.col("id")).alias("l"))
    assert [r["l"] for r in df.collect()] == ["neg", "neu", "pos", "neu_pos"]
    with pytest.raises(Exception, match="unknown class code"):
        spark.range(5, 6).select(metrics.class_label(F.col("id")).alias("l")).collect()


def test_unit_escapes_in_one_pass_agree_with_pieces(spark):
    """A text of five-character pieces is rewritten whole; what stands around it must not matter."""
    texts = ["", "a", "%u4e2d%u6587", "x%u4e2d", "%12345%abcde", "%\nabcd%u00e9", "%u4e2d%41", "%u4e2dz%u6587", "%", None, "%😀1234", "%u4e2d" * 20000]

    def plain(t):
        if t is None:
            return None
        head, *rest = t.split("%")
        return head + "".join(f"%{p[1:3]}%{p[3:]}" if len(p) == 5 else chr(int(p, 16)) if len(p) == 2 else "" for p in rest)

    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = dict(df.select("k", text.unit_escapes_to_bytes(F.col("t"))).collect())
    assert [got[k] for k in range(len(texts))] == [plain(t) for t in texts]


def test_runs_are_found_once(spark):
    plan = spark.range(1).select(text.decode_utf16_escapes(F.col("id").cast("string")).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract_all") == 1


@pytest.mark.parametrize("run", [
    "%00%DF%00%41", "%D8%3D%DE%00", "%d8%3d%00%df", "%FE%FF%00%DF", "%FF%FE%DF%00%3D%D8%00%DE", "%FF%FE%41%D8", "%00%41%DC%00", "%00%d8" * 30000 + "%D8%00",
])
def test_surrogates_are_looked_for_in_whole_units(spark, run):
    data = bytes.fromhex(run.replace("%", ""))
    assert one(spark, run, text.decode_utf16_escapes) == data.decode("utf-16" if data[:2] in (b"\xff\xfe", b"\xfe\xff") else "utf-16-be", "replace")
