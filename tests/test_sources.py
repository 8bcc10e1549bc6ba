import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pressgauge.functions import periods
from pressgauge.operators import records
from pressgauge.sources import jdbc, keyed, logs, rankings, tables


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_visit_lines(spark, rows):
    df = lines(
        spark, "2024-01-01-05,u\t3", "2024-01-01-05,u\t4", "x,a,u\t3", "x,u 3", "x,u\tmany", "x,u\t3\t4", "", "x",
        "x,u\t3\t", "x,w\t3,",
    )
    assert rows(logs.sum_visits(logs.parse_visit_log(df)), "url", "cnt") == {("u", 10), ("w", 3)}
    assert rows(logs.parse_day_visits(df), "hour", "cnt") == {(datetime(2024, 1, 1, 5), 3), (datetime(2024, 1, 1, 5), 4)}


def test_search_lines(spark, rows):
    df = lines(
        spark, "a\tu1\tc\td\te\tf\tg\t%E9%93%BE", "a\tu2\tc\td\te\tf\tg\tNoDef", "a\tu3\tc\td\te\tf\tg",
        "a\tu4\tc\td\te\tf\tg\t", "a\tu5\tc\td\te\tf\tg\t%41%zz", "a\tu6\tc\td\te\tf\tg\th\t",
    )
    assert rows(logs.parse_search_log(df), "user_id", "query") == {("u1", "链"), ("u6", "h")}


def test_hour_files_are_keyed_by_name(spark, tmp_path, rows):
    ms = 1704067200000
    for k, body in ((0, "x,u\t1\ny,u\t2\n"), (1, "x,w\t5\n")):
        (tmp_path / str(ms + k * 3600_000)).write_text(body)
    (tmp_path / "notes").write_text("x,u\t100\n")
    got = logs.sum_visits(logs.parse_hour_visits(logs.read_lines(spark, str(tmp_path))), "hour")
    assert rows(got, "hour", "url", "cnt") == {(datetime(2024, 1, 1, 0), "u", 3), (datetime(2024, 1, 1, 1), "w", 5)}


def test_many_folders_in_one_scan(spark, tmp_path):
    paths = periods.past_hour_paths(str(tmp_path), datetime(2024, 1, 2, 1, 30), 3)
    assert [p.rsplit("/", 2)[1:] for p in paths] == [["2024-01-02", "0"], ["2024-01-01", "23"], ["2024-01-01", "22"]]
    for p in paths:
        (tmp_path / p).mkdir(parents=True)
        (tmp_path / p / "part").write_text("one\n")
    assert logs.read_lines(spark, paths).count() == 3


def test_dictionaries(spark, rows):
    assert rows(logs.parse_entity_dictionary(lines(spark, "\ufeffstock\tA", "broken")), "category", "name") == {("stock", "A")}
    assert rows(logs.parse_word_list(lines(spark, "\ufeff好", " ", "坏 ")), "word") == {("好",), ("坏",)}
    assert rows(logs.parse_tagged_word_list(lines(spark, "涨/v", "x")), "word", "tag") == {("涨", "v")}


def test_tuple_text_round_trip(spark, rows):
    df = spark.createDataFrame([("A", 1.5)], "entity string, value double")
    text = logs.format_tuple_text(df)
    assert text.first()["value"] == "(A,1.5)"
    assert rows(logs.parse_tuple_text(text), "entity", "value") == {("A", 1.5)}


def test_labelled_corpus(spark, tmp_path, rows):
    (tmp_path / "银行").write_text("a b\nc\n")
    assert rows(logs.read_labelled_corpus(spark, str(tmp_path)), "category", "text") == {("银行", "a b"), ("银行", "c")}


def test_jdbc_options():
    src = jdbc.JdbcTable("jdbc:x://h/db", "news_info", {"user": "u"})
    opts = jdbc.scan_options(src, column="news_time", lower=5, upper=9, partitions=8, columns=["id"], predicate="type = 0")
    assert opts == {
        "user": "u", "url": "jdbc:x://h/db", "dbtable": "(SELECT id FROM news_info WHERE type = 0) src",
        "partitionColumn": "news_time", "lowerBound": "5", "upperBound": "9", "numPartitions": "8",
    }
    assert "partitionColumn" not in jdbc.scan_options(src)
    with pytest.raises(ValueError):
        jdbc.scan_options(src, column="news_time")


def test_keyed_update_changes_only_present_keys(spark, rows):
    current = spark.createDataFrame([("a", "old", "o"), ("b", "old", "o")], "k string, x string, y string")
    changes = spark.createDataFrame([("a", None), ("z", "new")], "k string, x string")
    assert rows(tables.keyed_update(current, changes, ["k"]), "k", "x", "y") == {("a", None, "o"), ("b", "old", "o")}


def test_keyed_table_rewrites_touched_buckets_only(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "t"), "k string, n long, x string"
    want = {(f"k{j}", j, "old") for j in range(200)} | {(None, 7, "old")}
    keyed.create(spark.createDataFrame(sorted(want, key=str), schema), path, ["k", "n"], 16)

    def files():
        at = json.loads(max((tmp_path / "t" / "commits").glob("0*")).read_text())["at"]
        return {f.relative_to(tmp_path) for b, w in at.items() for f in (tmp_path / "t" / "data").glob(f"pg_write={w}/pg_bucket={b}/*.parquet")}

    def table():
        return {tuple(r) for r in keyed.read(spark, path).collect()}

    before = files()
    assert table() == want and len(before) >= 16
    # Nulls replace values, unknown and null keys are not inserted; types are the table's.
    changes = spark.createDataFrame([("k3", 3, None), ("k9", 9, "new"), ("z", 1, "new"), ("k3", 4, "new"), (None, 7, "new")], "k string, n int, x string")
    assert 1 <= keyed.update(spark, path, changes.withColumn("n", F.col("n").cast("long"))) <= 5
    want = {(k, n, None if k == "k3" else "new" if k == "k9" else x) for k, n, x in want}
    assert table() == want and len(before & files()) >= len(before) - 5
    assert keyed.update(spark, path, changes.where("false")) == 0
    # A failed update leaves the table; of two writers the later one builds on the other.
    held = keyed.read(spark, path)
    with monkeypatch.context() as m:
        m.setattr(tables, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            keyed.update(spark, path, spark.createDataFrame([("k5", 5, "lost")], schema))
    assert table() == want
    publish, met = tables.publish, []

    def meets(*args):
        if not met:
            met.append(1)
            keyed.update(spark, path, spark.createDataFrame([("k5", 5, "first")], schema))
        return publish(*args)

    monkeypatch.setattr(tables, "publish", meets)
    keyed.update(spark, path, spark.createDataFrame([("k5", 5, "second"), ("k6", 6, "second")], schema))
    monkeypatch.setattr(tables, "publish", publish)
    want = {(k, n, "second" if k in ("k5", "k6") else x) for k, n, x in want}
    assert table() == want
    # Old buckets go after some commits, and readers before that are not disturbed.
    assert {tuple(r) for r in held.collect()} != want
    for j in range(keyed.RETAIN + 1):
        keyed.update(spark, path, spark.createDataFrame([("k5", 5, str(j))], schema))
    buckets = [f for f in (tmp_path / "t" / "data").glob("*/pg_bucket=*")]
    assert len(buckets) <= 16 + keyed.RETAIN + 2 and not list((tmp_path / "t" / "staged").glob("*"))
    keyed.create(spark.createDataFrame([], schema), str(tmp_path / "none"), ["k"])
    assert keyed.read(spark, str(tmp_path / "none")).count() == 0 and keyed.update(spark, str(tmp_path / "none"), changes) == 0


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_rankings_are_sorted_folders(spark, tmp_path, kind):
    # One hour has nine tenths of the rows; values tie, and there are null values and groups.
    data = [("h1" if j % 10 else f"h{j % 30}", f"s{j:04d}", None if j % 50 == 3 else j * 7 % 40) for j in range(2000)]
    data += [(None, "a", 1), (None, "b", 5), ("h1", "s0001", 7)]
    rows = spark.createDataFrame(data, "hour string, stock string, visit long")
    path = str(tmp_path / kind)
    rankings.write_ranking(rows.repartition(5), path, "hour", "visit", "stock", kind)
    groups = {}
    for h, s, v in data:
        groups.setdefault(h, []).append((s, v))
    seen = {}
    for folder in (tmp_path / kind).glob("hour=*"):
        key = folder.name.removeprefix("hour=")
        key = None if key.startswith("__HIVE") else key
        files = sorted(folder.glob("part-*"))
        schema = "place long, stock string, visit long"
        seen[key] = [tuple(r) for f in files for r in spark.read.schema(schema).format(kind).load(str(f)).coalesce(1).collect()]
        assert key != "h1" or len(files) > 3
    assert seen == {
        h: [(k + 1, s, v) for k, (s, v) in enumerate(sorted(own, key=lambda r: (r[1] is None, -(r[1] or 0), r[0])))] for h, own in groups.items()
    }
    rankings.write_ranking(rows.limit(0), str(tmp_path / "none"), "hour", "visit", "stock")


def test_replace_reads_its_own_table(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    tables.replace(spark.createDataFrame([(1,)], "x int"), path)
    for _ in range(2):
        tables.replace(tables.read_current(spark, path).selectExpr("x + 1 AS x"), path)
    assert rows(tables.read_current(spark, path), "x") == {(3,)}
    (tmp_path / "t" / "v=9").mkdir()
    assert rows(tables.read_current(spark, path), "x") == {(3,)}


def test_upsert_writes_versions(spark, tmp_path, rows):
    path = str(tmp_path / "m")
    one = spark.createDataFrame([("2024-01-01", "A", 1), ("2024-01-02", "A", 2)], "p string, e string, v int")
    two = spark.createDataFrame([("2024-01-02", "A", 5), ("2024-01-02", "B", 6), ("2024-01-02", "B", 3)], "p string, e string, v int")
    assert tables.read_metric_table(spark, path).count() == 0
    tables.upsert_metrics(spark, path, tables.metric_rows(one, "visit", "p", "e", "v"))
    for _ in range(2):
        tables.upsert_metrics(spark, path, tables.metric_rows(two, "visit", "p", "e", "v"))
    expected = {("2024-01-01", "A", 1.0), ("2024-01-02", "A", 5.0), ("2024-01-02", "B", 6.0)}
    # A part that was never committed is not seen.
    lost = tmp_path / "m" / "data" / "level=0" / "v=4" / "attempt=x" / "metric=visit" / "period=2024-01-02"
    lost.mkdir(parents=True)
    assert rows(tables.read_metric_table(spark, path), "period", "entity", "value") == expected
    plan = tables.read_period(spark, path, "visit", "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(metric" in plan
    tables.compact_metrics(spark, path)
    assert rows(tables.read_metric_table(spark, path), "period", "entity", "value") == expected
    assert not lost.exists() and len(list((tmp_path / "m" / "data").glob("*/*/*"))) == 1
    tables.upsert_metrics(spark, path, tables.metric_rows(one.limit(1), "visit", "p", "e", "v").withColumn("value", F.lit(9.0)))
    assert ("2024-01-01", "A", 9.0) in rows(tables.read_metric_table(spark, path), "period", "entity", "value")


def _upsert(spark, path, values, *batch):
    df = spark.createDataFrame([("2024-01-01", k, float(v)) for k, v in values.items()], "p string, e string, v double").coalesce(1)
    return tables.upsert_metrics(spark, path, tables.metric_rows(df, "visit", "p", "e", "v"), *batch)


def test_many_upserts_leave_few_parts(spark, tmp_path, monkeypatch):
    """Every write changes some keys; parts are merged in levels, each key's newest value stays."""
    monkeypatch.setattr(tables, "FANOUT", 3)
    monkeypatch.setattr(tables, "RETAIN", 2)
    path, expected = str(tmp_path / "m"), {}
    for k in range(40):
        own = {f"e{k % 7}": k, f"e{k % 5}": k + 0.5, "all": -k}
        expected |= own
        assert _upsert(spark, path, own, "s", k)
        parts = tables._table_state(spark, path)[1]["parts"]
        assert len(parts) <= 2 * (max(p["level"] for p in parts) + 1) and max(p["level"] for p in parts) <= 3
    got = {r["entity"]: r["value"] for r in tables.read_metric_table(spark, path).collect()}
    assert got == expected
    folders, commits = list((tmp_path / "m" / "data").glob("*/*/*")), list((tmp_path / "m" / "commits").glob("0*"))
    assert len(folders) <= len(parts) + 9 and len(commits) <= 3


def test_batches_are_written_once(spark, tmp_path):
    path = str(tmp_path / "m")
    assert _upsert(spark, path, {"a": 1}, "s", 0) and _upsert(spark, path, {"a": 2}, "s", 1)
    assert not _upsert(spark, path, {"a": 9}, "s", 1) and not _upsert(spark, path, {"a": 9}, "s", 0)
    assert _upsert(spark, path, {"b": 5}, "other", 0) and _upsert(spark, path, {"c": 6})
    assert len(tables._table_state(spark, path)[1]["parts"]) == 4
    assert {(r["entity"], r["value"]) for r in tables.read_metric_table(spark, path).collect()} == {("a", 2.0), ("b", 5.0), ("c", 6.0)}


def test_crash_between_data_and_commit(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    _upsert(spark, path, {"a": 1}, "s", 0)

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(tables, "_commit", fail)
    with pytest.raises(RuntimeError):
        _upsert(spark, path, {"a": 2}, "s", 1)
    monkeypatch.undo()
    assert {r["value"] for r in tables.read_metric_table(spark, path).collect()} == {1.0}
    assert _upsert(spark, path, {"a": 2}, "s", 1)
    assert {r["value"] for r in tables.read_metric_table(spark, path).collect()} == {2.0}


def test_two_writers_meet(spark, tmp_path, monkeypatch):
    """The other writer commits between this one's data and its commit."""
    path, plain, met = str(tmp_path / "m"), tables._commit, []

    def late(*args):
        if not met:
            met.append(1)
            _upsert(spark, path, {"a": 7, "b": 7})
        return plain(*args)

    monkeypatch.setattr(tables, "_commit", late)
    _upsert(spark, path, {"a": 1})
    assert {(r["entity"], r["value"]) for r in tables.read_metric_table(spark, path).collect()} == {("a", 1.0), ("b", 7.0)}


def test_export_text(spark, tmp_path):
    tables.export_text(lines(spark, "a", "b"), str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("part-*"))) == 1


def test_look_back_is_open(spark, rows):
    t = datetime(2024, 1, 2)
    df = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 1, 0, 0, 1)), (3, t), (4, datetime(2024, 1, 3))],
                               "id int, t timestamp")
    assert rows(records.look_back(df, "t", F.lit(t), 24), "id") == {(2,)}
    assert rows(records.look_back(df, "t", F.lit(t), 24, bounded=False), "id") == {(2,), (3,), (4,)}
    assert rows(records.events_since(df, F.lit(datetime(2024, 1, 4)), 2, "t"), "id") == {(3,), (4,)}


def test_validity_is_null_safe(spark, rows):
    ev = spark.createDataFrame([(1, 1, [1]), (2, 0, [1]), (3, 1, []), (4, 1, None)], "id int, is_valid int, related_news array<long>")
    assert rows(records.valid_events(ev), "id") == {(1,)}
    nw = spark.createDataFrame([(1, ["a"], None, None), (2, [], None, [])],
                               "id int, industry array<string>, section array<string>, stock array<string>")
    assert rows(records.tagged_news(nw), "id") == {(1,)}


def test_category_dictionary(spark, rows):
    board = spark.createDataFrame([("600000", "1105", "IT"), ("600000", "1109", "银行"), ("600001", "9", "x")],
                                  "symbol string, boardcode string, keyname string")
    assert rows(records.category_dictionary(board), "category", "name") == {
        ("stock", "600000"), ("stock", "600001"), ("section", "IT"), ("industry", "银行")
    }


def test_period_functions(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 1, 5, 6, 7),)], "t timestamp")
    t = F.col("t")
    r = df.select(
        periods.period_key(t, periods.HOUR_KEY).alias("h"), periods.day_series(t, 2, 7).alias("s"),
        periods.hours_of_day(t).alias("hs"), periods.previous_day(t).alias("d"),
        periods.parse_period_key(F.lit("nonsense")).alias("bad"),
        periods.half_open_hours(F.date_trunc("hour", t), F.date_trunc("hour", t) + F.expr("INTERVAL 2 HOURS")).alias("ho"),
    ).first()
    assert r["h"] == "2024030105" and [str(x) for x in r["s"]] == ["2024-03-01", "2024-03-08", "2024-03-15"]
    assert len(r["hs"]) == 24 and str(r["d"]) == "2024-02-29" and r["bad"] is None and len(r["ho"]) == 2
