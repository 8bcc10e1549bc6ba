from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from pressgauge.operators import events as ev
from pressgauge.sources import logs


def at(ms):
    return datetime.fromtimestamp(ms / 1000, timezone.utc).replace(tzinfo=None)


# The event, news and visit inputs of these fixtures have known results.
@pytest.fixture()
def events(spark):
    return spark.createDataFrame(
        [(1, "油价暴涨", [1, 2, 3]), (2, "a-b,c", [9]), (3, "twice", [1, 1])],
        "event_id long, event_name string, related_news array<long>",
    )


@pytest.fixture()
def news(spark):
    return spark.createDataFrame(
        [(1, "10", "url1", at(1476720000000))],
        "news_id long, platform string, url string, news_time timestamp",
    )


@pytest.fixture()
def visits(spark):
    lines = spark.createDataFrame([("1,url1\t10",), ("2,url1\t5",)], "value string")
    return logs.parse_visit_log(lines)


def test_unknown_news_get_placeholders(events, news, rows):
    got = ev.expand_events(events.where("event_id = 1"), news)
    assert rows(got, "news_id", "platform", "url") == {(1, "10", "url1"), (2, "no", "no"), (3, "no", "no")}


def test_exposure_window_is_half_open(events, news, rows):
    inside = ev.exposure(events, news, F.lit(at(1476720000001)), 1)
    assert rows(inside, "event_id", "exposure", "platforms") == {(1, 1, "10"), (2, 0, ""), (3, 2, "10")}
    start = ev.exposure(events, news, F.lit(at(1476720000000 + 3600_000)), 1)
    assert rows(start, "event_id", "exposure", "platforms") == {(1, 1, "10"), (2, 0, ""), (3, 2, "10")}
    end = ev.exposure(events, news, F.lit(at(1476720000000)), 1)
    assert rows(end, "event_id", "exposure") == {(1, 0), (2, 0), (3, 0)}


def test_visits_and_metrics(events, news, visits, rows):
    assert rows(ev.visit(events, news, visits), "event_id", "visit") == {(1, 15), (2, 0), (3, 30)}
    got = ev.metrics(events, news, visits, F.lit(at(1476723600000)), 1)
    assert rows(got, "event_name", "exposure", "platforms", "visit") == {
        ("油价暴涨", 1, "10", 15), ("a-b,c", 0, "", 0), ("twice", 2, "10", 30)
    }

