"""Every registered query against its SQL; queries without SQL must run and give rows."""

import pytest

import oracle
from pressgauge.queries import registry

REGISTRY = registry()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, sf_dir, con, name):
    query, sql = REGISTRY[name]
    df = query(spark, sf_dir)
    if sql is None:
        assert len(df.collect()) > 0
    else:
        assert oracle.compare(df, con, sql) is None


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["day", "stock", "exposure", "visit", "trend"]
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
