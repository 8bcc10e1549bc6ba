"""The registered corpus queries over the test tables, those with SQL against it."""

import pytest

import __spark_entry__
import oracle
from pressgauge.llm.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    query, sql = QUERIES[name]
    df = query(spark, sf_dir)
    if sql is None:
        assert len(df.collect()) > 0
    else:
        assert oracle.compare(df, con, sql) is None


def test_registered():
    names = __spark_entry__.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
