"""Every query with a SQL twin matches DuckDB on the same tables."""

import pytest

import oracle
from conftest import SMALL
from statline.plans.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    res = oracle.compare(spark, SMALL, name, duck)
    assert res["status"] in ("exact", "close"), res


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == list(e.queries()["top_players"](spark, SMALL).columns)
