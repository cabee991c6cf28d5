"""Every registered query against its DuckDB oracle on the smallest data folder."""

import pytest

from conftest import SMALL
from oracle_util import assert_same

from __spark_entry__ import entry, oracle_sql, queries
from loanlens.plans.registry import QUERIES

SQL = oracle_sql()
KEYS = sorted(QUERIES)  # the other query modules have tests of their own


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns and df.count() >= 0


def test_every_key_has_a_callable():
    assert len(KEYS) >= 150
    assert set(SQL) <= set(queries())
    assert set(KEYS) <= set(SQL)  # no key without an oracle


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    pdf = queries()[key](spark, SMALL).toPandas()
    assert_same(pdf, duck.execute(SQL[key]).df(), key)
