"""Every registered query against its SQL, run on the given tables."""

import os

import pytest

import __spark_entry__ as contract
from oracle import connect, difference

SMALL = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
LARGER = "/root/testdata/sf0.01"
QUERIES, SQL = contract.queries(), contract.oracle_sql()
#: A station needs over 168 hours before the split: the smallest tables leave no training row.
NEED_HISTORY = {"train_predict", "early_stopping", "feature_importance", "saved_model_auc"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    sf_dir = LARGER if name in NEED_HISTORY else SMALL
    assert difference(QUERIES[name](spark, sf_dir).toPandas(), connect(sf_dir).execute(SQL[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, LARGER).count() > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "is_congested" in df.columns
