"""Every registered query against its SQL, on the smallest data."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from kinora.oracles import ORACLES as SQL
from kinora.queries import QUERIES
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _ordered(df):
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, duck, name):
    ours = _ordered(QUERIES[name](spark, sf).toPandas())
    theirs = _ordered(duck.execute(SQL[name]).df())
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False, rtol=0, atol=2e-6)


def test_registry_is_consistent():
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())
    assert set(SQL) <= set(QUERIES)
    assert {n for n in QUERIES if n not in SQL} == {
        "als_user_recs", "als_unseen_user_recs", "als_item_similarity", "als_predict_pairs",
        "als_grid_rmse", "als_grid_best",
    }


def test_entry(spark):
    assert contract.entry(spark).count() > 0
