"""Every registered query runs on the smallest tables; SQL-expressible ones
match the DuckDB oracle there (the driver repeats this at sf0.01)."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from sparkprep.sources.tables import TABLES

SLOW = {"lasso_select", "learning_curve", "logit_cv", "gbt_scores", "forest_importance",
        "forest_metrics", "fit_score", "gbt_early_stop"}


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def _canon(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = sorted(tuple(_norm(None if pd.isna(x) is True else x) for x in r)
                  for r in df[cols].itertuples(index=False, name=None))
    return cols, rows


@pytest.fixture(scope="module")
def con(sf001):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf001}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["desc_category", "perfect_rating_score", "n"]
    assert df.count() >= 0


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, sf001, name):
    got = E.queries()[name](spark, sf001).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert _canon(got) == _canon(want)
