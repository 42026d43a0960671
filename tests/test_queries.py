import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from textmill.plans.oracles import oracle_sql as corpus_sql

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as from '{f}'")
    return c


def cells(df: pd.DataFrame) -> list:
    cols = sorted(df.columns)
    fix = lambda x: None if pd.api.types.is_scalar(x) and pd.isna(x) else round(float(x), 9) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)
    return [cols, *sorted([[str(fix(x)) for x in row] for row in df[cols].astype(object).values.tolist()])]


def test_entry(spark):
    assert entry.entry(spark).count() >= 0


@pytest.mark.parametrize("name", sorted(corpus_sql()))
def test_against_sql(spark, duck, name):
    assert cells(entry.queries()[name](spark, SF).toPandas()) == cells(duck.sql(corpus_sql()[name]).df())
