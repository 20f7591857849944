"""Every query with SQL against DuckDB on the smallest tables, and the contract of the entry."""

import glob
import os
import time

import __spark_entry__ as entry
import duckdb
import numpy as np
import pandas as pd
import pytest
from lexipress.plans import queries as plans


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def rows(df: pd.DataFrame):
    def show(v):
        if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and v != v:
            return "null"
        # Numpy's numbers, which nullable columns hold, are numbers too.
        return repr(float(v)) if isinstance(v, (int, float, np.number)) and not isinstance(v, bool) else str(v)

    return sorted(tuple(show(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_query_equals_sql(spark, sf_dir, duck, name):
    got, want = plans.QUERIES[name](spark, sf_dir).toPandas(), duck.execute(plans.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_a_long_text_is_cut_once(spark):
    from lexipress.functions import text as T
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(20_000))), (2, "a b"), (3, ""), (4, None)], "id long, text string")
    begun = time.perf_counter()
    got = {r["id"]: r["g"] for r in df.select("id", T.word_ngrams(F.col("text"), 5).alias("g")).collect()}
    assert time.perf_counter() - begun < 30  # minutes if the words were made anew for each gram
    assert len(got[1]) == 19_996 and got[1][-1] == "w19995 w19996 w19997 w19998 w19999" and got[2] == ["a b"] and got[3] == []


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.SQL)))
def test_other_queries_run(spark, sf_dir, name):
    df = plans.QUERIES[name](spark, sf_dir)
    assert len(df.columns) == len(set(df.columns)) and df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
