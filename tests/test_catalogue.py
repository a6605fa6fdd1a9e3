"""Every registered query against its SQL oracle (DuckDB) on the smallest benchmark scale."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from layerwise.plans.catalogue import QUERIES
from layerwise.plans.oracle import ORACLE
from layerwise.plans.fixtures import TABLES

from tests.conftest import SF_SMALL


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0 and "points" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_sql()[name])
    expected_cols = [d[0] for d in res.description]
    expected = res.fetchall()
    assert sorted(df.columns) == sorted(expected_cols)
    assert len(got) == len(expected)
    assert _canonical(df.columns, got) == _canonical(expected_cols, expected)


@pytest.mark.parametrize("name", ["team_performance", "clean_contests", "clean_history", "quality_profile",
                                  "predict_contests", "predict_pair_clamped", "standardise_rankings"])
def test_result_independent_of_partitioning(spark, name):
    results = []
    for n in (1, 4, 50):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        df = queries()[name](spark, SF_SMALL)
        results.append(_canonical(df.columns, [tuple(r) for r in df.collect()]))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1] == results[2]
