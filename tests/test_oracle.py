"""Registered queries vs their DuckDB SQL on the provided tables."""

import pytest

import __spark_entry__ as E
from oracle_check import digest, duck

NAMES = list(E.QUERIES)
SQL = E.ORACLE


def _compare(spark, name, sf):
    df = E.queries()[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    dcols, drows = duck(SQL[name], sf)
    assert sorted(df.columns) == sorted(dcols)
    h1, l1 = digest(df.columns, rows)
    h2, l2 = digest(dcols, drows)
    assert len(rows) == len(drows)
    assert h1 == h2, (sorted(set(l1) - set(l2))[:3], sorted(set(l2) - set(l1))[:3])
    return len(rows)


def test_every_query_has_oracle():
    assert set(NAMES) == set(SQL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    _compare(spark, name, "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_hot_key_path(spark, chunked, name):
    _compare(spark, name, "/root/testdata/sf0.001")


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:5] == ["userId", "alertType", "riskScore", "reason", "transactionCount"]
    assert df.count() >= 0
