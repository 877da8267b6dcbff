"""Every registered query against its DuckDB SQL, on sf0.001."""

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from orbis.plans import catalog  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["city_id", "city", "year", "value"]


def test_every_query_has_sql():
    assert set(catalog.QUERIES) <= set(E.oracle_sql())
