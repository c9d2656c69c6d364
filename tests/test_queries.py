"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import pytest
from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check import digest, duck  # noqa: E402

from tidemark.plans.oracle import ORACLE as CORE_SQL  # noqa: E402
from tidemark.plans.queries import QUERIES as CORE  # noqa: E402

QUERIES = CORE
ORACLE = CORE_SQL


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert df.columns and rows is not None
        return
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert digest(rows, df.columns) == digest(res.fetchall(), dcols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["row_key", "version"]


def test_every_query_but_sink_and_layout_has_an_oracle():
    assert set(QUERIES) - set(ORACLE) == {"range_layout", "forward_json"}
    assert len(QUERIES) >= 63
