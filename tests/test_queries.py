"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from compare_oracle import digest, duck  # noqa: E402
from logscan.plans.queries import QUERIES as CORE  # noqa: E402

# the library's own queries; those of optional parts have their own tests
QUERIES = {k: v for k, v in E.queries().items() if k in CORE}
ORACLES = {k: v for k, v in E.oracle_sql().items() if k in CORE}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_entry():
    missing = set(QUERIES) - set(ORACLES)
    assert missing <= {"pca_detect", "ae_history"}, missing


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in sdf.collect()]
    if name not in ORACLES:
        assert len(sdf.columns) > 0
        return
    rel = con.sql(ORACLES[name])
    drows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert len(rows) == len(drows)
    assert digest(sdf.columns, rows)[0] == digest(rel.columns, drows)[0]


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["event_id", "LogLevel", "Service", "Message", "TimeVal", "recon_error"]
    assert df.count() > 0
