"""Every registered query with an oracle equals its DuckDB SQL at sf0.01;
every rows-only query runs and yields rows with a stable schema."""

from __future__ import annotations

import os

import pytest

from scripts.check_oracle import duck, normalize, type_mismatches
from tests.conftest import SF001

import __spark_entry__ as entry

from feedlens.plans.catalog import ORACLES as NAMES_WITH_SQL  # noqa: E402
from feedlens.plans.catalog import QUERIES as NAMES  # noqa: E402

# The training-data queries have tests of their own.
QUERIES = {k: v for k, v in entry.queries().items() if k in NAMES}
ORACLES = {k: v for k, v in entry.oracle_sql().items() if k in NAMES_WITH_SQL}


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.skipif(not os.path.exists(SF001), reason="test data missing")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF001)
    sc, sn = normalize(sdf.columns, [tuple(r) for r in sdf.collect()])
    cur = con.execute(ORACLES[name])
    dc, dn = normalize([d[0] for d in cur.description], cur.fetchall())
    assert sc == dc
    assert type_mismatches(sdf, con, ORACLES[name]) == []
    assert len(sn) == len(dn)
    assert sn == dn


@pytest.mark.skipif(not os.path.exists(SF001), reason="test data missing")
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, name):
    df = QUERIES[name](spark, SF001)
    schema = df.schema
    rows = df.collect()
    assert len(rows) > 0
    assert df.schema == schema and len(rows[0]) == len(schema.fields)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "dimension_value" in df.columns
