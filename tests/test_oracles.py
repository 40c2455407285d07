"""Every query with SQL against DuckDB; every other one runs. The tables are those of the smallest size that shows ties of rounding."""

import os
from pathlib import Path

import duckdb
import pytest

from lattica.plans import ORACLES, QUERIES
from lattica.session import ship

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v != v:
        return ""
    if isinstance(v, list | tuple):
        return str([plain(x) for x in v])
    return repr(float(v)) if isinstance(v, float) else str(v)


def lines(columns, rows):
    order = sorted(columns)
    return sorted(tuple(plain(r[columns.index(c)]) for c in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    df = QUERIES[name](ship(spark), SF)
    want = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert lines(df.columns, df.collect()) == lines(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    df = QUERIES[name](ship(spark), SF)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


def test_whole_jobs(spark):
    """Queries over all lines, channels and cells have more rows than those over a part; the SQL holds what they are."""
    for part, whole in (("trilinear_query", "trilinear_query_all"), ("channel_unbind", "channel_unbind_all"), ("segment_ends", "segment_cells")):
        few, many = (QUERIES[n](ship(spark), SF).count() for n in (part, whole))
        assert few < many
