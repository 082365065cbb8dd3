"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_MID, SF_SMALL
from tools.check_oracle import TABLES, rows_of

from clickmart.plans.registry import ORACLE, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    c.sql("SET TimeZone='UTC'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.sql(ORACLE[name])
    want = rows_of(res.columns, res.fetchall())
    assert sorted(df.columns) == sorted(res.columns)
    assert got == want


def test_no_registered_query_is_empty_at_the_checked_scale(spark):
    """Equal results prove nothing where both are empty."""
    for name, query in QUERIES.items():
        assert len(query(spark, SF_MID).take(1)) == 1, name
    labels = {r.intensity_segment for r in QUERIES["variety_seekers"](spark, SF_MID).collect()}
    assert len(labels) == 4
    quadrants = {r.promo_status.split(" ")[0] for r in QUERIES["promo_quality"](spark, SF_MID).collect()}
    assert {"Star", "Hidden"} <= quadrants
    assert QUERIES["session_paths"](spark, SF_MID).where("session_unique_id is null").count() == 1


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1 and "ci_low" in df.columns
