"""The driver contract of __spark_entry__.py."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

from clickmart.plans import registry  # noqa: E402

QUERIES, ORACLE = registry.QUERIES, registry.ORACLE


def test_keys():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql()) <= set(E.queries())
    assert all(isinstance(sql, str) and sql.strip() for sql in E.oracle_sql().values())


@pytest.mark.parametrize("name", ["funnel_overall", "cart_abandon", "bundle_strategy", "segment_compare",
                                  "chi_square_pvalues"])
def test_schema_is_stable(spark, name):
    a = QUERIES[name](spark, SF_SMALL).schema
    b = QUERIES[name](spark, SF_SMALL).schema
    assert [(f.name, f.dataType) for f in a] == [(f.name, f.dataType) for f in b]


def test_columns_named_and_oracles_agree(spark):
    con = duckdb.connect()
    for t in ["events", "lineitem", "part"]:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name, fn in QUERIES.items():
        cols = fn(spark, SF_SMALL).columns
        assert len(set(cols)) == len(cols), name           # every column aliased once
        assert not any("(" in c for c in cols), name       # no unaliased expressions
        if name in ORACLE:
            ocols = con.sql(f"SELECT * FROM ({ORACLE[name]}) LIMIT 0").columns
            assert sorted(ocols) == sorted(cols), name
