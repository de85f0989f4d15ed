"""Registered queries against their DuckDB oracles on the smallest fixture (fast subset),
plus the invariance of results to the shuffle partition count."""

import duckdb
import pytest

import __spark_entry__ as E
from shoplens.session import TABLES

from .conftest import SF_SMALL

FAST = [
    "rfm_profile", "source_facts", "duplicate_audit", "lines_deduplicated", "lines_flagged", "customer_countries",
    "customer_segments", "segment_profiles", "lloyd_trace", "kpp_weights", "invoice_timeline", "explorer_points",
    "constraint_report", "assignment_fingerprint", "silhouette_euclidean", "majority_mapping",
]


def _canon(df):
    df = df[sorted(df.columns)]
    rows = [tuple(repr(v) if v == v else "nan" for v in r) for r in df.itertuples(index=False)]
    return sorted(rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.sql(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _canon(got) == _canon(want)


def test_every_query_has_a_callable_and_oracle_keys_are_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "recency" in df.columns
