"""Every query with an oracle gives DuckDB's rows."""

import math

import duckdb
import pytest

from terrapanel.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, bool) or isinstance(v, str):
        return str(v)
    try:
        return repr(round(float(v) + 0.0, 4) + 0.0)
    except (TypeError, ValueError):
        return str(v)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_oracle(spark, con, sf_dir, name):
    df = registry.queries()[name](spark, sf_dir)
    rel = con.sql(registry.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    at = [rel.columns.index(c) for c in cols]
    mine = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    theirs = sorted(tuple(norm(r[i]) for i in at) for r in rel.fetchall())
    assert mine == theirs
    assert mine


def test_names_are_unique_and_described():
    assert len(registry.queries()) > 150
    assert set(registry.oracle_sql()) <= set(registry.queries())
