"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from cloakline.plans import registered

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    return v


def key(rows):
    return sorted((tuple(norm(x) for x in r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(registered.oracles()) == set(registered.QUERIES)
    assert set(registered.QUERIES) <= set(E.queries())


def test_entry(spark):
    df = E.entry(spark)
    assert "s_c_name" in df.columns and df.count() > 0


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = df.select(*cols).collect()
    sql = E.oracle_sql()[name]
    ocols = sorted(con.sql(sql).columns)
    exp = con.sql(f"SELECT {', '.join(ocols)} FROM ({sql})").fetchall()
    assert cols == ocols
    assert key(got) == key(exp)
