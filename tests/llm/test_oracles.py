"""The opN queries against their SQL, on the smallest tables."""

import duckdb
import pytest

from cloakline.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in "documents embeddings benchmark labels".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(rows):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_matches_sql(spark, con, name):
    df = Q.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    sql = con.sql(Q.ORACLES[name])
    assert cols == sorted(sql.columns)
    assert plain(df.select(*cols).collect()) == plain(con.sql(f"SELECT {', '.join(cols)} FROM ({Q.ORACLES[name]})").fetchall())


def test_a_query_for_each_operator():
    assert [int(n[2:].split("_")[0]) for n in Q.QUERIES] == list(range(1, 14))
