import pytest

from cloakline.functions.sql import register_functions
from cloakline.operators.table import pseudonymize


@pytest.fixture(scope="module")
def sql(spark, kr):
    register_functions(spark, kr)
    return spark.sql


def test_array_functions(sql):
    r = sql("SELECT pseudonymize(array('string1', 'string2', '', NULL), 'true') AS p").first().p
    assert r[0] and r[1] and r[2] and r[3] is None
    assert len(r[0]) == 48  # 12 + 7 + 16 bytes, as the reference's documented example
    back = sql(f"SELECT reidentify(array('{r[0]}', '{r[1]}', '', NULL)) AS b").first().b
    assert back == ["string1", "string2", "", None]
    again = sql("SELECT pseudonymize(array('string1'), 'TRUE') AS p").first().p
    assert again[0] == r[0]
    rnd = sql("SELECT pseudonymize(array('string1', 'string1'), 'false') AS p").first().p
    assert rnd[0] != rnd[1] and rnd[0] != r[0]


def test_sql_matches_dataframe(spark, sql, kr):
    df = spark.createDataFrame([("HFW5636AZWOUJ2PAM",), ("4H46H0SXAI3MM49S5",)], "v string")
    df.createOrReplaceTempView("vins_sql")
    a = sorted(r.v for r in pseudonymize(df, "v", kr, strategy="row").collect())
    b = sorted(r.p for r in sql("SELECT pseudonymize(array(v), 'true')[0] AS p FROM vins_sql").collect())
    assert a == b and all(len(x) == 60 for x in a)


def test_json_form_and_try(sql):
    j = sql("""SELECT pseudonymize_json('["a","b"]', 'true') AS j""").first().j
    assert sql(f"SELECT reidentify_json('{j}') AS r").first().r == '["a","b"]'
    assert sql("SELECT try_reidentify(array('bogus', 'QUJD')) AS r").first().r == [None, None]
    with pytest.raises(Exception):
        sql("SELECT reidentify(array('QUJDREVGR0hJSktMTU5PUFFSU1RVVldYWVo=')) AS r").collect()


def test_grouped_reidentify_sql(spark, sql, kr):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    pseudonymize(ev.select("event_type", "user_id"), "user_id", kr).createOrReplaceTempView("pe_sql")
    out = sql("""SELECT event_type, reidentify(array_agg(user_id)) AS ids
                 FROM (SELECT * FROM pe_sql WHERE event_type = 'click' LIMIT 20) GROUP BY event_type""")
    row = out.first()
    assert row.event_type == "click" and len(row.ids) == 20 and all(i.isdigit() for i in row.ids)


def test_chunked_grouping_in_sql(spark, kr):
    from cloakline.operators.table import pseudonymize

    register_functions(spark, kr)
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_type", "user_id")
    pseudonymize(ev, "user_id", kr).createOrReplaceTempView("pe_chunks")
    out = spark.sql(
        """SELECT event_type, reidentify(array_agg(user_id)) AS vins
           FROM (SELECT event_type, user_id, monotonically_increasing_id() AS rid
                 FROM (SELECT event_type, user_id FROM pe_chunks SORT BY event_type, user_id))
           GROUP BY event_type, chunk_of(rid, 50)"""
    ).collect()
    assert max(len(r.vins) for r in out) <= 50
    got = sorted((r.event_type, v) for r in out for v in r.vins)
    assert got == sorted((r.event_type, str(r.user_id)) for r in ev.collect())
