import base64
import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from cloakline.operators.table import pseudonymize, reidentify

EDGE = [
    None, "", "   ", "\t\n", "None", " padded ", "é", "🙂 emoji", "x" * 29, "y" * 30, "z" * 200,
    " 　", "HFW5636AZWOUJ2PAM", "4H46H0SXAI3MM49S5",
]
BLANK = {"", "   ", "\t\n", " 　"}


def edge_df(spark, parts=3):
    return spark.createDataFrame([(i, v) for i, v in enumerate(EDGE)], "id int, v string").repartition(parts)


@pytest.mark.parametrize("strategy", ["row", "distinct"])
def test_roundtrip_edge_rows(spark, kr, strategy):
    df = edge_df(spark)
    p = pseudonymize(df, "v", kr, strategy=strategy)
    got = {r.id: r.v for r in p.collect()}
    for i, v in enumerate(EDGE):
        if v is None:
            assert got[i] is None
        elif v in BLANK:
            assert got[i] == ""
        else:
            assert got[i] and got[i] != v and "\r" not in got[i] and "\n" not in got[i]
            assert len(got[i]) == 4 * -(-(28 + len(v.encode())) // 3)
            raw = base64.b64decode(got[i])
            assert len(raw) == 12 + len(v.encode()) + 16
    back = {r.id: r.v for r in reidentify(p, "v", kr, strategy=strategy).collect()}
    for i, v in enumerate(EDGE):
        assert back[i] == (None if v is None else ("" if v in BLANK else v))


def test_deterministic_across_partitionings_and_columns(spark, kr):
    df = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").select("c_custkey", "c_name")
    a = pseudonymize(df.repartition(1), "c_name", kr, strategy="row").collect()
    b = pseudonymize(df.repartition(7), "c_name", kr, strategy="distinct").collect()
    assert sorted(a) == sorted(b)
    both = pseudonymize(df.withColumn("twin", F.col("c_name")), ["c_name", "twin"], kr)
    assert both.where(F.col("c_name") != F.col("twin")).count() == 0


def test_iv_is_hmac_of_value(spark, kr):
    df = spark.createDataFrame([("HFW5636AZWOUJ2PAM",)], "v string")
    p = pseudonymize(df, "v", kr).first().v
    iv = base64.b64decode(p)[:12]
    assert iv == hmac.new(kr.iv_key, b"HFW5636AZWOUJ2PAM", hashlib.sha256).digest()[:12]


def test_random_mode_differs_and_roundtrips(spark, kr):
    df = spark.createDataFrame([(i, "same") for i in range(50)], "id int, v string")
    p = pseudonymize(df, "v", kr, deterministic=False)
    rows = p.collect()
    assert len({r.v for r in rows}) == 50
    back = reidentify(spark.createDataFrame(rows), "v", kr)
    assert {r.v for r in back.collect()} == {"same"}


def test_run_linkage_one_pseudonym_per_value(spark, kr):
    df = spark.createDataFrame([(i, f"v{i % 5}") for i in range(100)], "id int, v string")
    p = pseudonymize(df, "v", kr, deterministic=False, linkage="run")
    assert p.select("v").distinct().count() == 5
    assert p.count() == 100


def test_non_string_identifiers(spark, kr):
    df = spark.sql("SELECT 42L AS n, TIMESTAMP_NTZ'2024-01-02 03:04:05' AS ts, 1.5D AS d")
    p = pseudonymize(df, ["n", "ts", "d"], kr, strategy="row")
    assert all(t == "string" for _, t in p.dtypes)
    back = reidentify(p, ["n", "ts", "d"], kr, strategy="row").first()
    assert back.n == "42" and back.ts == "2024-01-02 03:04:05" and back.d == "1.5"


def test_null_as_text(spark, kr):
    df = spark.createDataFrame([(None,)], "v string")
    p = pseudonymize(df, "v", kr, null_as_text=True)
    assert reidentify(p, "v", kr).first().v == "None"


def test_bad_pseudonyms(spark, kr, other_kr):
    good = pseudonymize(spark.createDataFrame([("abc",)], "v string"), "v", kr).first().v
    raw = bytearray(base64.b64decode(good))
    raw[-1] ^= 1
    tampered = base64.b64encode(bytes(raw)).decode()
    bad = [tampered, good[:20], "not base64 $$", "QUJD"]
    df = spark.createDataFrame([(b,) for b in bad], "v string")
    assert [r.v for r in reidentify(df, "v", kr, on_error="null", strategy="row").collect()] == [None] * 4
    with pytest.raises(Exception):
        reidentify(df.limit(1), "v", kr, strategy="row").collect()
    other = spark.createDataFrame([(good,)], "v string")
    assert reidentify(other, "v", other_kr, on_error="null").first().v is None


def test_column_order_and_other_columns_kept(spark, kr):
    df = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    p = pseudonymize(df, ["c_name"], kr)
    assert p.columns == df.columns
    assert p.select("c_custkey", "c_nationkey").exceptAll(df.select("c_custkey", "c_nationkey")).count() == 0


def test_argument_checks(spark, kr):
    df = spark.createDataFrame([("a",)], "v string")
    with pytest.raises(ValueError):
        pseudonymize(df, "missing", kr)
    with pytest.raises(ValueError):
        pseudonymize(df, ["v", "v"], kr)
    with pytest.raises(ValueError):
        pseudonymize(df, "v", kr, linkage="bogus")
    with pytest.raises(ValueError):
        pseudonymize(df, "v", kr, strategy="bogus")


def test_binary_values_come_back_as_bytes(spark, kr):
    rows = [(1, b"\xff\x01"), (2, b"\xfe\x01"), (3, b""), (4, None), (5, b"  "), (6, b"plain")]
    df = spark.createDataFrame(rows, "id int, b binary")
    for strategy in ("row", "distinct"):
        p = pseudonymize(df, "b", kr, strategy=strategy).collect()
        assert len({r.b for r in p}) == 6
        back = reidentify(spark.createDataFrame(p, "id int, b string"), "b", kr, binary="b").collect()
        assert {r.id: None if r.b is None else bytes(r.b) for r in back} == dict(rows)


def test_timestamps_have_one_text_in_every_time_zone(spark, kr):
    from pyspark.sql import functions as F

    old = spark.conf.get("spark.sql.session.timeZone")
    got = set()
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.range(1).select(F.timestamp_micros(F.lit(1_700_000_000_000_001)).alias("t"))
            for strategy in ("row", "distinct"):
                p = pseudonymize(df, "t", kr, strategy=strategy)
                got.add(p.first().t)
                assert reidentify(p, "t", kr).first().t == "2023-11-14 22:13:20.000001Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert len(got) == 1


def test_dotted_names_and_complex_types(spark, kr):
    import pytest

    df = spark.createDataFrame([("x", "y", [1])], "`a.b` string, `A` string, arr array<int>")
    for strategy in ("row", "distinct"):
        p = pseudonymize(df, "a.b", kr, strategy=strategy)
        assert p.columns == df.columns and reidentify(p, "a.b", kr, strategy="row").first()[0] == "x"
    with pytest.raises(ValueError, match="array"):
        pseudonymize(df, "arr", kr)
    with pytest.raises(ValueError, match="not in DataFrame"):
        pseudonymize(df, "a", kr)


def test_random_pseudonyms_of_one_column_differ(spark, kr):
    df = spark.range(20).select(F.col("id").cast("string").alias("a"), F.col("id").cast("string").alias("b"))
    p = pseudonymize(df, ["a", "b"], kr, deterministic=False)
    assert not p._jdf.queryExecution().optimizedPlan().deterministic()
    assert p.where("a = b").isEmpty()
