"""Point lookups by sealed constants, identifiers at any depth, keys that change."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cloakline.operators import nested as N
from cloakline.operators import search as Q
from cloakline.operators import versions as V
from cloakline.operators.table import pseudonymize, reidentify


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def indexed(spark, kr, tmp_path):
    df = spark.range(2000).selectExpr("id", "'VIN' || id AS vin", "id % 7 AS dept").repartition(1)
    df = df.unionAll(spark.createDataFrame([(-1, None, 0), (-2, "  ", 0)], "id long, vin string, dept long"))
    Q.write_indexed(pseudonymize(df, "vin", kr), str(tmp_path / "t"), "vin", distinct=5000)
    return spark.read.parquet(str(tmp_path / "t"))


def test_constants_reach_the_scan(spark, kr, indexed):
    col = Q.revealed(indexed, "vin", kr)
    one = indexed.where(col == "VIN77").select("id", "vin")
    p = plan(one)
    sealed = Q.pseudonyms_of(spark, ["VIN77"], kr)[0]
    assert f"EqualTo(vin,{sealed})" in p and "aes_" not in p.lower() and "Python" not in p
    assert [r["id"] for r in one.collect()] == [77]
    many = indexed.where(col.isin("VIN3", "VIN5", "nobody")).select("id")
    assert "In(vin, [" in plan(many) and sorted(r["id"] for r in many.collect()) == [3, 5]
    assert indexed.where(col.isin(["VIN3"])).count() == 1
    assert indexed.where(col != "VIN77").count() == 2000  # the blank one differs, too; null doesn't
    assert [r["id"] for r in indexed.where(col == " ").collect()] == [-2]
    assert [r["id"] for r in indexed.where(col.is_null()).collect()] == [-1]
    with pytest.raises(ValueError, match="is_null"):
        col == None  # noqa: B015, E711
    with pytest.raises(ValueError, match="no column"):
        Q.revealed(indexed, "other", kr)


def test_bloom_filters_skip_row_groups(spark, kr, indexed):
    """A constant within the column's range that no row has: the scan puts out nothing."""
    absent = indexed.where(Q.revealed(indexed, "vin", kr) == "VIN5000").select("id")
    low, high = indexed.agg(F.min(F.when(F.col("vin") != "", F.col("vin"))), F.max("vin")).first()
    assert low < Q.pseudonyms_of(spark, ["VIN5000"], kr)[0] < high
    assert absent.collect() == []
    scan = absent._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numOutputRows").value() == 0


def test_sealed_parameters_of_sql(spark, kr, indexed):
    indexed.createOrReplaceTempView("cars")
    got = Q.sealed_sql(spark, "SELECT id FROM cars WHERE vin = :vin AND dept = :dept", kr, {"vin": "VIN8"}, {"dept": 1})
    assert "EqualTo(vin," in plan(got) and [r["id"] for r in got.collect()] == [8]
    got = Q.sealed_sql(spark, "SELECT id FROM cars WHERE array_contains(:vins, vin)", kr, {"vins": ["VIN8", "VIN9"]})
    assert sorted(r["id"] for r in got.collect()) == [8, 9]
    assert Q.sealed_sql(spark, "SELECT id FROM cars WHERE vin <=> :v", kr, {"v": None}).first()["id"] == -1
    with pytest.raises(ValueError, match="twice"):
        Q.sealed_sql(spark, "SELECT :a", kr, {"a": "x"}, {"a": 1})


DEEP = ("id long, head struct<name:string,n:int,inner:struct<vin:string,keep:string>>, "
        "`a.b` string, items array<struct<supp:int,tags:map<string,string>>>, words array<string>, m map<string,struct<x:string>>")
ROWS = [
    (1, ("n1", 5, ("v1", "k1")), "dot", [(7, {"t": "u", "": " "}), (None, None), None], ["w", None, " "], {"k": ("x",), " ": None}),
    (2, None, None, None, None, None),
    (3, (None, None, None), "", [], [], {}),
]
PATHS = ["head.name", "head.inner.vin", "`a.b`", "items[].supp", "items[].tags{}", "items[].tags{key}", "words[]", "m{}.x", "m{key}"]


def test_nested_roundtrip(spark, kr):
    df = spark.createDataFrame(ROWS, DEEP)
    for deterministic in (True, False):
        sealed = N.pseudonymize_nested(df, PATHS, kr, deterministic=deterministic)
        got = {r["id"]: r.asDict(True) for r in sealed.collect()}
        assert got[2] == {c: (2 if c == "id" else None) for c in df.columns}
        one = got[1]
        assert len(one["head"]["name"]) == 40 and one["head"]["n"] == 5 and one["head"]["inner"]["keep"] == "k1"
        assert len(one["items"][0]["supp"]) == 40 and one["items"][1] == {"supp": None, "tags": None} and one["items"][2] is None
        assert sorted(map(len, one["items"][0]["tags"])) == [40, 40] and sorted(one["items"][0]["tags"].values())[0] == ""
        assert [x and len(x) for x in one["words"]] == [40, None, ""] and len(one["m"]) == 2
        back = {r["id"]: r.asDict(True) for r in N.reidentify_nested(sealed, PATHS, kr).collect()}
        want = {r["id"]: r.asDict(True) for r in df.collect()}
        want[1]["items"][0]["supp"] = "7"
        want[1]["items"][0]["tags"][""] = ""  # a blank value
        want[1]["words"][2] = ""
        assert back == want
    p = plan(N.pseudonymize_nested(df, PATHS, kr))
    assert "Exchange" not in p and "Generate" not in p and "Python" not in p and kr.enc_key.hex() not in p.lower()


def test_nested_values_link_with_plain_columns(spark, kr):
    df = spark.createDataFrame([("v1", [("v1",)])], "vin string, items array<struct<vin:string>>")
    r = pseudonymize(N.pseudonymize_nested(df, "items[].vin", kr), "vin", kr).first()
    assert r["vin"] == r["items"][0]["vin"]
    stream_free = N.pseudonymize_nested(df, ["vin", "items[].vin"], kr).first()
    assert stream_free == r


@pytest.mark.parametrize("path,message", [
    ("nope", "not in DataFrame"), ("head.nope", "no field"), ("head", "name a field"), ("items.supp", "has no"), ("words{}", "has no"),
    ("id[]", "has no"), ("m{key}.x", "keys have no"), ("[]", "starts with"), ("a..b", "can't read"),
])
def test_nested_paths_that_do_not_fit(spark, kr, path, message):
    with pytest.raises(ValueError, match=message):
        N.pseudonymize_nested(spark.createDataFrame(ROWS, DEEP), path, kr)
    with pytest.raises(ValueError, match="meets another"):
        N.pseudonymize_nested(spark.createDataFrame(ROWS, DEEP), ["head", "head.name"], kr)


def test_nested_damage(spark, kr):
    df = N.pseudonymize_nested(spark.createDataFrame([(["a", "b"],)], "w array<string>"), "w[]", kr)
    broken = df.select(F.transform("w", lambda x: F.when(x.startswith("A"), x).otherwise(F.lit("AAAA"))).alias("w"))
    assert None in N.reidentify_nested(broken, "w[]", kr, on_error="null").first()["w"]
    with pytest.raises(PySparkException):
        N.reidentify_nested(df.select(F.array(F.lit("AAAA")).alias("w")), "w[]", kr).collect()


def rings(kr, other_kr):
    return (V.KeyringSet({"a": other_kr}, "a"), V.KeyringSet({"a": other_kr, "b": kr}, "b", unversioned="a"),
            V.KeyringSet({"b": kr}, "b"))


def test_two_keys_in_one_pass(spark, kr, other_kr):
    old, both, new = rings(kr, other_kr)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["x", None, " ", "y", "x"])], "id long, v string")
    t = V.pseudonymize_versioned(df.where("id < 3"), "v", old).unionAll(V.pseudonymize_versioned(df.where("id >= 3"), "v", both))
    t = t.unionAll(pseudonymize(spark.createDataFrame([(9, "plain old")], df.schema), "v", other_kr))
    seen = {r["id"]: r["v"] for r in t.collect()}
    assert seen[0].startswith("a.") and seen[3].startswith("b.") and seen[1] is None and seen[2] == "" and "." not in seen[9]
    back = V.reidentify_versioned(t, "v", both)
    assert {r["id"]: r["v"] for r in back.collect()} == {0: "x", 1: None, 2: "", 3: "y", 4: "x", 9: "plain old"}
    p = plan(back)
    assert "Exchange" not in p and "Join" not in p and kr.enc_key.hex() not in p.lower()
    with pytest.raises(PySparkException, match="unknown key id a"):
        V.reidentify_versioned(t.where("id < 9"), "v", new).collect()
    got = {r["id"]: r["v"] for r in V.reidentify_versioned(t, "v", new, on_error="null").collect()}
    assert got == {0: None, 1: None, 2: "", 3: "y", 4: "x", 9: None}


def test_reseal(spark, kr, other_kr):
    old, both, new = rings(kr, other_kr)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["x", None, " ", "x"])], "id long, v string")
    t = V.pseudonymize_versioned(df, "v", old).unionAll(V.pseudonymize_versioned(df, "v", both))
    moved = V.reseal(t, "v", both)
    assert {r["v"] for r in moved.collect()} == {None, "", V.pseudonymize_versioned(df, "v", new).first()["v"]}
    assert V.reseal(moved, "v", both).collect() == moved.collect()
    assert sorted(map(repr, V.reidentify_versioned(moved, "v", new).collect())) == sorted(
        map(repr, [(lambda r: r)(r) for r in V.reidentify_versioned(t, "v", both).collect()]))
    assert reidentify(moved.select(F.substring_index("v", ".", -1).alias("v")), "v", kr).distinct().count() == 3
    with pytest.raises(ValueError, match="key ids"):
        V.KeyringSet({"a.b": kr}, "a.b")
    with pytest.raises(ValueError, match="no keyring"):
        V.KeyringSet({"a": kr}, "b")
