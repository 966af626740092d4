import pytest
from pyspark.sql import functions as F

from cloakline.operators.grouping import group_arrays, group_reidentify, n_per_group, pseudonymize_arrays
from cloakline.operators.table import pseudonymize


def test_chunks_bounded_and_whole(spark):
    # One hot group with most rows, spread over several partitions, plus nulls.
    df = spark.range(0, 2000, numPartitions=5).select(
        F.when(F.col("id") % 10 == 0, "cold").otherwise("hot").alias("g"),
        F.when(F.col("id") % 97 == 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("v"),
    )
    arrays = group_arrays(df, "g", "v", batch_size=7)
    rows = arrays.collect()
    assert max(len(r.v) for r in rows) <= 7
    flat = {g: [] for g in ("hot", "cold")}
    for r in rows:
        flat[r.g].extend(r.v)
    expected = {g: [] for g in ("hot", "cold")}
    for r in df.collect():
        expected[r.g].append(r.v)
    for g in flat:
        assert sorted(flat[g], key=str) == sorted(expected[g], key=str)
    assert len({(r.g, r.chunk) for r in rows}) == len(rows)


def test_keep_nulls_false(spark):
    df = spark.createDataFrame([("g", "a"), ("g", None)], "g string, v string")
    assert group_arrays(df, "g", "v", keep_nulls=False).first().v == ["a"]


def test_group_reidentify_roundtrip(spark, kr):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_type", "user_id")
    pe = pseudonymize(ev, "user_id", kr)
    out = group_reidentify(pe, "event_type", "user_id", kr, batch_size=50)
    got = sorted((r.event_type, v) for r in out.collect() for v in r.user_id)
    exp = sorted((r.event_type, str(r.user_id)) for r in ev.collect())
    assert got == exp


def test_pseudonymize_arrays(spark, kr):
    df = spark.createDataFrame([(["a", "", None],)], "arr array<string>")
    got = pseudonymize_arrays(df, "arr", kr).first().arr
    assert got[0] and got[1] and got[2] is None and got[0] != got[1]


def test_n_per_group(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    got = sorted((r.event_type, r.event_id) for r in n_per_group(ev, "event_type", "event_id", 2).collect())
    rows = sorted((r.event_type, r.event_id) for r in ev.select("event_type", "event_id").collect())
    exp = []
    for g in sorted({t for t, _ in rows}):
        exp.extend([(t, i) for t, i in rows if t == g][:2])
    assert got == exp


def test_group_reidentify_matches_elementwise(spark, kr):
    from cloakline.operators.grouping import reidentify_arrays
    from cloakline.operators.table import pseudonymize

    rows = [("a", f"v{i % 7}") for i in range(60)] + [("b", None), ("b", ""), ("b", "x")]
    df = spark.createDataFrame(rows, "g string, v string")
    pdf = pseudonymize(df, "v", kr)  # '' stays '', null stays null
    for strategy in ("distinct", "row"):
        fast = group_reidentify(pdf, "g", "v", kr, batch_size=8, strategy=strategy)
        slow = reidentify_arrays(group_arrays(pdf, "g", "v", batch_size=8), "v", kr)
        flat = lambda d: sorted(((r.g, repr(x)) for r in d.collect() for x in r.v))
        assert flat(fast) == flat(slow)
        assert all(len(r.v) <= 8 for r in fast.collect())
    blank = spark.createDataFrame([("a", "  ")], "g string, v string")
    with pytest.raises(Exception, match="whitespace"):
        group_reidentify(blank, "g", "v", kr).collect()
    got = group_reidentify(blank, "g", "v", kr, on_error="null").collect()
    assert got[0].v == [None]


def test_group_reidentify_uses_distinct_plan_on_stored_column(spark, kr):
    from cloakline.plans.inspect import plan_text
    from cloakline.session import scratch_path

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_type", "user_id")
    path = scratch_path(spark, "gr")
    pseudonymize(ev, "user_id", kr).write.parquet(path)
    out = group_reidentify(spark.read.parquet(path), "event_type", "user_id", kr, strategy="distinct")
    assert "Join" in plan_text(out, "simple")
