import io
import json
import urllib.error

import pytest
from pyspark.sql import functions as F

from cloakline.functions.sql import register_lookup_function
from cloakline.operators import lookup as L
from cloakline.plans.inspect import plan_text
from cloakline.plans.registered import FlakyLookup, PrefixLookup, SizeLookup, StripLookup
from cloakline.session import scratch_path, scratch_scope
import fakes
from fakes import NeverLookup, NullLookup, ShortLookup
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(fakes)  # the workers can't import the tests


def test_batches_by_count_and_bytes():
    pol = L.LookupPolicy(batch_size=3, max_bytes=20)
    got = list(L.batches(["a", "b", "c", "d"], pol))
    assert got == [["a", "b", "c"], ["d"]]
    got = list(L.batches(["x" * 8, "y" * 8, "z"], pol))  # 11 + 11 > 20
    assert got == [["x" * 8], ["y" * 8, "z"]]
    with pytest.raises(L.LookupFailed):
        list(L.batches(["w" * 30], pol))


def test_retry_then_success_and_failures():
    slept = []
    pol = L.LookupPolicy(max_retries=5, backoff_base=0.1, backoff_cap=0.3)
    out = L.call_with_retry(FlakyLookup(failures=3), ["a", "b"], pol, sleep=slept.append)
    assert out == ["p4_a", "p4_b"] and slept == [0.1, 0.2, 0.3]
    with pytest.raises(L.LookupFailed):
        L.call_with_retry(NeverLookup(), ["a"], pol, sleep=lambda s: None)
    with pytest.raises(L.LookupFailed):
        L.call_with_retry(ShortLookup(), ["a", "b"], pol, sleep=lambda s: None)
    with pytest.raises(L.LookupFailed):
        L.call_with_retry(lambda v: "not a list", ["a"], pol, sleep=lambda s: None)
    assert L.call_with_retry(NeverLookup(), [], pol) == []


def test_apply_lookup_semantics(spark):
    rows = [(1, "a", "x"), (2, "a", None), (3, "  ", "y"), (4, "b", "a"), (5, None, "")]
    df = spark.createDataFrame(rows, "id int, c1 string, c2 string")
    out = L.apply_lookup(df, ["c1", "c2"], PrefixLookup())
    assert out.columns == df.columns
    got = {r.id: (r.c1, r.c2) for r in out.collect()}
    assert got == {1: ("p_a", "p_x"), 2: ("p_a", None), 3: ("", "p_y"), 4: ("p_b", "p_a"), 5: (None, "")}
    mapping = L.lookup_mapping(df, ["c1", "c2"], PrefixLookup())
    assert sorted(r.value for r in mapping.collect()) == ["a", "b", "x", "y"]  # each value once
    back = L.apply_lookup(out, ["c1", "c2"], StripLookup())
    assert {r.id: (r.c1, r.c2) for r in back.collect()}[1] == ("a", "x")


def test_lookup_over_many_values_and_partitions(spark):
    df = spark.range(0, 5000).select(F.col("id"), (F.col("id") % 1234).cast("string").alias("v"))
    out = L.apply_lookup(df, "v", PrefixLookup(), policy=L.LookupPolicy(batch_size=50), partitions=3)
    assert out.where(F.col("v") != F.concat(F.lit("p_"), (F.col("id") % 1234).cast("string"))).count() == 0


def test_lookup_failure_propagates(spark):
    df = spark.createDataFrame([("a",)], "v string")
    with pytest.raises(Exception):
        L.apply_lookup(df, "v", ShortLookup()).collect()


def test_nondeterministic_input_is_materialized(spark):
    df = spark.range(0, 200).select((F.rand(7) * 50).cast("int").cast("string").alias("v"))
    out = L.apply_lookup(df, "v", PrefixLookup()).collect()
    assert all(r.v.startswith("p_") for r in out)


def test_codecs():
    assert json.loads(L.PSEUDONYMIZE_CODEC.encode(["é"]).decode()) == {"identifiers": ["é"]}
    assert L.REIDENTIFY_CODEC.encode(["x"]) == b'{"reidentifications": ["x"]}'
    assert L.REIDENTIFY_CODEC_SQL.decode('{"identifiers": ["a"]}') == ["a"]
    assert L.PSEUDONYMIZE_CODEC.decode('{"message": "throttled"}') is None
    assert L.PSEUDONYMIZE_CODEC.decode("not json") is None
    assert L.PSEUDONYMIZE_CODEC.decode('{"pseudonyms": "None"}') is None


def test_http_lookup(monkeypatch):
    seen = {}

    class Resp(io.BytesIO):
        def __enter__(self):
            return self

        def __exit__(self, *a):
            return False

    def fake_urlopen(req, timeout):
        seen["url"], seen["body"], seen["headers"] = req.full_url, req.data, dict(req.headers)
        values = json.loads(req.data)["identifiers"]
        return Resp(json.dumps({"pseudonyms": ["p" + v for v in values]}).encode())

    monkeypatch.setattr(L.urllib.request, "urlopen", fake_urlopen)
    lk = L.HttpJsonLookup("https://svc.example/Dev/pseudonymization", L.PSEUDONYMIZE_CODEC,
                          api_key="k123", deterministic=True)
    assert lk(["a", "b"]) == ["pa", "pb"]
    assert seen["url"].endswith("?deterministic=true")
    assert seen["headers"]["X-api-key"] == "k123"
    assert "k123" not in repr(lk)

    def throttled(req, timeout):
        raise urllib.error.HTTPError(req.full_url, 429, "slow down", {}, None)

    monkeypatch.setattr(L.urllib.request, "urlopen", throttled)
    with pytest.raises(L.RetryableError):
        lk(["a"])


def test_service_sql_function(spark):
    register_lookup_function(spark, "svc_pseudonymize", PrefixLookup(),
                             L.LookupPolicy(batch_size=2))
    spark.createDataFrame([(["a", None, "b"],), (None,), ([],)], "arr array<string>") \
        .createOrReplaceTempView("arrays_svc")
    got = [r.a for r in spark.sql("SELECT svc_pseudonymize(arr) AS a FROM arrays_svc").collect()]
    assert got == [["p_a", None, "p_b"], None, []]


def test_shuffle_join_splits_hot_value(spark):
    """A mapping too large to broadcast -> sort-merge join; AQE splits a hot value's partition."""
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        t = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey", "o_custkey")
        # A third of the rows share one customer; several map tasks feed the join.
        hot = F.when(F.col("o_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("o_custkey"))
        wide = F.md5(F.col("o_orderkey").cast("string"))  # AQE measures bytes: rows that don't compress to nothing
        df = t.withColumn("o_custkey", hot).withColumn("wide", wide).repartition(8).checkpoint()
        out = L.apply_lookup(df, ["o_custkey"], PrefixLookup(), broadcast_max_bytes=0)
        got = {r[0]: r[1] for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
        want = {r[0]: f"p_{r[1]}" for r in df.collect()}
        assert got == want
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_column_masks_pick_join_per_column(spark):
    # c_big has 2000 distinct values, c_small 3; "1" occurs in both.
    df = spark.range(0, 2000).select(
        F.col("id"), F.col("id").cast("string").alias("c_big"),
        (F.col("id") % 3).cast("string").alias("c_small"),
    )
    values = L.distinct_values(df, ["c_big", "c_small"], with_mask=True)
    masks = {r.value: r.mask for r in values.collect()}
    assert masks["1"] == 3 and masks["1999"] == 1 and len(masks) == 2000
    digest = L.salted_digest(b"salt")
    mapping = L.materialize_mapping(
        L.lookup_mapping(df, ["c_big", "c_small"], PrefixLookup(), with_mask=True), digest)
    sizes = L.column_sizes(mapping, 2)
    assert sizes[1] < 200 < sizes[0]
    out = L.join_mapping(df, ["c_big", "c_small"], mapping, digest=digest, broadcast_max_bytes=200)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only our per-column choice
    try:
        plan = plan_text(out, "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1, plan
    bad = out.where(
        (F.col("c_big") != F.concat(F.lit("p_"), F.col("id").cast("string")))
        | (F.col("c_small") != F.concat(F.lit("p_"), (F.col("id") % 3).cast("string")))
    )
    assert bad.count() == 0 and out.count() == 2000


def test_apply_lookup_rejects_a_stream(spark):
    sdf = spark.readStream.format("rate").load().select(F.col("value").cast("string").alias("v"))
    with pytest.raises(ValueError, match="start_lookup_stream"):
        L.apply_lookup(sdf, "v", PrefixLookup())


def test_large_sides_of_several_columns_shuffle_the_table_once(spark):
    rows = [(i, str(i % 700), None if i % 11 == 0 else str(i % 500), "  " if i % 13 == 0 else f"x{i % 300}")
            for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, a string, b string, c string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = L.apply_lookup(df, ["a", "b", "c"], PrefixLookup(), broadcast_max_bytes=0)
        plan = plan_text(out, "simple")
        # The table is shuffled once, on the (null-safe) tuple of the three keys;
        # the other exchanges move narrow tuples and mapping sides.
        assert plan.count("Exchange hashpartitioning(__cl_tk") >= 1, plan
        assert "Exchange hashpartitioning(__cl_key" not in plan, plan
        got = {r.id: (r.a, r.b, r.c) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want = {i: ("p_" + a, None if b is None else "p_" + b, "" if c == "  " else "p_" + c) for i, a, b, c in rows}
    assert got == want


def test_shuffle_join_warns_without_skew_handling(spark):
    df = spark.createDataFrame([(i, str(i % 50)) for i in range(200)], "id int, v string")
    old = spark.conf.get("spark.sql.adaptive.skewJoin.enabled")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        with pytest.warns(RuntimeWarning, match="skew"):
            out = L.apply_lookup(df, "v", PrefixLookup(), broadcast_max_bytes=0)
        assert out.where(F.col("v") != F.concat(F.lit("p_"), (F.col("id") % 50).cast("string"))).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", old)


def test_null_answers_fail_or_become_null(spark):
    df = spark.createDataFrame([(1, "a"), (2, "xb"), (3, None), (4, " ")], "id int, v string")
    with pytest.raises(Exception, match="null"):
        L.apply_lookup(df, "v", NullLookup()).collect()
    out = L.apply_lookup(df, "v", NullLookup(), policy=L.LookupPolicy(null_answers="null")).collect()
    assert {r.id: r.v for r in out} == {1: "p_a", 2: None, 3: None, 4: ""}


def test_value_without_an_answer_fails(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    mapping = spark.createDataFrame([("a", "p_a")], "value string, mapped string")
    with pytest.raises(Exception, match="no answer"):
        L.join_mapping(df, ["v"], mapping).collect()
    assert [r.v for r in L.join_mapping(df, ["v"], mapping).where("id = 1").collect()] == ["p_a"]


def stored(spark):
    import os

    base = scratch_path(spark, "x").rsplit("/", 1)[0].removeprefix("file:")
    return set(os.listdir(base)) if os.path.isdir(base) else set()


def test_scratch_scope_leaves_nothing_and_stores_no_value(spark, kr):
    from cloakline.operators.table import pseudonymize

    df = spark.createDataFrame([(i, f"secret{i % 5}") for i in range(50)], "id int, v string")
    before = stored(spark)
    with scratch_scope(spark) as created:
        a = L.apply_lookup(df.distinct(), "v", PrefixLookup())
        b = pseudonymize(df, "v", kr, deterministic=False, linkage="run")
        assert a.count() == b.count() == 50 and b.select("v").distinct().count() == 5
        mappings = [p for p in created if "mapping-" in p]
        assert len(mappings) == 2 and len(created) == 3
        for p in mappings:
            kept = spark.read.parquet(p)
            assert dict(kept.dtypes)["value"] == "binary"
            assert not any(b"secret" in bytes(r.value) for r in kept.collect())
    assert stored(spark) == before


def test_sum_of_broadcasts_is_bounded(spark):
    df = spark.range(0, 500).select("id", *[F.concat(F.lit(c), F.col("id") % 100).alias(c) for c in "abcd"])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = L.apply_lookup(df, list("abcd"), PrefixLookup(), broadcast_max_bytes=9000)
        assert plan_text(out, "simple").count("BroadcastHashJoin") == 2
        assert out.where("a <> concat('p_a', id % 100) OR d <> concat('p_d', id % 100)").isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_service_function_is_called_once_under_a_filter(spark):
    register_lookup_function(spark, "svc_once", PrefixLookup())
    spark.createDataFrame([("a",), ("b",)], "v string").createOrReplaceTempView("svc_rows")
    q = spark.sql("SELECT a[0] AS x FROM (SELECT svc_once(array(v)) AS a FROM svc_rows) WHERE a[0] = 'p_A' OR a[0] = 'p_b'")
    assert plan_text(q, "simple").count("ArrowEvalPython") == 1
    assert [r.x for r in q.collect()] == ["p_b"]


def test_service_function_calls_span_arrays():
    from cloakline.functions.sql import _answers

    arrays = [["a"] * 3, None, [], [None, "b"], ["c"] * 7]
    got = list(_answers(iter(arrays), SizeLookup(), L.LookupPolicy(batch_size=4)))
    assert got == [["4"] * 3, None, [], [None, "4"], ["4"] * 4 + ["3"] * 3]


def test_full_calls_deal_values_in_lots(spark):
    # Several callers, and no call but one is smaller than it may be.
    df = spark.range(0, 1003, 1, 7).select(F.when(F.col("id") < 1001, F.col("id")).alias("v"), (F.col("id") % 5).alias("w"))
    sent = L.lookup_mapping(df, ["v", "w"], SizeLookup(), policy=L.LookupPolicy(batch_size=100), partitions=4, full_calls=True)
    rows = sent.select("value", F.col("mapped").cast("int").alias("n"), F.spark_partition_id().alias("p")).collect()
    assert sorted(int(r["value"]) for r in rows) == list(range(1001))
    assert sorted(r["n"] for r in rows) == [1] + [100] * 1000 and len({r["p"] for r in rows}) > 1
    assert L.lookup_mapping(df.limit(0), "v", SizeLookup(), partitions=2, full_calls=True).count() == 0
    with pytest.raises(ValueError):
        L.lookup_mapping(df, "v", SizeLookup(), full_calls=True)
