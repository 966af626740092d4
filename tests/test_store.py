"""The lasting mapping: values asked for once, the stored side never moved."""

import re

import pytest
from pyspark import cloudpickle

import fakes
from cloakline.operators import lookup as L
from cloakline.operators import store as S
from cloakline.plans.registered import PrefixLookup, RefusingLookup
from fakes import NullLookup

cloudpickle.register_pickle_by_value(fakes)


@pytest.fixture
def store(spark, kr, tmp_path):
    s = S.MappingStore(spark, "maps", f"m_{tmp_path.name}", str(tmp_path / "store"), kr, buckets=4)
    yield s
    spark.sql(f"DROP TABLE IF EXISTS {s.name}")


def rows(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v string")


def values_of(df):
    return [r["v"] for r in df.orderBy("id").collect()]


def runs_of(store):
    return {r["run"]: r["n"] for r in store.runs().collect()}


def test_a_later_run_asks_for_new_values_only(spark, store):
    first = S.apply_stored_lookup(rows(spark, "a", "b", None, " ", "a"), "v", PrefixLookup("1_"), store, run="r1")
    assert values_of(first) == ["1_a", "1_b", None, "", "1_a"]
    again = S.apply_stored_lookup(rows(spark, "b", "c", "c"), "v", PrefixLookup("2_"), store, run="r2")
    assert values_of(again) == ["1_b", "2_c", "2_c"]
    none = S.apply_stored_lookup(rows(spark, "a", "c"), "v", PrefixLookup("3_"), store, run="r3")
    assert values_of(none) == ["1_a", "2_c"]
    assert runs_of(store) == {"r1": 2, "r2": 1}
    assert values_of(S.apply_stored_lookup(rows(spark).limit(0), "v", PrefixLookup("4_"), store)) == []


def test_opened_again_in_another_catalog_and_compacted(spark, store, kr):
    S.apply_stored_lookup(rows(spark, "a", "b"), "v", PrefixLookup("1_"), store, run="r1")
    S.apply_stored_lookup(rows(spark, "c"), "v", PrefixLookup("2_"), store, run="r2")
    before = sorted(map(repr, store.stored().collect()))
    store.compact()
    assert sorted(map(repr, store.stored().collect())) == before and runs_of(store) == {"r1": 2, "r2": 1}
    spark.sql(f"DROP TABLE {store.name}")
    opened = S.MappingStore(spark, store.db, store.table, store.location, kr, buckets=4)
    assert runs_of(opened) == {"r1": 2, "r2": 1}
    # A generation that did not finish is not the current one.
    import os
    os.makedirs(f"{store.location}/g2")
    spark.sql(f"DROP TABLE {store.name}")
    assert runs_of(S.MappingStore(spark, store.db, store.table, store.location, kr, buckets=4)) == {"r1": 2, "r2": 1}


def test_two_runs_at_once_agree_afterwards(spark, store):
    asked = spark.createDataFrame([("a", "2_a")], "value string, mapped string")
    keyed = asked.select(store.digest(asked["value"]).alias("key"), "mapped")
    store.append(keyed, "r2")
    store.append(keyed.selectExpr("key", "'1_a' AS mapped"), "r1")
    assert values_of(S.apply_stored_lookup(rows(spark, "a"), "v", PrefixLookup("3_"), store)) == ["1_a"]
    store.compact()
    assert runs_of(store) == {"r1": 1}


def test_no_values_in_the_files(spark, store):
    S.apply_stored_lookup(rows(spark, "a plain name"), "v", PrefixLookup("p_"), store)
    got = spark.table(store.name).collect()[0]
    assert b"plain" not in bytes(got["key"]) and len(got["key"]) == 32


def test_rejects_and_nulls_are_tried_again(spark, store, tmp_path):
    policy = L.LookupPolicy(bad_values="reject", batch_size=2)
    out = S.apply_stored_lookup(rows(spark, "x13", "y", "z"), "v", RefusingLookup(), store, run="r1", policy=policy,
                                reject_path=str(tmp_path / "rejects"))
    assert [v and v.split("_")[-1] for v in values_of(out)] == [None, "y", "z"]
    out = S.apply_stored_lookup(rows(spark, "x13", "y"), "v", PrefixLookup("2_"), store, run="r2")
    assert values_of(out)[0] == "2_x13" and runs_of(store) == {"r1": 2, "r2": 1}
    nulls = L.LookupPolicy(null_answers="null")
    assert values_of(S.apply_stored_lookup(rows(spark, "xa", "b"), "v", NullLookup(), store, policy=nulls)) == [None, "p_b"]
    assert values_of(S.apply_stored_lookup(rows(spark, "xa"), "v", PrefixLookup("3_"), store)) == ["3_xa"]
    with pytest.raises(ValueError, match="go together"):
        S.apply_stored_lookup(rows(spark, "a"), "v", NullLookup(), store, policy=policy)


def test_the_stored_side_has_no_exchange(spark, store):
    S.apply_stored_lookup(rows(spark, *map(str, range(50))), "v", PrefixLookup("p_"), store)
    values = L.distinct_values(rows(spark, "1", "x"), ["v"], with_mask=True, drop_blank=False)
    for df in (store.unseen(values), values.select(store.digest(values["value"]).alias("key")).join(
            store.stored().hint("merge"), "key")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        scan = plan.index("Bucketed: true")
        # From the scan up to its join: no exchange, and none of the table's columns in any.
        indent = lambda line: len(re.match(r"[ :+-]*", line)[0])
        lines = plan[:scan].splitlines()
        depth, above = indent(lines[-1]), []
        for line in reversed(lines[:-1]):
            if indent(line) < depth:
                depth = indent(line)
                above.append(line)
                if "Join" in line:
                    break
        assert "SortMergeJoin" in above[-1] and not any("Exchange" in x for x in above)
        # The values are made distinct before they meet the store.
        assert plan.index("SortMergeJoin") < plan.index("HashAggregate(keys=[value")
        assert "LocalTableScan" in plan  # keys come from a subquery, not as literals
