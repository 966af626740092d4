import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cloakline.functions.sql import register_functions
from cloakline.operators.grouping import group_arrays, n_per_group
from cloakline.operators.table import pseudonymize, reidentify
from cloakline.plans import registered
from cloakline.plans.inspect import exchanges, is_deterministic, leaks_key, plan_text, python_nodes, shuffles

CUSTOMER = "/root/testdata/sf0.001/customer.parquet"


def test_row_plan_is_one_projection(spark, kr):
    df = spark.read.parquet(CUSTOMER)
    p = pseudonymize(df, "c_name", kr, strategy="row", min_partitions=None)
    assert python_nodes(p) == []
    assert exchanges(p) == []
    assert not leaks_key(p, kr)
    r = reidentify(p, "c_name", kr, strategy="row", min_partitions=None)
    assert shuffles(r) == [] and not leaks_key(r, kr)


def test_filter_and_pruning_reach_scan(spark, kr):
    df = spark.read.parquet(CUSTOMER)
    p = pseudonymize(df, "c_name", kr, strategy="row", min_partitions=None)
    text = plan_text(p.where(F.col("c_nationkey") == 3).select("c_name"), "formatted")
    assert "PushedFilters: [IsNotNull(c_nationkey), EqualTo(c_nationkey,3)]" in text
    assert "ReadSchema: struct<c_name:string,c_nationkey:int>" in text


def test_distinct_plan_is_lazy_and_scans_once(spark, kr):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    started = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    p = pseudonymize(df, ["l_suppkey", "l_partkey", "l_orderkey"], kr, strategy="distinct")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == started  # no job at definition
    text = plan_text(p, "simple")
    assert "RoundRobinPartitioning" not in text and not leaks_key(p, kr)
    # Each side: one scan and an inline for all three columns, the aggregate shared by exchange reuse.
    assert text.count("Generate inline") == 3 and text.count("FileScan") == 4
    p.collect()
    assert p._jdf.queryExecution().executedPlan().toString().count("ReusedExchange") >= 2
    row = pseudonymize(df, ["l_suppkey", "l_partkey", "l_orderkey"], kr)
    assert row.exceptAll(p).isEmpty() and p.exceptAll(row).isEmpty()


def test_strategies_fail_on_the_same_rows(spark, kr):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, " ")], "id int, v string")
    bad = pseudonymize(df, "v", kr).withColumn("v", F.when(F.col("id") == 2, F.lit("AAAA")).otherwise(F.col("v")))
    bad = bad.checkpoint()
    for strategy in ("row", "distinct"):
        back = reidentify(bad, "v", kr, strategy=strategy)
        assert sorted((r.id, r.v) for r in back.where("id <> 2").collect()) == [(1, "a"), (3, None), (4, "")]
        with pytest.raises(Exception):
            back.collect()
        got = {r.id: r.v for r in reidentify(bad, "v", kr, strategy=strategy, on_error="null").collect()}
        assert got == {1: "a", 2: None, 3: None, 4: ""}
    mixed = reidentify(bad.withColumn("w", F.col("v")), ["v", "w"], kr, strategy={"v": "distinct"}, on_error="null")
    assert all(r.v == r.w for r in mixed.collect())
    with pytest.raises(ValueError, match="strategy"):
        pseudonymize(df, "v", kr, strategy="auto")


def test_distinct_refuses_inputs_that_may_differ(spark, kr):
    df = spark.read.parquet(CUSTOMER)
    for other in (df.limit(5), df.dropDuplicates(["c_nationkey"]), df.withColumn("r", F.rand()),
                  df.withColumn("n", F.row_number().over(Window.orderBy("c_nationkey")))):
        assert not is_deterministic(other)
        with pytest.raises(ValueError, match="twice"):
            pseudonymize(other, "c_name", kr, strategy="distinct")
    assert is_deterministic(df.groupBy("c_nationkey").count())


def test_sql_functions_stay_projections(spark, kr):
    register_functions(spark, kr)
    spark.read.parquet(CUSTOMER).createOrReplaceTempView("customer_plan")
    q = spark.sql("SELECT reidentify(pseudonymize(array(c_name), 'true')) AS a FROM customer_plan")
    assert exchanges(q) == [] and python_nodes(q) == []
    assert "Join" not in plan_text(q, "simple")
    assert not leaks_key(q, kr)


def test_top_n_has_partial_group_limit(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    text = plan_text(n_per_group(df, "event_type", "event_id", 3), "simple")
    assert "WindowGroupLimit" in text and "Partial" in text


def test_group_arrays_has_no_window_over_groups(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    text = plan_text(group_arrays(df, "event_type", "user_id", batch_size=10), "simple")
    assert "Window" not in text


def test_group_arrays_one_shuffle_after_local_sort(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    g = group_arrays(df, "l_returnflag", "l_suppkey", batch_size=100)
    sh = shuffles(g)
    assert len(sh) == 1 and "l_returnflag" in sh[0] and "chunk" in sh[0], sh
    text = plan_text(g, "simple")
    # The sort is within partitions (global=false) and sits below the only exchange.
    sort_line = next(line for line in text.splitlines() if "Sort [" in line)
    assert "false" in sort_line
    assert text.index("Exchange") < text.index(sort_line)
    assert python_nodes(g) == []


def test_has_exchange(spark):
    from cloakline.plans.inspect import has_exchange

    df = spark.read.parquet(CUSTOMER)
    assert not has_exchange(df.where("c_nationkey = 3"))
    assert has_exchange(df.groupBy("c_nationkey").count())
    assert not has_exchange(df.withColumnRenamed("c_name", "StockExchangeId").where("StockExchangeId > ''"))


def test_counts_seal_repeated_identifiers_once(spark):
    # Parts and suppliers are sealed as distinct values and joined; only the order keys by row.
    text = plan_text(registered.injective_counts(spark, "/root/testdata/sf0.001"))
    assert text.count("Join") >= 2
