"""Edge inputs: empty tables and arrays, one group of 100,000 values."""

from pyspark.sql import functions as F

from cloakline.functions.sql import register_functions
from cloakline.operators.grouping import group_reidentify
from cloakline.operators.lookup import apply_lookup
from cloakline.operators.table import pseudonymize, reidentify
from cloakline.plans.registered import PrefixLookup


def test_empty_table_every_strategy(spark, kr):
    empty = spark.createDataFrame([], "id long, v string, n long")
    for strategy in ("distinct", "row"):
        p = pseudonymize(empty, ["v", "n"], kr, strategy=strategy)
        assert p.columns == empty.columns and p.count() == 0
        assert reidentify(p, ["v", "n"], kr, strategy=strategy).count() == 0
    assert pseudonymize(empty, "v", kr, deterministic=False, linkage="run").count() == 0
    assert apply_lookup(empty, ["v", "n"], PrefixLookup()).count() == 0
    assert group_reidentify(empty, "id", "v", kr).count() == 0


def test_empty_and_null_arrays_in_sql(spark, kr):
    register_functions(spark, kr)
    row = spark.sql(
        "SELECT pseudonymize(CAST(array() AS ARRAY<STRING>), 'true') AS e, "
        "reidentify(CAST(array() AS ARRAY<STRING>)) AS r, "
        "reidentify(pseudonymize(array('a', NULL, ''), 'true')) AS m, "
        "pseudonymize(CAST(NULL AS ARRAY<STRING>), 'true') AS n"
    ).first()
    assert row.e == [] and row.r == [] and row.m == ["a", None, ""] and row.n is None


def test_one_group_of_100k_values(spark, kr):
    df = spark.range(0, 100_000, numPartitions=8).select(
        F.lit("31").alias("dept_id"), (F.col("id") % 10_000).cast("string").alias("vin")
    )
    p = pseudonymize(df, "vin", kr)
    out = group_reidentify(p, "dept_id", "vin", kr, batch_size=900)
    sizes = out.select(F.size("vin").alias("n"), F.aggregate(
        "vin", F.lit(0).cast("long"), lambda acc, x: acc + x.cast("long")).alias("s"))
    agg = sizes.agg(F.sum("n").alias("n"), F.max("n").alias("mx"), F.count(F.lit(1)).alias("arrays"),
                    F.sum("s").alias("s")).first()
    assert agg.n == 100_000 and agg.mx <= 900 and agg.arrays >= 112
    assert agg.s == 10 * sum(range(10_000))


def test_run_linkage_rejects_a_stream(spark, kr):
    import pytest

    sdf = spark.readStream.format("rate").load().select(F.col("value").cast("string").alias("v"))
    with pytest.raises(ValueError, match="linkage"):
        pseudonymize(sdf, "v", kr, deterministic=False, linkage="run")
    assert pseudonymize(sdf, "v", kr, deterministic=False).isStreaming  # row linkage is a projection


def test_prefix_renames(spark):
    import pytest

    from cloakline.operators.table import rename_with_prefix, strip_prefix

    df = spark.createDataFrame([(1, "a")], "id int, vin string")
    named = rename_with_prefix(df, ["vin"])
    assert named.columns == ["id", "s_vin"]
    assert strip_prefix(named, ["s_vin"]).columns == ["id", "vin"]
    with pytest.raises(ValueError):
        strip_prefix(df, ["vin"])


def test_python_blank_rule():
    from cloakline.operators.lookup import is_blank

    assert is_blank("") and is_blank(" \t\n") and is_blank("\xa0\u3000\x1c")
    assert not is_blank(" a ") and not is_blank("\u200b")
