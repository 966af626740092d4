import json
import os

from pyspark.sql import functions as F

from cloakline.operators.table import pseudonymize, reidentify
from cloakline.session import scratch_path
from cloakline.sources import io
from cloakline.streaming import stream

SCHEMA = "dept_id string, vin string, example_ts string"


def _write_lines(path, lines):
    import os

    local = path.replace("file:", "")
    os.makedirs(local, exist_ok=True)
    with open(f"{local}/part-0.json", "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_csv_reads_all_strings(spark):
    base = scratch_path(spark, "t-csv")
    spark.createDataFrame([(1, "A", 2.5)], "VIN int, b string, c double").write.option("header", True).csv(base)
    df = io.read_csv(spark, base)
    assert df.dtypes == [("VIN", "string"), ("b", "string"), ("c", "string")]


def test_json_lines_with_corrupt_record(spark):
    base = scratch_path(spark, "t-json")
    _write_lines(base, [json.dumps({"dept_id": "1", "vin": "7", "example_ts": "t"}), '{"dept_id": "2", "vin'])
    df = io.read_json_lines(spark, base, SCHEMA)
    rows = sorted(df.collect(), key=lambda r: str(r.dept_id))
    assert rows[0].vin == "7" and rows[0]._corrupt_record is None
    assert rows[1].dept_id is None and rows[1]._corrupt_record.startswith('{"dept_id": "2"')


def test_table_ddl_and_append_by_name(spark, kr):
    base = scratch_path(spark, "t-table")
    db = "t_" + base.rsplit("-", 1)[-1]
    loc = io.table_location(base, "batch", db, "pseudo_table")
    assert loc.endswith(f"/batch/warehouse/{db}/pseudo_table")
    src = spark.createDataFrame([("31", "V1", "ts")], "dept_id string, vin string, example_ts string")
    out = pseudonymize(src, "vin", kr).withColumnRenamed("vin", "s_vin")
    io.ensure_database(spark, db, location=loc.rsplit("/", 1)[0])
    name = io.ensure_table(spark, db, "pseudo_table", out.schema, location=loc)
    io.append_to_table(out.select("example_ts", "s_vin", "dept_id"), db, "pseudo_table")  # other order
    io.append_to_table(out, db, "pseudo_table")
    got = spark.table(name)
    assert got.columns == ["dept_id", "s_vin", "example_ts"]
    assert got.count() == 2 and got.select("dept_id").distinct().first().dept_id == "31"
    assert io.preview(got, 1).count() == 1


def test_stream_roundtrip_and_restart_no_duplicates(spark, kr):
    base = scratch_path(spark, "t-stream")
    _write_lines(f"{base}/in/a", [json.dumps({"dept_id": str(i % 3), "vin": str(i), "example_ts": "t"})
                                  for i in range(30)])
    def run():
        raw = spark.readStream.format("text").load(f"{base}/in/*")
        good, _ = stream.split_rejects(stream.parse_json(raw, SCHEMA))
        out = stream.observe_counts(pseudonymize(good, "vin", kr), "m", ["vin"])
        q = stream.start_file_sink(out, f"{base}/out", f"{base}/ck", available_now=True)
        q.awaitTermination()
        return q
    q = run()
    metrics = q.lastProgress["observedMetrics"]["m"]
    assert metrics["rows"] == 30 and metrics["vin_nulls"] == 0
    run()  # restart from the checkpoint: nothing new, nothing repeated
    _write_lines(f"{base}/in/b", [json.dumps({"dept_id": "9", "vin": "99", "example_ts": "t"})])
    run()
    out = spark.read.parquet(f"{base}/out")
    assert out.count() == 31
    back = reidentify(out, "vin", kr)
    assert sorted(int(r.vin) for r in back.collect()) == list(range(30)) + [99]


def test_batch_sink_is_idempotent_and_splits_rejects(spark):
    base = scratch_path(spark, "t-batch")
    rows = spark.createDataFrame([('{"dept_id":"1","vin":"a","example_ts":"t"}',), ('{"bad',)], "value string")
    parsed = stream.parse_json(rows, SCHEMA)
    fn = stream.per_batch(lambda df: df.withColumn("vin", F.upper("vin")), f"{base}/out",
                          reject_path=f"{base}/rej")
    fn(parsed, 0)
    fn(parsed, 0)  # replay of the same batch replaces its folder
    fn(parsed, 1)
    out = spark.read.parquet(f"{base}/out")
    assert out.count() == 2 and {r.vin for r in out.collect()} == {"A"}
    assert spark.read.parquet(f"{base}/rej").count() == 2
    fn(parsed.limit(0), 2)  # empty batches write nothing


def test_lookup_stream(spark):
    from cloakline.plans.registered import PrefixLookup

    base = scratch_path(spark, "t-lstream")
    _write_lines(f"{base}/in", [json.dumps({"dept_id": "1", "vin": str(i % 4), "example_ts": "t"})
                                for i in range(12)])
    raw = spark.readStream.format("text").load(f"{base}/in")
    scratch = base.rsplit("/", 1)[0]
    mappings = lambda: {n for n in os.listdir(scratch.removeprefix("file:")) if n.startswith("mapping-")}
    before = mappings()
    q = stream.start_lookup_stream(stream.parse_json(raw, SCHEMA).drop("_corrupt_record"), "vin",
                                   PrefixLookup(), f"{base}/out", f"{base}/ck", available_now=True)
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    assert out.count() == 12 and {r.vin for r in out.collect()} == {"p_0", "p_1", "p_2", "p_3"}
    assert mappings() == before  # each batch's mapping table is deleted after its write


def test_stream_to_catalog_table(spark, kr):
    base = scratch_path(spark, "t-tstream")
    _write_lines(f"{base}/in", [json.dumps({"dept_id": "1", "vin": f"V{i}", "example_ts": "t"}) for i in range(20)])
    good, _ = stream.split_rejects(stream.parse_json(spark.readStream.format("text").load(f"{base}/in"), SCHEMA))
    db = "cl_ts_" + base.rsplit("-", 1)[-1]
    io.ensure_database(spark, db, location=f"{base}/db")
    name = io.ensure_table(spark, db, "t", pseudonymize(good, "vin", kr).schema, location=f"{base}/db/t")
    q = stream.start_table_sink(pseudonymize(good, "vin", kr), name, f"{base}/ck", available_now=True)
    q.awaitTermination()
    back = reidentify(spark.table(name), "vin", kr)
    assert sorted(r.vin for r in back.collect()) == sorted(f"V{i}" for i in range(20))


def test_unparsable_records_never_vanish_or_leak(spark, kr):
    import pytest
    from cloakline import jobs
    from cloakline.plans.registered import PrefixLookup

    base = scratch_path(spark, "t-strict")
    _write_lines(f"{base}/in", [json.dumps({"dept_id": "1", "vin": "V1", "example_ts": "t"}), '{"vin":"SECRETVIN","d":'])
    db = "cl_strict_" + base.rsplit("-", 1)[-1]
    common = {"input_path": f"{base}/in", "input_column": "vin", "schema": SCHEMA, "output_root": base, "db_name": db}
    for mode, kw in (("crypto", {"keyring": kr}), ("service", {"lookup": PrefixLookup()})):
        job = jobs.StreamJob.from_dict({
            **common, "mode": mode, "table_name": mode,
            **({"endpoint_url": "https://x.invalid/Dev/pseudonymization"} if mode == "service" else {})})
        with pytest.raises(Exception) as failed:
            jobs.run_stream(spark, job, available_now=True, **kw).awaitTermination()
        assert "does not parse" in str(failed.value) and "SECRETVIN" not in str(failed.value)
        assert spark.table(f"{db}.{mode}").count() == 0
        job = jobs.StreamJob.from_dict({
            **common, "mode": mode, "table_name": mode + "_ok", "reject_path": f"{base}/rej_{mode}",
            **({"endpoint_url": "https://x.invalid/Dev/pseudonymization"} if mode == "service" else {})})
        q = jobs.run_stream(spark, job, available_now=True, metrics="m", **kw)
        q.awaitTermination()
        assert q.lastProgress["observedMetrics"]["m"]["rows"] >= 2
        out = spark.table(f"{db}.{mode}_ok")
        assert "_corrupt_record" not in out.columns and out.count() == 1 and "batch_id" in out.columns
        assert spark.read.parquet(f"{base}/rej_{mode}").first().record.startswith('{"vin":"SECRETVIN"')


def test_a_batch_id_column_is_refused(spark):
    import pytest

    with pytest.raises(ValueError, match="batch_id"):
        stream.write_batch(spark.createDataFrame([(77,)], "batch_id long"), "/unused", 0)


def test_ddl_literals_are_escaped():
    assert io.literal("it's \\ here") == "'it\\'s \\\\ here'"


def test_batches_of_a_table_keep_each_other(spark, tmp_path):
    """Each micro-batch has a partition of its own; a replay replaces that one alone."""
    from pyspark.sql import types as T

    from cloakline.sources import io
    from cloakline.streaming.stream import write_batch_to_table

    db = f"batches_{tmp_path.name}"
    io.ensure_database(spark, db, location=str(tmp_path / db))
    name = io.ensure_table(spark, db, "t", T._parse_datatype_string("b string, a long, batch_id long"),
                           location=str(tmp_path / db / "t"), partitioned_by=("batch_id",))
    for batch, n in ((0, 3), (1, 4), (2, 0), (1, 2)):
        write_batch_to_table(spark.range(n).selectExpr("id AS a", "'x' AS b"), name, batch)
    got = spark.sql(f"SELECT batch_id, count(*) AS n, max(b) AS b FROM {name} GROUP BY batch_id ORDER BY 1").collect()
    assert [tuple(r) for r in got] == [(0, 3, "x"), (1, 2, "x")]
