import pytest

from cloakline import jobs
from cloakline.keys import KeySource, Keyring
from cloakline.session import scratch_path
from cloakline.sources.datagen import path_bytes, rows_for_megabytes, synthetic_batch, synthetic_event_stream

REFERENCE_BATCH_YAML = """
repartition_no: 1
aws_region: region-1
endpoint_url: https://example.invalid/Dev/pseudonymization
secret_name: hex:00112233445566778899aabbccddeeff
determinism: True
input_s3_path: s3://bucket/input/
output_bucket_name: my-output-bucket
input_column: vin
db_name: batch_db
table_name: pseudo_table
"""


def test_batch_config_from_reference_keys():
    job = jobs.BatchJob.from_yaml(REFERENCE_BATCH_YAML)
    assert job.input_path == "s3://bucket/input/" and job.input_columns == ("vin",)
    assert job.output_root == "s3://my-output-bucket" and job.determinism is True
    over = jobs.BatchJob.from_yaml(REFERENCE_BATCH_YAML, input_column=["a", "b"], mode="service")
    assert over.input_columns == ("a", "b") and over.mode == "service"


GLUE_YAML = """
repartition_no: 1
aws_region: somewhere-2
endpoint_url: gateway.invalid/test/[to be filled in]
secret_name: name-of-a-secret
determinism: True
input_loc: s3://cars/in/2024.csv
output_loc: s3://cars/out/
input_column: VIN
"""
STREAM_YAML = """
repartition_no: 1
kinesis_stream_name: " "
kinesis_endpoint_url: " "
kinesis_region: " "
endpoint_url: " "
secret_name: " "
determinism: True
output_bucket_name: " "
input_column: vin
db_name: cars_live
table_name: pseudo_table
"""


def test_the_other_config_shapes():
    job = jobs.CsvJob.from_yaml(GLUE_YAML)
    assert job.input_columns == ("VIN",) and job.action == "pseudonymize"
    job = jobs.StreamJob.from_yaml(STREAM_YAML, output_bucket_name="out", kinesis_stream_name="s1")
    assert (job.output_root, job.stream_name, job.checkpoint, job.input_path) == ("s3://out", "s1", None, None)
    assert job.schema == jobs.DEFAULT_STREAM_SCHEMA and job.endpoint_url is None
    assert jobs.StreamJob.from_yaml(STREAM_YAML, output_root="out").output_root == "out"


def test_strict_settings():
    base = {"input_loc": "a", "output_loc": "b", "input_column": "v"}
    assert jobs.CsvJob.from_dict({**base, "determinism": "False"}).determinism is False
    with pytest.raises(ValueError, match="determinism"):
        jobs.CsvJob.from_dict({**base, "determinism": "maybe"})
    with pytest.raises(ValueError, match="determinsm"):
        jobs.CsvJob.from_dict({**base, "determinsm": True})
    url = "https://x.invalid/Dev/reidentification"
    assert jobs.CsvJob.from_dict({**base, "endpoint_url": url, "mode": "service"}).action == "reidentify"
    with pytest.raises(ValueError, match="contradicts"):
        jobs.CsvJob.from_dict({**base, "endpoint_url": url, "action": "pseudonymize"})
    with pytest.raises(ValueError, match="names no known action"):
        jobs.CsvJob.from_dict({**base, "endpoint_url": "https://x.invalid/Dev/<ACTION>", "mode": "service"})


def test_named_secret_is_resolved_once(spark, monkeypatch):
    asked = []

    def resolver(name):
        asked.append(name)
        return "k" * 32

    df = spark.createDataFrame([("V1",)], "vin string")
    base = {"input_loc": "-", "output_loc": "-", "input_column": "vin", "secret_name": "my-secret"}
    out = jobs.transform(df, jobs.CsvJob.from_dict(base), resolver=resolver)
    assert out.first().s_vin and asked == ["my-secret"]
    job = jobs.CsvJob.from_dict({**base, "mode": "service", "endpoint_url": "https://x.invalid/Dev/pseudonymization"})
    seen = {}
    monkeypatch.setattr(jobs, "apply_lookup", lambda df, cols, lookup, **kw: seen.update(lookup._headers) or df)
    jobs.transform(df, job, resolver=resolver)
    assert seen["x-api-key"] == "k" * 32
    with pytest.raises(ValueError, match="resolver"):
        jobs.transform(df, job)


def test_config_validation():
    with pytest.raises(ValueError, match="missing"):
        jobs.BatchJob.from_dict({"input_s3_path": "x"})
    with pytest.raises(ValueError, match="action"):
        jobs.CsvJob.from_dict({"input_loc": "a", "output_loc": "b", "input_column": "v", "action": "other"})
    with pytest.raises(ValueError, match="endpoint"):
        jobs.CsvJob.from_dict({"input_loc": "a", "output_loc": "b", "input_column": "v", "mode": "service"})


def test_key_sources(tmp_path, monkeypatch):
    monkeypatch.setenv("CL_TEST_KEY", "aa" * 32)
    (tmp_path / "k").write_text("bb" * 32)
    a = Keyring.from_source(jobs.key_source("env:CL_TEST_KEY"))
    b = Keyring.from_source(jobs.key_source(f"file:{tmp_path / 'k'}"))
    c = Keyring.from_source(jobs.key_source("hex:" + "aa" * 32))
    assert a == c and a != b
    assert "aa" not in repr(a) and "aa" not in repr(KeySource.from_hex("aa" * 32))
    with pytest.raises(ValueError):
        jobs.key_source("vault:x")
    with pytest.raises(ValueError):
        KeySource.from_bytes(b"short").resolve()


def test_run_csv_and_reidentify_job(spark, kr):
    base = scratch_path(spark, "t-job")
    spark.createDataFrame([("V1", "d"), ("V2", "e")], "VIN string, d string") \
        .write.option("header", True).csv(f"{base}/in")
    job = jobs.CsvJob.from_dict({"input_loc": f"{base}/in", "output_loc": f"{base}/out", "input_column": "VIN"})
    preview = jobs.run_csv_batch(spark, job, keyring=kr)
    assert preview.columns == ["s_VIN", "d"] and preview.count() == 2
    back = jobs.transform(spark.read.parquet(f"{base}/out"),
                          jobs.CsvJob.from_dict({"input_loc": "-", "output_loc": "-", "input_column": "s_VIN",
                                                 "action": "reidentify"}), keyring=kr)
    assert sorted(r.VIN for r in back.collect()) == ["V1", "V2"]


def test_synthetic_batch(spark):
    df = synthetic_batch(spark, 5000, partitions=4)
    assert df.columns == ["dept_id", "vin", "example_ts"] and df.count() == 5000
    stats = df.selectExpr("max(int(dept_id)) d", "max(int(vin)) v", "min(int(vin)) m").first()
    assert stats.d <= 49 and 0 <= stats.m and stats.v <= 9999
    assert len(df.first().example_ts) == 26


def test_synthetic_event_stream(spark):
    sdf = synthetic_event_stream(spark, rows_per_second=50, partitions=2)
    q = sdf.writeStream.format("memory").queryName("synthetic_events").start()
    try:
        q.processAllAvailable()
        import time
        time.sleep(2)
        q.processAllAvailable()
    finally:
        q.stop()
    rows = spark.table("synthetic_events").collect()
    assert rows and all(set(__import__("json").loads(r.value)) == {"dept_id", "vin", "example_ts"} for r in rows)


def test_action_from_url_and_keep_original(spark, kr):
    assert jobs.action_from_url("https://x.invalid/Dev/pseudonymization?deterministic=true") == "pseudonymize"
    assert jobs.action_from_url("https://x.invalid/Dev/reidentification/") == "reidentify"
    with pytest.raises(ValueError):
        jobs.action_from_url("https://x.invalid/Dev/other")
    df = spark.createDataFrame([("V1",)], "vin string")
    job = jobs.CsvJob.from_dict({"input_loc": "-", "output_loc": "-", "input_column": "vin"})
    out = jobs.transform(df, job, keyring=kr, keep_original=True)
    assert out.columns == ["s_vin", "real_vin"] and out.first().real_vin == "V1"


def test_rows_for_megabytes(spark):
    from cloakline.session import scratch_path

    rows = rows_for_megabytes(spark, 1.0, sample_rows=20_000)
    path = scratch_path(spark, "mb")
    synthetic_batch(spark, rows, partitions=1).write.parquet(path)
    assert 0.5 * 1_048_576 < path_bytes(spark, path) < 2 * 1_048_576


def test_config_from_json_without_yaml(monkeypatch):
    import builtins
    import json

    real_import = builtins.__import__

    def no_yaml(name, *args, **kwargs):
        if name == "yaml":
            raise ImportError("no yaml")
        return real_import(name, *args, **kwargs)

    monkeypatch.setattr(builtins, "__import__", no_yaml)
    text = json.dumps({"input_s3_path": "s3://b/in/", "input_column": "vin", "output_bucket_name": "o",
                       "db_name": "d", "table_name": "t"})
    assert jobs.BatchJob.from_yaml(text).input_columns == ("vin",)
    with pytest.raises(ImportError, match="PyYAML"):
        jobs.BatchJob.from_yaml(REFERENCE_BATCH_YAML)
