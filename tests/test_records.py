"""Record folders: committed appends, and a stream of them."""

import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from cloakline import jobs
from cloakline.sources import records as R
from cloakline.streaming.stream import start_records_sink


def some(spark, a, b, parts=3):
    return spark.range(a, b, 1, parts).select("id", F.concat(F.lit("v"), "id").alias("v"))


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def failing(df, at):
    stop = F.raise_error(F.lit("boom")).cast("long")
    return df.withColumn("id", F.when(F.col("id") == at, stop).otherwise(F.col("id")))


def test_an_id_is_committed_once(spark, tmp_path):
    path = str(tmp_path / "r")
    assert R.write_records(some(spark, 0, 10), path, "a")
    assert not R.write_records(some(spark, 0, 10), path, "a")
    # A writer that did not look first finds the id when it commits, and takes its files back.
    some(spark, 0, 10).write.format("records").mode("append").option("commitId", "a").save(path)
    assert ids(R.read_records(spark, path)) == list(range(10)) and not R.RecordFolder(path).unlisted()
    assert R.write_records(some(spark, 10, 12), path, "b")
    assert ids(R.read_records(spark, path)) == ids(spark.read.format("records").load(path)) == list(range(12))
    assert [e["id"] for e in R.RecordFolder(path).entries()] == ["a", "b"]
    R.write_records(some(spark, 0, 0), path, "empty")
    assert ids(R.read_records(spark, path)) == list(range(12)) and R.RecordFolder(path).last() == 2


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "r")
    R.write_records(some(spark, 0, 5), path, "a")
    with pytest.raises(SparkRuntimeException, match="boom"):
        R.write_records(failing(some(spark, 5, 50, 6), 49), path, "b")
    assert ids(R.read_records(spark, path)) == list(range(5))
    R.write_records(some(spark, 5, 50, 6), path, "b")
    R.RecordFolder(path).vacuum(0)  # tasks that outlived the abort
    assert not R.RecordFolder(path).unlisted() and len(R.RecordFolder(path).entries()) == 2
    assert ids(R.read_records(spark, path)) == list(range(50))


def test_files_of_a_crashed_write_are_unseen_and_swept(spark, tmp_path):
    path = str(tmp_path / "r")
    R.write_records(some(spark, 0, 5), path, "a")
    folder = R.RecordFolder(path)
    with open(tmp_path / "r" / "data" / "crashed.parquet", "w") as f:
        f.write("half a file")
    open(tmp_path / "r" / "_log" / ".draft", "w").close()
    assert ids(R.read_records(spark, path)) == list(range(5)) == ids(spark.read.format("records").load(path))
    assert folder.vacuum(older_than_s=3600) == 0 and folder.vacuum(older_than_s=0) == 1
    assert ids(R.read_records(spark, path)) == list(range(5))


def test_commits_that_race_take_different_numbers(tmp_path):
    folder, other = R.RecordFolder(str(tmp_path / "r")), R.RecordFolder(f"file:{tmp_path / 'r'}")
    schema = {"type": "struct", "fields": []}
    real, once = folder._place, []

    def late(draft, target):
        if not once:  # another writer is faster
            once.append(other.publish("theirs", [], schema))
        return real(draft, target)

    folder._place = late
    assert folder.publish("mine", [], schema) == 1 and once == [0]
    assert folder.publish("theirs", [], schema) is None
    assert [e["id"] for e in folder.entries()] == ["theirs", "mine"]
    assert not [n for n in os.listdir(tmp_path / "r" / "_log") if n.startswith(".")]


def test_other_file_systems_go_by_rename(tmp_path):
    folder = R.RecordFolder(str(tmp_path / "r"))
    folder.local = False
    assert [folder.publish(x, [], {}) for x in "aba"] == [0, 1, None]


def test_columns_must_fit(spark, tmp_path):
    path = str(tmp_path / "r")
    R.write_records(some(spark, 0, 5), path, "a")
    with pytest.raises(Exception, match="holds struct"):
        R.write_records(spark.range(3), path, "b")
    with pytest.raises(Exception, match="append only"):
        some(spark, 0, 1).write.format("records").mode("overwrite").save(path)
    with pytest.raises(ValueError, match="nothing committed"):
        R.read_records(spark, str(tmp_path / "none"))


def test_filters_and_columns_reach_the_files(spark, tmp_path):
    path = str(tmp_path / "r")
    R.write_records(some(spark, 0, 100), path, "a")
    plan = R.read_records(spark, path).where("id = 3").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,3)]" in plan and "ReadSchema: struct<id:bigint>" in plan


def drain(spark, path, out, start):
    q = R.stream_records(spark, path, start=start).writeStream.format("parquet").option(
        "checkpointLocation", f"{out}-ck").trigger(availableNow=True).start(out)
    q.awaitTermination()
    return ids(spark.read.schema("id long").parquet(out))


def test_stream_positions_and_restarts(spark, tmp_path):
    path = str(tmp_path / "r")
    R.write_records(some(spark, 0, 3), path, "a")
    R.write_records(some(spark, 3, 6), path, "b")
    log = tmp_path / "r" / "_log" / f"{0:020d}.json"
    entry = json.loads(log.read_text())
    log.write_text(json.dumps({**entry, "time_ms": entry["time_ms"] - 3_600_000}))
    ago = datetime.now(timezone.utc) - timedelta(minutes=30)
    starts = {"earliest": 0, "TRIM_HORIZON": 0, "latest": 6, "LATEST": 6, "1": 3, "2": 6, ago.isoformat(): 3,
              "2001-01-01": 0}
    for i, (start, first) in enumerate(starts.items()):
        assert drain(spark, path, str(tmp_path / f"o{i}"), start) == list(range(first, 6))
    R.write_records(some(spark, 6, 9), path, "c")
    for i, (start, first) in enumerate(starts.items()):  # a restart goes on, whatever the option says
        assert drain(spark, path, str(tmp_path / f"o{i}"), "earliest" if i % 2 else start) == list(range(first, 9))
    with pytest.raises(ValueError, match="start position"):
        R.RecordFolder(path).start("soon")


def test_stream_sink_commits_each_batch_once(spark, tmp_path):
    path, out = str(tmp_path / "r"), str(tmp_path / "out")
    R.write_records(some(spark, 0, 3), path, "a")
    for last in (3, 7):
        q = start_records_sink(R.stream_records(spark, path), out, str(tmp_path / "ck"), "w", available_now=True)
        q.awaitTermination()
        assert ids(R.read_records(spark, out)) == list(range(last))
        R.write_records(some(spark, last, 7), path, f"b{last}")
    # A lost checkpoint entry replays the last batch: its commit is there already.
    commits = tmp_path / "ck" / "commits"
    newest = max((p for p in os.listdir(commits) if p.isdigit()), key=int)
    for name in (newest, f".{newest}.crc"):
        if (commits / name).exists():
            os.remove(commits / name)
    start_records_sink(R.stream_records(spark, path), out, str(tmp_path / "ck"), "w", available_now=True).awaitTermination()
    assert ids(R.read_records(spark, out)) == list(range(7)) and not R.RecordFolder(out).unlisted()
    with pytest.raises(Exception, match="writer name"):
        R.stream_records(spark, path).writeStream.format("records").option(
            "checkpointLocation", str(tmp_path / "ck2")).trigger(availableNow=True).start(out).awaitTermination()


def test_jobs_with_a_commit_id(spark, kr, tmp_path):
    spark.range(20).selectExpr("id", "'n' || id AS vin").write.option("header", True).csv(str(tmp_path / "csv"))
    conf = {"input_loc": str(tmp_path / "csv"), "output_loc": str(tmp_path / "out"), "input_column": "vin"}
    for commit in ("d1", "d1", "d2"):
        shown = jobs.run_csv_batch(spark, jobs.CsvJob.from_dict(conf, commit_id=commit), keyring=kr)
    assert shown.count() == 5 and R.read_records(spark, str(tmp_path / "out")).count() == 40

    class Never:
        def __call__(self, values):
            raise AssertionError("asked")

    job = jobs.CsvJob.from_dict({**conf, "mode": "service", "endpoint_url": "https://x.invalid/y/pseudonymization"},
                                commit_id="d2")
    assert jobs.run_csv_batch(spark, job, lookup=Never()).count() == 5
