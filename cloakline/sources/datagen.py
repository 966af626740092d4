"""Synthetic inputs shaped like the reference's generators, built by Spark.

Batch table: ``dept_id`` (string of 0..depts-1), ``vin`` (string of
0..vins-1), ``example_ts`` (ISO-8601 with microseconds), generated by
``spark.range`` across partitions instead of a driver loop. Event stream: the
same columns as JSON text from the ``rate`` source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakline.session import scratch_path

# The reference generators' domains and timestamp format.
BATCH_DEPTS = 50
BATCH_VINS = 10_000
STREAM_DEPTS = 10
STREAM_VINS = 40_000_000
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _columns(ids, depts: int, vins: int, seed: int, ts):
    return [
        F.floor(F.rand(seed) * depts).cast("long").cast("string").alias("dept_id"),
        F.floor(F.rand(seed + 1) * vins).cast("long").cast("string").alias("vin"),
        F.date_format(ts, ISO_FORMAT).alias("example_ts"),
    ]


def synthetic_batch(
    spark: SparkSession,
    rows: int,
    *,
    depts: int = BATCH_DEPTS,
    vins: int = BATCH_VINS,
    seed: int = 42,
    partitions: int | None = None,
    start: str = "2024-01-01 00:00:00",
) -> DataFrame:
    """``rows`` rows of ``(dept_id, vin, example_ts)``; deterministic per seed and partitioning."""
    base = spark.range(0, rows, numPartitions=partitions or spark.sparkContext.defaultParallelism)
    ts = F.to_timestamp(F.lit(start)) + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (F.col("id") % 86_400_000_000) / 1_000_000
    )
    return base.select(*_columns(F.col("id"), depts, vins, seed, ts))


def rows_for_megabytes(spark: SparkSession, target_mb: float, *, sample_rows: int = 200_000,
                       **kwargs) -> int:
    """Rows needed for about ``target_mb`` of Parquet, from a written sample.

    The sample goes to the shared scratch folder and is measured through the
    Hadoop ``FileSystem`` of its path (local, HDFS or object store alike).
    """
    path = scratch_path(spark, "size-sample")
    synthetic_batch(spark, sample_rows, partitions=1, **kwargs).write.mode("overwrite").parquet(path)
    size = path_bytes(spark, path)
    return max(1, int(target_mb * 1_048_576 * sample_rows / max(size, 1)))


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes below ``path`` on its file system."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(hpath).getLength())


def synthetic_event_stream(
    spark: SparkSession,
    rows_per_second: int = 1000,
    *,
    depts: int = STREAM_DEPTS,
    vins: int = STREAM_VINS,
    partitions: int | None = None,
) -> DataFrame:
    """Streaming DataFrame with one JSON record per row in column ``value``."""
    rate = (
        spark.readStream.format("rate")
        .option("rowsPerSecond", rows_per_second)
        .option("numPartitions", partitions or spark.sparkContext.defaultParallelism)
        .load()
    )
    # rand() is not allowed on every stream path; a hash of the counter is stable.
    dept = F.pmod(F.xxhash64(F.col("value"), F.lit(1)), F.lit(depts)).cast("string")
    vin = F.pmod(F.xxhash64(F.col("value"), F.lit(2)), F.lit(vins)).cast("string")
    record = F.struct(
        dept.alias("dept_id"), vin.alias("vin"), F.date_format("timestamp", ISO_FORMAT).alias("example_ts")
    )
    return rate.select(F.to_json(record).alias("value"))
