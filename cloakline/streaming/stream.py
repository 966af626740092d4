"""Structured Streaming: parse, pseudonymize, write; rejects and metrics.

Crypto mode is a stateless projection, so a stream is just
``readStream -> parse_json -> pseudonymize -> writeStream`` with the file
sink's own exactly-once commit log; no ``foreachBatch`` is needed.

Service mode needs a distinct + join per micro-batch, so it runs in
``foreachBatch``. Each batch is written to its own ``batch_id=<n>`` folder with
dynamic partition overwrite: a batch replayed after a failure replaces its
own output instead of appending it twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cloakline.functions.crypto import has_text
from cloakline.operators.lookup import Lookup, LookupPolicy, apply_lookup
from cloakline.operators.table import as_list
from cloakline.session import scratch_scope
from cloakline.sources.io import CORRUPT_COLUMN, quote, with_corrupt_column
from cloakline.sources.records import register

BATCH_COLUMN = "batch_id"
DEFAULT_TRIGGER = "60 seconds"


def parse_json(
    sdf: DataFrame,
    schema: T.StructType | str,
    *,
    value_col: str = "value",
    corrupt: str = CORRUPT_COLUMN,
) -> DataFrame:
    """Parse one JSON object per record with an explicit schema.

    A record that does not parse keeps its text in ``corrupt`` (other fields
    null); a parsed record has ``corrupt`` null.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    full = with_corrupt_column(schema, corrupt)
    parsed = F.from_json(
        F.col(value_col).cast("string"),
        full,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt},
    )
    return sdf.select(parsed.alias("__cl_rec")).select("__cl_rec.*")


def split_rejects(parsed: DataFrame, corrupt: str = CORRUPT_COLUMN) -> tuple[DataFrame, DataFrame]:
    good = parsed.where(F.col(corrupt).isNull()).drop(corrupt)
    rejects = parsed.where(F.col(corrupt).isNotNull()).select(F.col(corrupt).alias("record"))
    return good, rejects


def require_parsed(parsed: DataFrame, corrupt: str = CORRUPT_COLUMN) -> DataFrame:
    """``parsed`` without ``corrupt``; a record that did not parse fails the query.

    The message does not show the record: it may hold identifiers.
    """
    stop = F.raise_error(F.lit("a record does not parse; set reject_path to set such records aside"))
    return parsed.where(F.when(F.col(corrupt).isNull(), F.lit(True)).otherwise(stop.cast("boolean"))).drop(corrupt)


def observe_counts(df: DataFrame, name: str, columns: Iterable[str]) -> DataFrame:
    """Attach row / null / blank counters; read them from ``lastProgress['observedMetrics']``."""
    metrics: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for c in as_list(columns):
        s = F.col(c).cast("string")
        metrics.append(F.sum(F.when(s.isNull(), 1).otherwise(0)).alias(f"{c}_nulls"))
        metrics.append(F.sum(F.when(s.isNotNull() & ~has_text(s), 1).otherwise(0)).alias(f"{c}_blanks"))
    return df.observe(name, *metrics)


def _trigger(writer, trigger: str | None, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger or DEFAULT_TRIGGER)


def start_file_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    fmt: str = "parquet",
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
    query_name: str | None = None,
) -> StreamingQuery:
    """Append a stream to files (exactly-once through the sink's commit log)."""
    writer = df.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, trigger, available_now).start(path)


def start_records_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    writer: str,
    *,
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
) -> StreamingQuery:
    """Append a stream to a record folder: one commit a micro-batch, which a replay doesn't repeat.

    ``writer`` names the query among those that write to the folder.
    """
    register(df.sparkSession)
    out = df.writeStream.format("records").option("checkpointLocation", checkpoint).option("writer", writer)
    return _trigger(out.outputMode("append"), trigger, available_now).start(path)


def start_table_sink(
    df: DataFrame,
    table: str,
    checkpoint: str,
    *,
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
) -> StreamingQuery:
    """Append a stream to a catalog table (resolved by name)."""
    writer = df.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    return _trigger(writer, trigger, available_now).toTable(table)


def refuse_batch_column(df: DataFrame) -> None:
    if BATCH_COLUMN in df.columns:
        raise ValueError(f"the data have a column {BATCH_COLUMN}, which the sink adds; rename it")


def write_batch_to_table(df: DataFrame, table: str, batch_id: int) -> None:
    """Idempotent per-batch append to a catalog table partitioned by ``batch_id``.

    A replayed batch replaces its own partition, named in the statement, and
    no other (``insertInto`` would overwrite the whole table: it ignores the
    writer's ``partitionOverwriteMode``). Columns go by name.
    """
    refuse_batch_column(df)
    spark = df.sparkSession
    names = ", ".join(quote(c) for c in spark.table(table).columns if c != BATCH_COLUMN)
    view = f"__cl_batch_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({BATCH_COLUMN} = {int(batch_id)}) SELECT {names} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """Idempotent per-batch write: replaces only folder ``batch_id=<batch_id>``."""
    refuse_batch_column(df)
    (
        df.withColumn(BATCH_COLUMN, F.lit(int(batch_id)).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH_COLUMN)
        .format(fmt)
        .save(path)
    )


def per_batch(
    transform: Callable[[DataFrame], DataFrame],
    path: str | None,
    *,
    table: str | None = None,
    reject_path: str | None = None,
    corrupt: str = CORRUPT_COLUMN,
    fmt: str = "parquet",
    skip_empty: bool = True,
):
    """``foreachBatch`` function: split rejects, transform, write idempotently to ``path`` or ``table``.

    Records that did not parse go to ``reject_path``; without one they fail
    the batch. They never reach the output.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        # The batch is read several times (emptiness, rejects, and the
        # transform's distinct + join), so it is persisted for the duration of
        # this call; a lost block is recomputed from the replayable source.
        # Scratch tables of the batch (the lookup mapping) are deleted once its
        # output is written.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with scratch_scope(batch.sparkSession):
                if skip_empty and batch.isEmpty():
                    return
                good = batch
                if corrupt in batch.columns:
                    if reject_path is None:
                        good = require_parsed(batch, corrupt)
                    else:
                        good, rejects = split_rejects(batch, corrupt)
                        write_batch(rejects, reject_path, batch_id, fmt)
                out = transform(good)
                if table is not None:
                    write_batch_to_table(out, table, batch_id)
                else:
                    write_batch(out, path, batch_id, fmt)
        finally:
            batch.unpersist()

    return run


def start_batch_sink(
    sdf: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    path: str | None,
    checkpoint: str,
    *,
    table: str | None = None,
    reject_path: str | None = None,
    corrupt: str = CORRUPT_COLUMN,
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
) -> StreamingQuery:
    writer = sdf.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        per_batch(transform, path, table=table, reject_path=reject_path, corrupt=corrupt)
    )
    return _trigger(writer, trigger, available_now).start()


def start_lookup_stream(
    sdf: DataFrame,
    columns: str | Iterable[str],
    lookup: Lookup,
    path: str,
    checkpoint: str,
    *,
    policy: LookupPolicy = LookupPolicy(),
    reject_path: str | None = None,
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
) -> StreamingQuery:
    """Service-mode stream: per micro-batch distinct -> lookup -> join -> write."""
    cols = as_list(columns)
    return start_batch_sink(
        sdf,
        lambda df: apply_lookup(df, cols, lookup, policy=policy),
        path,
        checkpoint,
        reject_path=reject_path,
        trigger=trigger,
        available_now=available_now,
    )
