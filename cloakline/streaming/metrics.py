"""Progress and counters of streaming queries, kept as a table.

A listener turns every micro-batch's progress into rows and commits them to a
record folder under the query's run and batch number, so a repeated event adds
nothing. Rows: ``query_id, run_id, name, batch_id, at, metric, value``; metrics
are ``input_rows``, ``<phase>_ms`` of the batch's phases, and
``<observation>.<counter>`` of the counters observed (``observe_counts``).
"""

from __future__ import annotations

import threading
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import _parse_datatype_string

from cloakline.sources.records import DATA, RecordFolder, read_records

SCHEMA = "query_id string, run_id string, name string, batch_id long, at string, metric string, value double"
_ARROW = pa.schema([(n, pa.string()) for n in ("query_id", "run_id", "name")] + [
    ("batch_id", pa.int64()), ("at", pa.string()), ("metric", pa.string()), ("value", pa.float64())])


def rows_of(progress) -> list[dict]:
    """The metrics of one progress report."""
    found = {"input_rows": progress.numInputRows}
    found |= {f"{phase}_ms": ms for phase, ms in progress.durationMs.items()}
    for name, row in progress.observedMetrics.items():
        found |= {f"{name}.{k}": v for k, v in row.asDict().items()}
    key = dict(query_id=str(progress.id), run_id=str(progress.runId), name=progress.name, batch_id=progress.batchId,
               at=progress.timestamp)
    return [key | dict(metric=m, value=None if v is None else float(v)) for m, v in found.items()
            if v is None or isinstance(v, (int, float))]


class MetricsListener(StreamingQueryListener):
    """``with kept_metrics(spark, path): ...`` adds one, and waits for what is under way at the end."""

    def __init__(self, path: str):
        self.path = path
        self._schema = _parse_datatype_string(SCHEMA).jsonValue()
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def ended(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        self.ended(str(event.runId))

    def onQueryProgress(self, event) -> None:
        rows = rows_of(event.progress)
        folder = RecordFolder(self.path)
        name = f"metrics-{uuid.uuid4().hex}.parquet"
        folder.fs.create_dir(f"{folder.root}/{DATA}", recursive=True)
        pq.write_table(pa.Table.from_pylist(rows, _ARROW), f"{folder.root}/{DATA}/{name}", filesystem=folder.fs)
        folder.publish(f"{event.progress.runId}/{event.progress.batchId}/{event.progress.timestamp}",
                       [{"name": name, "rows": len(rows)}], self._schema)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended(str(event.runId)).set()

    def wait(self, query: StreamingQuery, timeout: float = 30.0) -> bool:
        """Until everything a terminated query reported is written."""
        return self.ended(str(query.runId)).wait(timeout)


class kept_metrics:
    """Keep the metrics of all queries of ``spark`` that run inside the block."""

    def __init__(self, spark: SparkSession, path: str, timeout: float = 30.0):
        self.spark, self.listener, self.timeout = spark, MetricsListener(path), timeout

    def __enter__(self) -> MetricsListener:
        self.spark.streams.addListener(self.listener)
        return self.listener

    def __exit__(self, *exc) -> None:
        for event in list(self.listener._ended.values()):
            event.wait(self.timeout)
        self.spark.streams.removeListener(self.listener)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return read_records(spark, path)
