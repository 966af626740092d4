"""Record folders: all-or-nothing appends, and a stream of what was appended.

A record folder holds Parquet files and a log of commits. Tasks write files that
nobody sees yet and report them; the driver commits all of them by one small
log entry, or deletes them. A commit has an id: committing it again changes
nothing, so a job that failed, or whose outcome is unknown, is simply run again.

``format("records")`` (after ``register``) is a Python data source with

* a batch writer and a streaming writer (one commit for each run or micro-batch),
* a stream reader whose offsets are commit numbers: it starts at the earliest or
  the latest commit, a given number or a time, and restarts from its checkpoint,
* a batch reader; ``read_records`` reads the same files with Spark's own reader,
  which prunes columns and pushes filters down.

Paths are what pyarrow's file systems accept (a folder every machine sees, or an
object store). Entries are published by a link on local and network disks, by a
rename elsewhere; of two commits that race for a number one takes the next.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader,
    InputPartition, WriterCommitMessage,
)
from pyspark.sql.types import StructType

# The source runs in Python workers, which need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LOG, DATA, DIGITS = "_log", "data", 20
#: Names of the start positions, the usual ones of stream services included.
EARLIEST, LATEST = ("earliest", "trim_horizon"), ("latest",)


class RecordFolder:
    """The files and the log below one path."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")
        plain = self.path
        if plain.startswith("file:") and "://" not in plain:
            plain = plain[len("file:"):]
        if "://" in plain:
            self.fs, self.root = pafs.FileSystem.from_uri(plain)
        else:
            self.fs, self.root = pafs.LocalFileSystem(), os.path.abspath(plain)
        self.local = isinstance(self.fs, pafs.LocalFileSystem)

    def numbers(self) -> list[int]:
        found = self.fs.get_file_info(pafs.FileSelector(f"{self.root}/{LOG}", allow_not_found=True))
        names = (f.base_name for f in found if f.is_file)
        return sorted(int(n[:DIGITS]) for n in names if n.endswith(".json") and n[:DIGITS].isdigit())

    def entry(self, number: int) -> dict:
        with self.fs.open_input_stream(f"{self.root}/{LOG}/{number:0{DIGITS}d}.json") as f:
            return {**json.loads(f.read()), "number": number}

    def entries(self, after: int = -1, upto: int | None = None) -> list[dict]:
        return [self.entry(n) for n in self.numbers() if n > after and (upto is None or n <= upto)]

    def last(self) -> int:
        return max(self.numbers(), default=-1)

    def schema(self) -> StructType | None:
        n = self.last()
        return None if n < 0 else StructType.fromJson(self.entry(n)["schema"])

    def has(self, commit_id: str) -> bool:
        return any(e["id"] == commit_id for e in self.entries())

    def files(self, entries: list[dict]) -> list[str]:
        return [f"{self.root}/{DATA}/{f['name']}" for e in entries for f in e["files"]]

    def publish(self, commit_id: str, files: list[dict], schema: dict) -> int | None:
        """Commit the files; the commit's number, or None if the id is there already (the files are deleted)."""
        self.fs.create_dir(f"{self.root}/{LOG}", recursive=True)
        body = json.dumps({"id": commit_id, "files": files, "schema": schema, "time_ms": time.time_ns() // 10**6})
        draft = f"{self.root}/{LOG}/.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as f:
            f.write(body.encode())
        try:
            seen = -1
            while True:
                new = self.entries(after=seen)
                seen = max([seen, *(e["number"] for e in new)])
                if any(e["id"] == commit_id for e in new):
                    self.discard(files)
                    return None
                if self._place(draft, f"{self.root}/{LOG}/{seen + 1:0{DIGITS}d}.json"):
                    return seen + 1
        finally:
            if self.fs.get_file_info(draft).type != pafs.FileType.NotFound:
                self.fs.delete_file(draft)

    def _place(self, draft: str, target: str) -> bool:
        """Give the draft its name unless another commit has it."""
        if self.local:
            try:
                os.link(draft, target)
                return True
            except FileExistsError:
                return False
        if self.fs.get_file_info(target).type != pafs.FileType.NotFound:
            return False
        try:
            self.fs.move(draft, target)
            return True
        except OSError:
            return False

    def discard(self, files: list[dict]) -> None:
        for f in files:
            path = f"{self.root}/{DATA}/{f['name']}"
            if self.fs.get_file_info(path).type != pafs.FileType.NotFound:
                self.fs.delete_file(path)

    def unlisted(self, older_than_s: float = 0.0, prefix: str = "") -> list[dict]:
        """Files of no commit: of failed tasks, or of writes that still run."""
        known = {f["name"] for e in self.entries() for f in e["files"]}
        limit = time.time() - older_than_s
        found = self.fs.get_file_info(pafs.FileSelector(f"{self.root}/{DATA}", allow_not_found=True))
        return [{"name": f.base_name} for f in found if f.is_file and f.base_name not in known
                and f.base_name.startswith(prefix) and (f.mtime is None or f.mtime.timestamp() <= limit)]

    def vacuum(self, older_than_s: float = 86_400.0) -> int:
        """Delete what crashed writes left; give it more time than the longest write takes."""
        files = self.unlisted(older_than_s)
        self.discard(files)
        return len(files)

    def start(self, position: str) -> int:
        """The last commit before a start position: a name, a commit number, or a time (ISO 8601)."""
        text = position.strip()
        if text.lower() in EARLIEST:
            return -1
        if text.lower() in LATEST:
            return self.last()
        if text.isdigit():
            return int(text) - 1
        try:
            at = datetime.fromisoformat(text)
        except ValueError:
            raise ValueError(f"start position {position!r}: earliest, latest, a commit number or an ISO time") from None
        at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
        before = [e["number"] for e in self.entries() if e["time_ms"] < at.timestamp() * 1000]
        return max(before, default=-1)


@dataclass
class Written(WriterCommitMessage):
    files: list


@dataclass
class FilePart(InputPartition):
    path: str


class _Writer:
    """Shared by batch and streaming writes: files named after this write, published or deleted."""

    def __init__(self, path: str, schema: StructType):
        self.path, self.schema, self.mark = path, schema.json(), uuid.uuid4().hex
        have = RecordFolder(path).schema()
        if have is not None and have.simpleString() != schema.simpleString():
            raise ValueError(f"{path} holds {have.simpleString()}, not {schema.simpleString()}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        folder = RecordFolder(self.path)
        name, out, rows = f"{self.mark}-{uuid.uuid4().hex}.parquet", None, 0
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if out is None:
                    folder.fs.create_dir(f"{folder.root}/{DATA}", recursive=True)
                    out = pq.ParquetWriter(f"{folder.root}/{DATA}/{name}", batch.schema, filesystem=folder.fs,
                                           compression="zstd")
                out.write_batch(batch)
                rows += batch.num_rows
        except BaseException:
            if out is not None:
                out.close()
                folder.discard([{"name": name}])
            raise
        if out is None:
            return Written([])
        out.close()
        return Written([{"name": name, "rows": rows}])

    def _publish(self, messages: list, commit_id: str) -> None:
        files = [f for m in messages if m is not None for f in m.files]
        folder = RecordFolder(self.path)
        folder.publish(commit_id, files, json.loads(self.schema))
        self._sweep(folder)

    def _sweep(self, folder: RecordFolder) -> None:
        # What attempts of this write left that was not reported: retried and speculative tasks.
        # A task that outlives an abort may still leave a file, for ``vacuum``.
        folder.discard(folder.unlisted(prefix=self.mark))


class RecordWriter(_Writer, DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, commit_id: str):
        super().__init__(path, schema)
        self.commit_id = commit_id

    def commit(self, messages) -> None:
        self._publish(messages, self.commit_id)

    def abort(self, messages) -> None:
        self._sweep(RecordFolder(self.path))


class RecordStreamWriter(_Writer, DataSourceStreamArrowWriter):
    def __init__(self, path: str, schema: StructType, writer: str):
        super().__init__(path, schema)
        self.writer = writer

    def commit(self, messages, batchId: int) -> None:
        self._publish(messages, f"{self.writer}/{batchId}")

    def abort(self, messages, batchId: int) -> None:
        self._sweep(RecordFolder(self.path))


def _read(part: FilePart, names: list[str]) -> Iterator[pa.RecordBatch]:
    folder = RecordFolder(part.path)
    with pq.ParquetFile(folder.root, filesystem=folder.fs) as f:
        yield from f.iter_batches(columns=names)


def _parts(folder: RecordFolder, entries: list[dict]) -> list[FilePart]:
    base = folder.path if "://" in folder.path else folder.root
    return [FilePart(f"{base}/{DATA}/{f['name']}") for e in entries for f in e["files"]]


class RecordReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.names = path, schema.names

    def partitions(self):
        folder = RecordFolder(self.path)
        return _parts(folder, folder.entries())

    def read(self, partition: FilePart):
        return _read(partition, self.names)


class RecordStreamReader(DataSourceStreamReader):
    def __init__(self, path: str, schema: StructType, position: str):
        self.path, self.names, self.position = path, schema.names, position

    def initialOffset(self) -> dict:
        return {"commit": RecordFolder(self.path).start(self.position)}

    def latestOffset(self) -> dict:
        return {"commit": RecordFolder(self.path).last()}

    def partitions(self, start: dict, end: dict):
        folder = RecordFolder(self.path)
        return _parts(folder, folder.entries(start["commit"], end["commit"]))

    def read(self, partition: FilePart):
        return _read(partition, self.names)


class RecordSource(DataSource):
    """Options: ``path``; ``startingPosition`` (stream reads); ``commitId`` (batch writes), ``writer`` (stream writes)."""

    @classmethod
    def name(cls) -> str:
        return "records"

    def _path(self) -> str:
        path = self.options.get("path")
        if not path:
            raise ValueError("records: a path is needed")
        return path

    def schema(self) -> StructType:
        found = RecordFolder(self._path()).schema()
        if found is None:
            raise ValueError(f"{self._path()}: nothing committed yet, give a schema")
        return found

    def reader(self, schema: StructType) -> RecordReader:
        return RecordReader(self._path(), schema)

    def streamReader(self, schema: StructType) -> RecordStreamReader:
        return RecordStreamReader(self._path(), schema, self.options.get("startingPosition", "earliest"))

    def writer(self, schema: StructType, overwrite: bool) -> RecordWriter:
        if overwrite:
            raise ValueError("records: append only")
        return RecordWriter(self._path(), schema, self.options.get("commitId") or uuid.uuid4().hex)

    def streamWriter(self, schema: StructType, overwrite: bool) -> RecordStreamWriter:
        writer = self.options.get("writer")
        if not writer:
            raise ValueError("records: a stream needs a writer name, which stays the same over restarts")
        return RecordStreamWriter(self._path(), schema, writer)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RecordSource)


def write_records(df: DataFrame, path: str, commit_id: str) -> bool:
    """Append ``df`` as one commit; False, without running anything, if that id is committed."""
    if RecordFolder(path).has(commit_id):
        return False
    register(df.sparkSession)
    df.write.format("records").mode("append").option("commitId", commit_id).save(path)
    return True


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All committed records, read by Spark's Parquet reader."""
    folder = RecordFolder(path)
    schema = folder.schema()
    if schema is None:
        raise ValueError(f"{path}: nothing committed yet")
    entries = folder.entries()
    if not any(e["files"] for e in entries):
        return spark.createDataFrame([], schema)
    scheme = path.split("://")[0] + "://" if "://" in path and not folder.local else ""
    return spark.read.schema(schema).parquet(*[scheme + f for f in folder.files(entries)])


def stream_records(spark: SparkSession, path: str, *, start: str = "earliest", schema: StructType | str | None = None) -> DataFrame:
    """A stream of what is appended, from ``start`` on."""
    register(spark)
    reader = spark.readStream.format("records").option("startingPosition", start)
    return (reader.schema(schema) if schema is not None else reader).load(path)
