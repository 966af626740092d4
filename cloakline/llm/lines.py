"""Line dedup over levelled sorted runs of line hashes.

A run is a table of (line hash, number of documents), sorted by hash. Documents
come in batches; each batch is merge-anti-joined with the runs: lines that no run
holds become the batch's own run at level 0, the counts of the others are kept
beside the runs. When a level holds ``fanout`` runs they are compacted into one
run of the next level, so a hash is rewritten once per level. After the last
batch runs and counts are merged and every line found in ``min_docs`` documents
or more is dropped from all of them.

A line's key is the line without the white space around it, A-Z lower-cased,
as a 128-bit BLAKE2 digest. Lines whose key is empty always stay. A null text
stays null and, like an empty one, counts as one empty line. Rows that agree in
doc_id and text are one document; they get the same result. A null doc_id is
an id of its own. Extra columns are kept.
"""

from hashlib import blake2b

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloakline.llm.common import BLANKS, LOWER_BYTES, identity, scratch, utf8

MIN_DOCS, BATCHES, FANOUT = 10, 4, 2
_BLANKS = BLANKS.encode()


def line_keys(data: bytes) -> list[bytes]:
    """The key of each line, empty for a line of white space."""
    out = []
    for line in data.translate(LOWER_BYTES).split(b"\n"):
        line = line.strip(_BLANKS)
        out.append(blake2b(line, digest_size=16).digest() if line else b"")
    return out


def _keys(batches):
    for b in batches:
        at, keys = [], []
        for i, t in enumerate(b["_t"]):
            own = set(line_keys(t.as_py())) - {b""}
            at += [i] * len(own)
            keys += own
        own = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [b["_k"].take(own), b["_h"].take(own), pa.array(keys, pa.binary())], ["_k", "_h", "key"])


class LineRuns:
    """Runs by level, no line in two of them; ``add`` takes a batch of rows ``(_k, _h, key)``, one per document and line key."""

    def __init__(self, fanout: int = FANOUT):
        self.fanout, self.levels, self.found = fanout, [], []

    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def fresh(self, batch: DataFrame) -> DataFrame:
        """The rows of the batch whose keys no run holds."""
        for run in self.runs():
            batch = batch.join(run.select("key").hint("merge"), "key", "left_anti")
        return batch

    def add(self, batch: DataFrame) -> None:
        # distinct: a document given twice counts once.
        counts = batch.select("key", "_k", "_h").distinct().groupBy("key").agg(F.count("*").alias("n"))
        if not self.levels:
            self._push(0, scratch(counts.sortWithinPartitions("key"), "lines-run"))
            return
        counts = scratch(counts.sortWithinPartitions("key"), "lines-batch")
        fresh = scratch(self.fresh(counts).sortWithinPartitions("key"), "lines-run")
        held = counts.join(fresh.select("key").hint("merge"), "key", "left_anti")
        self.found = [scratch(_merge([*self.found, held]).sortWithinPartitions("key"), "lines-found")]
        self._push(0, fresh)

    def _push(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self._push(level + 1, scratch(_merge(runs).sortWithinPartitions("key"), "lines-run"))

    def merged(self) -> DataFrame | None:
        """``(key, n)`` of all lines so far."""
        both = self.runs() + self.found
        return both[0] if len(both) == 1 else _merge(both) if both else None


def _merge(runs: list[DataFrame]) -> DataFrame:
    both = runs[0]
    for r in runs[1:]:
        both = both.unionAll(r)
    return both.groupBy("key").agg(F.sum("n").alias("n"))


def common_lines(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """``(_k, _h, keys)``: per document the keys of its lines that are in ``min_docs`` documents."""
    lines = (docs.select(*identity(), utf8("text").alias("_t"))
             .mapInArrow(_keys, "_k long, _h long, key binary"))
    lines = scratch(lines.withColumn("batch", F.pmod(F.xxhash64("_k", "_h"), F.lit(batches))), "lines")
    runs = LineRuns()
    for b in range(batches):
        runs.add(lines.where(F.col("batch") == b))
    heavy = runs.merged().where(F.col("n") >= min_docs).select("key")
    return lines.join(heavy, "key").groupBy("_k", "_h").agg(F.collect_set("key").alias("keys"))


def _drop(text: pd.Series, keys: pd.Series) -> pd.DataFrame:
    out = []
    for t, ks in zip(text, keys):
        data = bytes(t)
        lines = data.split(b"\n")
        if ks is None or not len(ks):
            out.append((data.decode(), len(lines), 0))
            continue
        gone = set(map(bytes, ks))
        left = [x for x, k in zip(lines, line_keys(data)) if k not in gone]
        out.append((b"\n".join(left).decode(), len(lines), len(lines) - len(left)))
    return pd.DataFrame(out, columns=["text", "n_lines", "n_dropped"])


def drop_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(row, text, n_lines, n_dropped)``: the input row as a struct, and its text without common lines."""
    found = common_lines(docs, min_docs)
    drop = F.pandas_udf(_drop, "text string, n_lines long, n_dropped long")
    rows = docs.select(F.struct("*").alias("row"))
    keyed = rows.select("row", *identity("row."))
    return (keyed.join(found, ["_k", "_h"], "left")
            .select("row", drop(utf8("row.text"), F.col("keys")).alias("_d"))
            .select("row", F.when(F.col("row.text").isNotNull(), F.col("_d.text")).alias("text"),
                    "_d.n_lines", "_d.n_dropped"))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with common lines dropped from ``text``; the other columns unchanged."""
    out = drop_lines(docs, min_docs)
    return out.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c)
                        for c in docs.columns])
