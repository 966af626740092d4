"""Helpers shared by the operators: words, digests, scratch tables, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakline.session import write_scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What the contracts call white space: space and the controls 09 to 0D.
BLANKS = " \t\n\x0b\x0c\r"
#: bytes.translate table: A-Z become a-z, nothing else changes.
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: The same, and every ASCII byte that is no letter or digit becomes a space.
WORD_BYTES = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in LOWER_BYTES
)
NULL_ID = 2**63 - 1


BATCH_KEY, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"


def text_batches(spark: SparkSession) -> None:
    """Arrow batches of 1,000 rows unless the session has a size of its own.

    The default, 10,000, suits rows of numbers; of texts it holds tens of
    megabytes, several times over on either side of the pipe.
    """
    if spark.conf.get(BATCH_KEY) == "10000":
        spark.conf.set(BATCH_KEY, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def blank_words(data: bytes) -> list[bytes]:
    """Words between white space, A-Z lower-cased (``bytes.split`` splits at BLANKS)."""
    return data.translate(LOWER_BYTES).split()


def alnum_words(data: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of non-ASCII characters, A-Z lower-cased."""
    return data.translate(WORD_BYTES).split()


def utf8(text: str | Column) -> Column:
    """The text's bytes, empty for null."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(c.cast("string").cast("binary"), F.lit(b""))


def identity(at: str = "") -> list[Column]:
    """Columns ``_k`` and ``_h``, which tell documents apart.

    ``_k`` is the doc_id as a long (null ids sort last), ``_h`` a hash of the
    text; rows that agree in both are one document given several times. ``at``:
    a prefix for columns inside a struct.
    """
    return [
        F.coalesce(F.col(f"{at}doc_id").cast("long"), F.lit(NULL_ID)).alias("_k"),
        F.xxhash64(F.coalesce(F.col(f"{at}text"), F.lit(""))).alias("_h"),
    ]


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write below ``spark.checkpoint.dir`` and read back."""
    return write_scratch(df, name)


def apart(side: DataFrame) -> DataFrame:
    """An aggregate as a join side with a shuffle of its own.

    Without it the aggregate shares the join's partitioning and Spark can't
    split a partition in which a hot key of the other side lies. Small sides only.
    """
    return side.hint("rebalance")


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Connected components of an undirected graph of longs: rows ``(node, component)``.

    ``component`` is the smallest node reachable. Each round hooks every node to
    its smallest neighbour (or itself), follows the hooks to their roots by
    doubling, and replaces both ends of each edge by their roots: connections
    survive, every root takes in a neighbour, so at least half of the nodes go,
    whatever the length of paths. Roots are composed into the labels. Each step
    is an aggregate with map-side combine or a plain equi-join (AQE splits a
    hub's rows), and is written to the shared folder.
    """
    live = scratch(
        edges.select(F.col(src).cast("long").alias("a"), F.col(dst).cast("long").alias("b"))
        .where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(), "edges")
    labels = None
    while not live.isEmpty():
        both = live.unionAll(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = scratch(
            both.groupBy("a").agg(F.min("b").alias("b"))
            .select(F.col("a").alias("node"), F.least("a", "b").alias("to")), "hook")
        while True:  # each pass doubles the number of hooks followed
            far = step.select(F.col("node").alias("to"), F.col("to").alias("far"))
            step = scratch(step.join(far, "to").select("node", F.col("far").alias("to"), (
                F.col("far") < F.col("to")).alias("moved")), "hook")
            if step.where("moved").isEmpty():
                break
            step = step.select("node", "to")
        step = step.select("node", "to")
        ends = step.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        oth = step.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        live = scratch(
            live.join(ends, "a").join(oth, "b").where("ta <> tb")
            .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(),
            "edges")
        if labels is None:
            labels = step.select("node", F.col("to").alias("component"))
        else:
            nxt = step.select(F.col("node").alias("component"), "to")
            labels = scratch(
                labels.join(nxt, "component", "left")
                .select("node", F.coalesce("to", "component").alias("component")), "labels")
    if labels is None:
        return edges.sparkSession.createDataFrame([], "node long, component long")
    return labels
