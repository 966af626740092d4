"""A mapping kept between runs and micro-batches: each value is asked for once, ever.

The store is a Parquet table bucketed and sorted by a keyed digest of the value
(HMAC-SHA256; values themselves are never stored). A run takes its distinct
values, joins them with the buckets (only the values move: the stored side has
no exchange), sends those without an answer, and appends their answers, one file
a bucket. A rerun after a failure finds what was appended and asks for the rest.

Two runs at once may both ask for a value and both append; readers take the
answer of the run whose name is smallest, so everyone sees the same one. Values
that a lookup refuses are not stored: the next run tries them again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakline.functions.crypto import hmac_sha256_hex, utf8
from cloakline.keys import Keyring
from cloakline.operators.lookup import (
    Lookup, LookupPolicy, ask, distinct_values, join_mapping, materialize_mapping, read_once, write_rejects,
)
from cloakline.operators.table import as_list
from cloakline.session import ship_package, write_scratch
from cloakline.sources.io import ensure_database, literal, qualified, quote

BUCKETS = 64


class MappingStore:
    """``db.table`` at ``location`` (any path Spark can write); created if absent, opened if the files are there.

    ``buckets`` is fixed when the table is made: with n stored values a bucket
    holds about n / buckets, and a join runs one task a bucket. ``keyring``
    keys the digests; another one finds nothing.
    """

    def __init__(self, spark: SparkSession, db: str, table: str, location: str, keyring: Keyring,
                 buckets: int = BUCKETS):
        self.spark, self.keyring, self.buckets = spark, keyring, buckets
        self.db, self.table, self.location = db, table, location.rstrip("/")
        self.name = qualified(db, table)
        ensure_database(spark, db)
        self._declare(self.table, self._current())

    def _declare(self, table: str, path: str) -> None:
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {qualified(self.db, table)} (key BINARY, mapped STRING, run STRING) USING parquet "
            f"CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION {literal(path)}")

    def _generations(self) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        base = jvm.org.apache.hadoop.fs.Path(self.location)
        fs = base.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(base):
            return []
        names = [x.getPath().getName() for x in fs.listStatus(base)]
        # A generation counts once its job has committed; the first one has nothing before it.
        done = [int(n[1:]) for n in names if n[:1] == "g" and n[1:].isdigit()
                and (n == "g0" or fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.location}/{n}/_SUCCESS")))]
        return sorted(done)

    def _current(self) -> str:
        return f"{self.location}/g{max(self._generations(), default=0)}"

    def digest(self, value: Column) -> Column:
        return F.unhex(hmac_sha256_hex(utf8(value), self.keyring.columns(self.spark)))

    def rows(self, spark: SparkSession | None = None) -> DataFrame:
        """The table as it is now; micro-batches have a session of their own, which they give."""
        spark = spark or self.spark
        spark.catalog.refreshTable(self.name)
        return spark.table(self.name)

    def stored(self, spark: SparkSession | None = None) -> DataFrame:
        """``(key, mapped)``, one row a value; the aggregate runs inside the buckets."""
        return self.rows(spark).groupBy("key").agg(F.min(F.struct("run", "mapped")).alias("m")).select("key", "m.mapped")

    def unseen(self, values: DataFrame) -> DataFrame:
        """The rows of ``values`` (distinct, ``value``, ...) that have no stored answer.

        An outer join and a filter: an anti join would be pushed below the
        aggregate that made the values distinct, and move all rows.
        """
        keyed = values.withColumn("key", self.digest(F.col("value")))
        seen = self.rows(values.sparkSession).select("key", F.lit(True).alias("seen")).hint("merge")
        return keyed.join(seen, "key", "left").where("seen IS NULL").select("key", *values.columns)

    def append(self, answered: DataFrame, run: str) -> None:
        """Add ``(key, mapped)`` rows: one file for each bucket they fall into."""
        rows = answered.select("key", "mapped", F.lit(run).alias("run")).repartition(self.buckets, "key")
        rows.sortWithinPartitions("key").write.insertInto(self.name)

    def runs(self) -> DataFrame:
        """``(run, n)``: how many values each run asked for and got."""
        return self.rows().groupBy("run").agg(F.count(F.lit(1)).alias("n"))

    def compact(self) -> None:
        """Rewrite the table as one file a bucket, with one row a value.

        The new generation is complete before the table points to it; a crash
        in between leaves the old or the new one current. Not while runs append.
        """
        path = f"{self.location}/g{max(self._generations(), default=0) + 1}"
        new = f"{self.table}_{uuid.uuid4().hex[:8]}"
        rows = self.rows().groupBy("key").agg(F.min(F.struct("run", "mapped")).alias("m"))
        rows = rows.select("key", "m.mapped", "m.run").repartition(self.buckets, "key")
        (rows.write.format("parquet").bucketBy(self.buckets, "key").sortBy("key").option("path", path)
         .saveAsTable(qualified(self.db, new)))
        # External tables: dropping one leaves its files.
        self.spark.sql(f"DROP TABLE {self.name}")
        self.spark.sql(f"ALTER TABLE {qualified(self.db, new)} RENAME TO {quote(self.db)}.{quote(self.table)}")


def apply_stored_lookup(
    df: DataFrame,
    columns: str | Iterable[str],
    lookup: Lookup,
    store: MappingStore,
    *,
    run: str | None = None,
    policy: LookupPolicy = LookupPolicy(),
    partitions: int | None = None,
    null_as_text: bool = False,
    broadcast_max_bytes: int = 64 << 20,
    reject_path: str | None = None,
) -> DataFrame:
    """``apply_lookup`` that asks only for values without a stored answer and stores the new answers.

    ``run`` names what this call adds (a micro-batch's number, say); by default
    a name is made up.
    """
    cols = as_list(columns)
    if (policy.bad_values == "reject") != (reject_path is not None):
        raise ValueError("bad_values='reject' and reject_path go together")
    ship_package(df.sparkSession)
    df = read_once(df)
    values = distinct_values(df, cols, null_as_text=null_as_text, with_mask=True, drop_blank=False)
    new = store.unseen(values).select("value", "mask")
    if partitions:
        new = new.repartition(int(partitions), "value")
    # Each value is sent once: what came back is written before it is used twice.
    asked = materialize_mapping(ask(new, lookup, policy), store.digest).withColumnRenamed("value", "key")
    if reject_path is not None:
        write_rejects(asked, reject_path)
    good = asked.where("mapped IS NOT NULL")  # what got no answer is asked for again next time
    if not good.isEmpty():
        store.append(good, run or uuid.uuid4().hex)
    known = values.select(store.digest(F.col("value")).alias("key"), "mask")
    mapping = known.join(store.stored(df.sparkSession).hint("merge"), "key").select(F.col("key").alias("value"), "mapped", "mask")
    return join_mapping(
        df, cols, write_scratch(mapping, "mapping"), null_as_text=null_as_text, digest=store.digest,
        broadcast_max_bytes=broadcast_max_bytes, missing="null" if reject_path is not None else policy.null_answers)
