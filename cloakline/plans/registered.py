"""Queries checked by the driver, each over whole driver tables, with oracles.

AES-GCM output can't be recomputed in DuckDB, so each query ends in values
an oracle *can* compute from the plain tables: round trips (pseudonymize then
re-identify), the pseudonym length law, distinct counts (determinism and
injectivity), keyed IV bytes (HMAC-SHA256 with the test key's pads), group
sizes and keyed sums. All use the fixed test key.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
import uuid
from collections.abc import Callable

from pyspark.errors import SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloakline.functions.crypto import pseudonym_length
from cloakline.functions.sql import register_functions, register_lookup_function
from cloakline.jobs import BatchJob, CsvJob, StreamJob, run_batch, run_csv_batch, run_stream
from cloakline.keys import Keyring
from cloakline.operators.grouping import group_arrays, group_reidentify, n_per_group
from cloakline.operators.nested import pseudonymize_nested, reidentify_nested
from cloakline.operators.lookup import LookupPolicy, RefusedError, RetryableError, apply_lookup, lookup_mapping
from cloakline.operators.paced import Pace, paced_mapping
from cloakline.operators.search import revealed, sealed_sql, write_indexed
from cloakline.operators.store import MappingStore, apply_stored_lookup
from cloakline.operators.table import pseudonymize, reidentify, rename_with_prefix, spread
from cloakline.operators.variant import parse_records, pseudonymize_records, reidentify_records
from cloakline.operators.versions import KeyringSet, key_id, pseudonymize_versioned, reidentify_versioned, reseal
from cloakline.session import scratch_path, write_scratch
from cloakline.sources.io import read_json_lines
from cloakline.sources.records import RecordFolder, read_records, write_records
from cloakline.streaming.metrics import kept_metrics, read_metrics

# Fixed value: the secret of these queries and the tests. No key for production.
TEST_SECRET = hashlib.sha256(b"cloakline test key - not for production").digest()
KR = Keyring.from_secret(TEST_SECRET)
BATCH = 900
LIMIT = 5000  # the reference's published query (LIMIT 5000): the feature, not a cap

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------- lookups that stand in for a service


class PrefixLookup:
    """``v -> prefix + v``."""

    def __init__(self, prefix: str = "p_"):
        self.prefix = prefix

    def __call__(self, values: list[str]) -> list[str]:
        return [self.prefix + v for v in values]


class StripLookup:
    """Inverse of ``PrefixLookup``."""

    def __init__(self, prefix: str = "p_"):
        self.prefix = prefix

    def __call__(self, values: list[str]) -> list[str]:
        return [v[len(self.prefix):] if v.startswith(self.prefix) else "" for v in values]


class FlakyLookup:
    """Fails the first ``failures`` calls of each batch (no answer, then an error); the answers
    say at which attempt they came: ``p<attempt>_<value>``."""

    def __init__(self, failures: int = 2):
        self.failures = failures
        self._calls: dict[tuple, int] = {}

    def __call__(self, values: list[str]):
        key = tuple(values)
        n = self._calls[key] = self._calls.get(key, 0) + 1
        if n <= self.failures:
            if n % 2:
                return None
            raise RetryableError("throttled")
        return [f"p{n}_{v}" for v in values]


class RefusingLookup:
    """Refuses a call with a number that ends in 13; the answers number the task's calls: ``<call>_<value>``."""

    def __init__(self):
        self.calls = 0

    def __call__(self, values: list[str]) -> list[str]:
        self.calls += 1
        if any(v.endswith("13") for v in values):
            raise RefusedError("a value is refused")
        return [f"{self.calls}_{v}" for v in values]


class LimitedLookup:
    """Answers at most ``limit`` calls in each stretch of ``seconds``, counted over all callers in a shared folder."""

    def __init__(self, folder: str, limit: int, seconds: float):
        self.folder, self.limit, self.seconds = folder.removeprefix("file:"), limit, seconds

    def _mark(self, name: str) -> None:
        """One more call of that kind."""
        path = os.path.join(self.folder, name)
        os.makedirs(path, exist_ok=True)
        open(os.path.join(path, uuid.uuid4().hex), "x").close()

    def __call__(self, values: list[str]) -> list[str]:
        stretch = str(int(time.time() / self.seconds))
        self._mark(stretch)
        if self.count(stretch) > self.limit:
            self._mark("refused")
            raise RetryableError("throttled")
        self._mark("answered")
        return ["p_" + v for v in values]

    def count(self, name: str) -> int:
        path = os.path.join(self.folder, name)
        return len(os.listdir(path)) if os.path.isdir(path) else 0


class SizeLookup:
    """Answers with the number of values in the call."""

    def __call__(self, values: list[str]) -> list[str]:
        return [str(len(values))] * len(values)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def views(spark: SparkSession, sf: str, *names: str) -> None:
    for n in names:
        table(spark, sf, n).createOrReplaceTempView(n)


def length_of(col: str):
    return F.length(col).cast("long")


# ------------------------------------------------------------- crypto, table form


def roundtrip_customer(spark, sf):
    src = table(spark, sf, "customer").select("c_custkey", "c_name")
    pseud = rename_with_prefix(pseudonymize(src, "c_name", KR), ["c_name"])
    back = reidentify(pseud.withColumn("c_name", F.col("s_c_name")), "c_name", KR)
    return back.select(
        "c_custkey", "c_name", length_of("s_c_name").alias("pseudonym_len"),
        (F.col("s_c_name") != F.col("c_name")).alias("changed"),
    )


def roundtrip_random(spark, sf):
    src = table(spark, sf, "customer").select("c_custkey", "c_name", F.col("c_name").alias("twin"))
    pseud = pseudonymize(src, ["c_name", "twin"], KR, deterministic=False)
    pseud = pseud.select(
        "c_custkey", F.col("c_name").alias("p1"), F.col("twin").alias("p2"),
        F.col("c_name").alias("c_name"),
    )
    back = reidentify(pseud, "c_name", KR)
    return back.select("c_custkey", "c_name", (F.col("p1") != F.col("p2")).alias("differs"))


def roundtrip_multi_column(spark, sf):
    cols = ["user_id", "event_type", "props"]
    src = table(spark, sf, "events").select("event_id", *cols)
    return reidentify(pseudonymize(src, cols, KR), cols, KR)


def roundtrip_long_text(spark, sf):
    src = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    pseud = pseudonymize(src.withColumn("s_text", F.col("text")), "s_text", KR)
    back = reidentify(pseud.withColumn("back", F.col("s_text")), "back", KR)
    return back.select(
        "conv_id", "turn", F.col("back").alias("text"), length_of("s_text").alias("pseudonym_len")
    )


def roundtrip_documents(spark, sf):
    src = table(spark, sf, "documents").select("doc_id", "text")
    pseud = pseudonymize(src.withColumn("s_text", F.col("text")), "s_text", KR)
    back = reidentify(pseud.withColumn("back", F.col("s_text")), "back", KR)
    return back.select(
        "doc_id", F.col("back").alias("text"),
        (length_of("s_text") == pseudonym_length(F.octet_length("text"))).alias("length_law"),
    )


def injective_counts(spark, sf):
    # Parts and suppliers repeat a lot: each is sealed once and joined back.
    cols = {"l_orderkey": "row", "l_partkey": "distinct", "l_suppkey": "distinct"}
    pseud = pseudonymize(table(spark, sf, "lineitem").select(*cols), list(cols), KR, strategy=cols)
    return pseud.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("l_orderkey").alias("n_orders"),
        F.countDistinct("l_partkey").alias("n_parts"),
        F.countDistinct("l_suppkey").alias("n_suppliers"),
    )


def group_sizes(spark, sf):
    pseud = pseudonymize(table(spark, sf, "events").select("user_id"), "user_id", KR)
    counts = pseud.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    back = reidentify(counts, "user_id", KR)
    return back.select(F.col("user_id").cast("long").alias("user_id"), "n")


def linked_join(spark, sf):
    # Tables of one small file are dealt out to all cores; larger scans stay as they are.
    cust = pseudonymize(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_custkey", KR,
                        min_partitions="auto")
    orders = pseudonymize(table(spark, sf, "orders").select("o_custkey", "o_totalprice"), "o_custkey", KR,
                          min_partitions="auto")
    joined = orders.join(cust, orders.o_custkey == cust.c_custkey)
    return joined.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total_price"),
    )


def deterministic_iv(spark, sf):
    pseud = pseudonymize(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_name", KR)
    return pseud.select(
        "c_custkey", F.lower(F.hex(F.substring(F.unbase64("c_name"), 1, 12))).alias("iv_hex")
    )


def _edge_value():
    # Every customer row is kept: the key only picks which edge value the row
    # carries (null, blanks, the text 'None', padded or plain names).
    k = F.pmod(F.col("c_custkey"), F.lit(8))
    return (
        F.when(k == 0, F.lit(None).cast("string"))
        .when(k == 1, F.lit(""))
        .when(k == 2, F.lit("   "))
        .when(k == 3, F.lit("\t\n"))
        .when(k == 4, F.lit("None"))
        .when(k == 5, F.lit(" 　"))
        .when(k == 6, F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")))
        .otherwise(F.col("c_name"))
    )


def blank_null_policy(spark, sf):
    src = table(spark, sf, "customer").select("c_custkey", _edge_value().alias("v"))
    pseud = pseudonymize(src, "v", KR)
    kind = (
        F.when(F.col("v").isNull(), "null").when(F.col("v") == "", "blank").otherwise("sealed")
    )
    back = reidentify(pseud.withColumn("kind", kind), "v", KR)
    return back.select("c_custkey", "kind", F.col("v").alias("value"))


def null_as_text(spark, sf):
    # Every row is kept; a fifth of them carry a null name.
    k = F.pmod(F.col("c_custkey"), F.lit(5))
    src = table(spark, sf, "customer").select(
        "c_custkey", F.when(k == 0, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("v")
    )
    back = reidentify(pseudonymize(src, "v", KR, null_as_text=True), "v", KR)
    return back.select("c_custkey", F.col("v").alias("value"))


def random_run_linkage(spark, sf):
    src = table(spark, sf, "orders").select("o_custkey")
    pseud = pseudonymize(src, "o_custkey", KR, deterministic=False, linkage="run")
    counts = pseud.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    back = reidentify(counts, "o_custkey", KR)
    return back.select(F.col("o_custkey").cast("long").alias("o_custkey"), "n")


def reveal_filtered_group(spark, sf):
    """Pseudonyms of one group are damaged; the others are revealed all the same."""
    src = table(spark, sf, "lineitem").select("l_returnflag", "l_suppkey")
    pseud = pseudonymize(src, "l_suppkey", KR, strategy="distinct")
    damaged = pseud.withColumn(
        "l_suppkey", F.when(F.col("l_returnflag") == "R", F.lit("AAAA")).otherwise(F.col("l_suppkey")))
    back = reidentify(damaged, "l_suppkey", KR, strategy="distinct").where("l_returnflag <> 'R'")
    return back.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_suppkey").cast("long")).alias("id_sum"))


def roundtrip_binary(spark, sf):
    """Bytes that are no UTF-8 come back as they were."""
    raw = F.concat(F.unhex(F.lit("FF00FE")), F.encode("c_name", "UTF-8"))
    src = table(spark, sf, "customer").select("c_custkey", raw.alias("v"))
    back = reidentify(pseudonymize(src, "v", KR), "v", KR, binary="v")
    return back.select("c_custkey", F.hex("v").alias("hex"))


#: The identifiers that the point lookups ask for.
SOUGHT = (7, 42, 99)


def _indexed_orders(spark, sf) -> DataFrame:
    base = f"{scratch_path(spark, 'indexed')}/orders"
    src = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    write_indexed(rename_with_prefix(pseudonymize(src, "o_custkey", KR), ["o_custkey"]), base, "s_o_custkey")
    return spark.read.parquet(base)


def find_identifiers(spark, sf):
    """Orders of a few customers, found by sealed constants, and only those revealed."""
    orders = _indexed_orders(spark, sf)
    found = orders.where(revealed(orders, "s_o_custkey", KR).isin(*SOUGHT))
    return reidentify(found, "s_o_custkey", KR).select("o_orderkey", F.col("s_o_custkey").cast("long").alias("o_custkey"))


def sql_find_identifiers(spark, sf):
    _indexed_orders(spark, sf).createOrReplaceTempView("sealed_orders")
    return sealed_sql(spark, "SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total FROM sealed_orders "
                             "WHERE s_o_custkey = :who", KR, {"who": SOUGHT[1]})


def nested_roundtrip(spark, sf):
    """Identifiers in a struct, in an array of structs and as keys of a map: sealed, then revealed in place."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.collect_list(F.struct("l_linenumber", F.col("l_suppkey").alias("supp"), "l_quantity")).alias("lines"),
        F.collect_list("l_partkey").alias("parts"))
    number = F.transform(F.sequence(F.lit(1), F.size("parts")), lambda i: i.cast("string"))
    lines = lines.withColumn("parts", F.map_from_arrays(number, "parts"))
    orders = table(spark, sf, "orders").select("o_orderkey", F.struct("o_custkey", "o_orderstatus").alias("head"))
    whole = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")
    paths = ["head.o_custkey", "lines[].supp", "parts{}", "parts{key}"]
    sealed = pseudonymize_nested(whole, paths, KR)
    plain = F.exists("lines", lambda x: F.length(x["supp"]) < 40) | (F.length("head.o_custkey") < 40)
    back = reidentify_nested(sealed.withColumn("plain", F.coalesce(plain, F.lit(False))), paths, KR)
    total = lambda c, of: F.aggregate(c, F.lit(0).cast("long"), lambda acc, x: acc + of(x).cast("long"))
    return back.select(
        "o_orderkey", F.col("head.o_custkey").alias("o_custkey"), F.col("head.o_orderstatus").alias("o_orderstatus"),
        total("lines", lambda x: x["supp"]).alias("supp_sum"), total("lines", lambda x: x["l_linenumber"]).alias("line_sum"),
        total(F.map_values("parts"), lambda x: x).alias("part_sum"), total(F.map_keys("parts"), lambda x: x).alias("key_sum"),
        "plain")


OLD_KEY = Keyring.from_secret(hashlib.sha256(b"an older test key - not for production").digest())
BEFORE = KeyringSet({"2023": OLD_KEY}, "2023")
BOTH = KeyringSet({"2023": OLD_KEY, "2024": KR}, "2024")
AFTER = KeyringSet({"2024": KR}, "2024")


def key_versions(spark, sf):
    """A table sealed under two keys, revealed in one pass."""
    src = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    old = F.col("c_mktsegment") < "F"
    both = pseudonymize_versioned(src.where(old), "c_name", BEFORE).unionAll(
        pseudonymize_versioned(src.where(~old), "c_name", BOTH))
    back = reidentify_versioned(both.withColumn("key", key_id(F.col("c_name"))), "c_name", BOTH)
    return back.select("c_custkey", "c_name", "key")


def stream_reseal(spark, sf):
    """A stream moves pseudonyms to the new key; the old one isn't needed afterwards."""
    base = scratch_path(spark, "reseal")
    src = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    pseudonymize_versioned(src, "user_id", BEFORE).write.parquet(f"{base}/in")
    stream = spark.readStream.schema("event_id long, user_id string, event_type string").parquet(f"{base}/in")
    out = reseal(stream, "user_id", BOTH)
    out.writeStream.format("parquet").option("checkpointLocation", f"{base}/ck").trigger(availableNow=True).start(
        f"{base}/out").awaitTermination()
    moved = spark.read.parquet(f"{base}/out")
    return reidentify_versioned(moved, "user_id", AFTER)


# ------------------------------------------------------------------ service mode


def lookup_join(spark, sf):
    cols = ["o_custkey", "o_orderstatus", "o_orderpriority"]
    src = table(spark, sf, "orders").select("o_orderkey", *cols)
    return apply_lookup(src, cols, PrefixLookup("p_"))


def lookup_retry(spark, sf):
    cols = ["c_name", "c_mktsegment"]
    src = table(spark, sf, "customer").select("c_custkey", *cols)
    return apply_lookup(src, cols, FlakyLookup(failures=2), policy=LookupPolicy(batch_size=300, backoff_base=0.0))


def lookup_blanks(spark, sf):
    src = table(spark, sf, "customer").select("c_custkey", _edge_value().alias("v"))
    return apply_lookup(src, "v", PrefixLookup("p_"))


CALL, CALLERS = 300, 4


def lookup_calls(spark, sf):
    """Several callers: the distinct values of two columns in calls of 300 values, one of them of what is left."""
    sent = lookup_mapping(table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"], SizeLookup(),
                          policy=LookupPolicy(batch_size=CALL), partitions=CALLERS, full_calls=True)
    found = sent.agg(F.count(F.lit(1)).alias("n_values"), F.round(F.sum(1 / F.col("mapped").cast("int"))).alias("n_calls"),
                     F.max(F.col("mapped").cast("long")).alias("largest"))
    none = F.lit(0).cast("long")
    return found.select("n_values", F.coalesce(F.col("n_calls").cast("long"), none).alias("n_calls"),
                        F.coalesce("largest", none).alias("largest"))


def lookup_isolated(spark, sf):
    """A lookup that refuses some values answers all others; bad ones are null, and rows of the reject table."""
    src = table(spark, sf, "customer").select("c_custkey", "c_name")
    rejects = f"{scratch_path(spark, 'rejects')}/values"
    out = apply_lookup(src, "c_name", RefusingLookup(), policy=LookupPolicy(batch_size=CALL, bad_values="reject"),
                       partitions=CALLERS, reject_path=rejects)
    found = out.select("c_custkey", F.substring_index("c_name", "_", -1).alias("c_name"))
    aside = spark.read.parquet(rejects).select(F.col("value"), "reason")
    return found.join(src.select("c_custkey", F.col("c_name").alias("value")), "c_custkey").join(
        aside, "value", "left").select("c_custkey", "c_name", "reason")


def lookup_isolated_calls(spark, sf):
    """What setting values aside costs: calls of all tasks against the bound."""
    sent = lookup_mapping(table(spark, sf, "customer"), "c_name", RefusingLookup(), partitions=CALLERS,
                          policy=LookupPolicy(batch_size=CALL, bad_values="reject"))
    call = F.substring_index("mapped", "_", 1).cast("long")
    tasks = sent.groupBy(F.spark_partition_id().alias("task")).agg(
        F.max(call).alias("calls"), F.count("mapped").alias("good"), F.count("reason").alias("bad"))
    deep = 2 + (CALL - 1).bit_length()
    n = F.sum(F.col("good") + F.col("bad"))
    return tasks.agg(n.alias("n_values"), F.sum("bad").alias("n_rejects"), (
        F.sum("calls") <= F.ceil(n / CALL) + CALLERS + F.sum("bad") * deep).alias("few_calls"))


def lookup_paced(spark, sf):
    """Callers that share one window against a service with a rate limit: all answered, few calls refused."""
    service = LimitedLookup(scratch_path(spark, "service"), limit=24, seconds=0.25)
    mapping = write_scratch(paced_mapping(
        table(spark, sf, "customer"), "c_name", service, CALLERS, pace=Pace(window=8, step=4, seconds=0.25),
        policy=LookupPolicy(batch_size=20)), "paced")
    few = service.count("refused") <= service.count("answered")
    return mapping.select("value", "mapped").withColumn("few_refused", F.lit(few))


def _store(spark, name: str) -> MappingStore:
    base = scratch_path(spark, "store")
    return MappingStore(spark, "cloakline_store_" + base.rsplit("-", 1)[-1], name, base, KR, buckets=16)


def lookup_store(spark, sf):
    """A second run asks only for new values: its answers start with ``b_``, those kept from the first with ``a_``."""
    store = _store(spark, "pseudonyms")
    apply_stored_lookup(table(spark, sf, "customer").select("c_custkey"), "c_custkey", PrefixLookup("a_"), store)
    cols = ["o_custkey", "o_orderpriority"]
    orders = table(spark, sf, "orders").select("o_orderkey", *cols)
    return apply_stored_lookup(orders, cols, PrefixLookup("b_"), store)


def lookup_store_runs(spark, sf):
    """What each of three runs asked for; compacting in between changes nothing."""
    store = _store(spark, "asked")
    lineitem = table(spark, sf, "lineitem")
    apply_stored_lookup(lineitem, "l_suppkey", PrefixLookup("p_"), store, run="1")
    store.compact()
    apply_stored_lookup(lineitem, ["l_suppkey", "l_partkey"], PrefixLookup("p_"), store, run="2", partitions=CALLERS)
    apply_stored_lookup(lineitem, ["l_suppkey", "l_partkey"], PrefixLookup("p_"), store, run="3")
    return store.runs()


def lookup_roundtrip(spark, sf):
    cols = ["o_custkey", "o_orderpriority"]
    src = table(spark, sf, "orders").select("o_orderkey", *cols)
    pseud = apply_lookup(src, cols, PrefixLookup("p_"), partitions=4)
    return apply_lookup(pseud, cols, StripLookup("p_"))


def distinct_requests(spark, sf):
    src = table(spark, sf, "lineitem")
    return lookup_mapping(src, ["l_suppkey", "l_partkey"], PrefixLookup("p_"))


def sql_lookup_function(spark, sf):
    register_lookup_function(spark, "svc_pseudonymize", PrefixLookup("p_"), LookupPolicy(batch_size=300))
    views(spark, sf, "customer")
    return spark.sql(
        """
        SELECT c_custkey, a[0] AS e0, a[1] AS e1
        FROM (SELECT c_custkey, svc_pseudonymize(array(c_name, c_mktsegment)) AS a FROM customer)
        """
    )


def sql_lookup_filter(spark, sf):
    """A filter on the function's own output."""
    register_lookup_function(spark, "svc_pseudonymize", PrefixLookup("p_"), LookupPolicy(batch_size=300))
    views(spark, sf, "customer")
    return spark.sql(
        """
        SELECT c_custkey, found[0] AS e0
        FROM (SELECT c_custkey, svc_pseudonymize(array(c_name, c_mktsegment)) AS found FROM customer)
        WHERE found[1] LIKE 'p_%E%'
        """
    )


# -------------------------------------------------------------------- SQL surface


def sql_array_roundtrip(spark, sf):
    register_functions(spark, KR)
    views(spark, sf, "customer")
    return spark.sql(
        """
        SELECT c_custkey, r[0] AS e0, r[1] AS e1, CAST(size(r) AS BIGINT) AS n, p[0] = p[2] AS stable
        FROM (SELECT c_custkey, p, reidentify(p) AS r
              FROM (SELECT c_custkey, pseudonymize(array(c_name, c_mktsegment, c_name), 'true') AS p
                    FROM customer))
        """
    )


def sql_array_random(spark, sf):
    register_functions(spark, KR)
    views(spark, sf, "customer")
    return spark.sql(
        """
        SELECT c_custkey, r[0] AS e0, r[1] AS e1, p[0] <> p[1] AS differs
        FROM (SELECT c_custkey, p, reidentify(p) AS r
              FROM (SELECT c_custkey, pseudonymize(array(c_name, c_name), 'false') AS p FROM customer))
        """
    )


def sql_json_roundtrip(spark, sf):
    register_functions(spark, KR)
    views(spark, sf, "customer")
    return spark.sql(
        """
        SELECT c_custkey,
               reidentify_json(pseudonymize_json(to_json(array(c_name, c_mktsegment)), 'true')) AS j
        FROM customer
        """
    )


def _pseudo_events(spark, sf) -> None:
    """The reference's ``pseudo_table``: dept_id = event_type, s_vin = s_user_id."""
    src = table(spark, sf, "events").select("event_id", "event_type", "user_id")
    rename_with_prefix(pseudonymize(src, "user_id", KR), ["user_id"]).createOrReplaceTempView(
        "pseudo_events"
    )


def sql_group_reidentify(spark, sf):
    register_functions(spark, KR)
    _pseudo_events(spark, sf)
    grouped = group_arrays(spark.table("pseudo_events"), "event_type", "s_user_id",
                           batch_size=BATCH, out_col="s_vins")
    grouped.createOrReplaceTempView("grouped_s_vins")
    return spark.sql(
        f"""
        SELECT event_type,
               CAST(sum(size(vins)) AS BIGINT) AS n_values,
               sum(aggregate(vins, 0L, (acc, x) -> acc + CAST(x AS BIGINT))) AS id_sum,
               min(array_min(transform(vins, x -> CAST(x AS BIGINT)))) AS id_min,
               max(array_max(transform(vins, x -> CAST(x AS BIGINT)))) AS id_max,
               max(size(vins)) <= {BATCH} AS chunks_ok
        FROM (SELECT event_type, reidentify(s_vins) AS vins FROM grouped_s_vins)
        GROUP BY event_type
        """
    )


def sql_chunked_groups(spark, sf):
    """The reference's grouped query in plain SQL, each group cut into arrays of <= 900 by ``chunk_of``."""
    register_functions(spark, KR)
    _pseudo_events(spark, sf)
    return spark.sql(
        f"""
        WITH numbered AS (
          SELECT event_type, s_user_id, monotonically_increasing_id() AS rid
          FROM (SELECT event_type, s_user_id FROM pseudo_events SORT BY event_type, s_user_id)
        ), chunks AS (
          SELECT event_type, reidentify(array_agg(s_user_id)) AS vins
          FROM numbered GROUP BY event_type, chunk_of(rid, {BATCH})
        )
        SELECT event_type,
               CAST(sum(size(vins)) AS BIGINT) AS n_values,
               sum(aggregate(vins, 0L, (acc, x) -> acc + CAST(x AS BIGINT))) AS id_sum,
               min(array_min(transform(vins, x -> CAST(x AS BIGINT)))) AS id_min,
               max(array_max(transform(vins, x -> CAST(x AS BIGINT)))) AS id_max,
               max(size(vins)) <= {BATCH} AS chunks_ok
        FROM chunks GROUP BY event_type
        """
    )


FLAGS = ("A", "N", "R")


def _pseudo_lines(spark, sf) -> None:
    """``pseudo_lines(l_returnflag, p)``: pseudonyms of ``<flag>-<order>-<line>``."""
    name = F.concat_ws("-", "l_returnflag", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    src = table(spark, sf, "lineitem").select("l_returnflag", name.alias("p"))
    pseudonymize(src, "p", KR).createOrReplaceTempView("pseudo_lines")


def _limited_groups(spark, sf, flags) -> DataFrame:
    """At most LIMIT rows of each flag, revealed as one array, with a check of every element."""
    register_functions(spark, KR)
    _pseudo_lines(spark, sf)
    picked = "\nUNION ALL\n".join(
        f"(SELECT * FROM pseudo_lines WHERE l_returnflag = '{x}' LIMIT {LIMIT})" for x in flags)
    return spark.sql(
        f"""
        SELECT l_returnflag, CAST(size(names) AS BIGINT) AS n_values,
               forall(names, x -> startswith(x, l_returnflag || '-')) AS own_group
        FROM (SELECT l_returnflag, reidentify(collect_list(p)) AS names FROM ({picked}) GROUP BY l_returnflag)
        """
    )


def sql_filter_limit(spark, sf):
    return _limited_groups(spark, sf, FLAGS[1:2])


def sql_union_groups(spark, sf):
    return _limited_groups(spark, sf, FLAGS)


# ------------------------------------------------------------------ grouping ops


def top_per_group(spark, sf):
    _pseudo_events(spark, sf)
    top = n_per_group(spark.table("pseudo_events"), "event_type", "event_id", 5)
    back = reidentify(top, "s_user_id", KR)
    return back.select("event_type", "event_id", F.col("s_user_id").cast("long").alias("user_id"))


def chunked_groups(spark, sf):
    src = pseudonymize(table(spark, sf, "lineitem").select("l_returnflag", "l_suppkey"), "l_suppkey", KR)
    arrays = group_reidentify(src, "l_returnflag", "l_suppkey", KR, batch_size=BATCH, out_col="vals")
    per = arrays.select(
        "l_returnflag", F.size("vals").alias("size"),
        F.aggregate("vals", F.lit(0).cast("long"), lambda acc, x: acc + x.cast("long")).alias("s"),
    )
    return per.groupBy("l_returnflag").agg(
        F.sum("size").cast("long").alias("n_values"),
        F.sum("s").alias("id_sum"),
        ((F.max("size") <= BATCH) & (F.count(F.lit(1)) >= F.ceil(F.sum("size") / BATCH))).alias("chunks_ok"),
    )


# ------------------------------------------------------------ sources and sinks


def csv_roundtrip(spark, sf):
    base = scratch_path(spark, "csv")
    src = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    src.write.mode("overwrite").option("header", True).csv(f"{base}/in")
    job = CsvJob.from_dict(
        {"input_loc": f"{base}/in", "output_loc": f"{base}/out", "input_column": "c_name",
         "repartition_no": 1, "determinism": True}
    )
    run_csv_batch(spark, job, keyring=KR)
    out = spark.read.parquet(f"{base}/out")
    return reidentify(out, "s_c_name", KR).select("c_custkey", F.col("s_c_name").alias("c_name"), "c_mktsegment")


EVENT_SCHEMA = "event_id bigint, user_id bigint, event_type string"


def _event_json(spark, sf):
    src = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return src.select(F.to_json(F.struct("event_id", "user_id", "event_type")).alias("value"), "event_type")


def json_roundtrip(spark, sf):
    base = scratch_path(spark, "json")
    _event_json(spark, sf).select("value").write.mode("overwrite").text(f"{base}/in")
    src = read_json_lines(spark, f"{base}/in", EVENT_SCHEMA).drop("_corrupt_record")
    back = reidentify(pseudonymize(src, "user_id", KR), "user_id", KR)
    return back


def table_append(spark, sf):
    base = scratch_path(spark, "table")
    db = "cloakline_" + base.rsplit("-", 1)[-1]
    job = BatchJob.from_dict(
        {"input_s3_path": f"{sf.rstrip('/')}/supplier.parquet", "input_column": "s_name",
         "db_name": db, "table_name": "pseudo_table", "output_bucket_name": base, "determinism": True}
    )
    name = run_batch(spark, job, keyring=KR)
    run_batch(spark, job, keyring=KR)
    out = reidentify(spark.table(name), "s_s_name", KR)
    return out.groupBy("s_suppkey", F.col("s_s_name").alias("s_name")).agg(F.count(F.lit(1)).alias("n"))


def records_append(spark, sf):
    """A job that failed and is run again, and again: each of its rows is there once."""
    base = scratch_path(spark, "records")
    conf = {"input_s3_path": f"{sf.rstrip('/')}/supplier.parquet", "input_column": "s_name", "db_name": "committed",
            "table_name": "pseudo_table", "output_bucket_name": base, "determinism": True}
    path = f"{base}/batch/warehouse/committed/pseudo_table"
    src = table(spark, sf, "supplier")
    last = src.agg(F.max("s_suppkey")).first()[0]
    broken = pseudonymize(src, "s_name", KR).withColumnRenamed("s_name", "s_s_name").withColumn(
        "s_suppkey", F.when(F.col("s_suppkey") == last, F.raise_error(F.lit("the job's machine is gone")).cast(
            "long")).otherwise(F.col("s_suppkey")))
    failed = False
    try:
        write_records(broken, path, "load-1")
    except SparkRuntimeException:
        failed = True
    for commit in ("load-1", "load-1", "load-2"):
        run_batch(spark, BatchJob.from_dict(conf, commit_id=commit), keyring=KR)
    folder = RecordFolder(path)
    out = reidentify(read_records(spark, path), "s_s_name", KR).groupBy("s_suppkey", F.col("s_s_name").alias("s_name"))
    folder.vacuum(older_than_s=0)
    clean = failed and len(folder.entries()) == 2
    return out.agg(F.count(F.lit(1)).alias("n")).withColumn("clean", F.lit(clean))


#: The event types that come first and second in the record folder; all others come third.
FIRST, SECOND = "click", "view"


def stream_records(spark, sf):
    """Three appends of events, read from the earliest, the latest, and the second one on, with restarts."""
    base = scratch_path(spark, "records")
    db = "cloakline_" + base.rsplit("-", 1)[-1]
    lines = _event_json(spark, sf)
    kind = F.coalesce("event_type", F.lit(""))

    def append(commit: str, which) -> None:
        write_records(lines.where(which).select("value"), f"{base}/in", commit)

    def read(name: str, start: str) -> DataFrame:
        job = StreamJob.from_dict(
            {"input_path": f"{base}/in", "input_column": "user_id", "schema": EVENT_SCHEMA, "output_root": base,
             "db_name": db, "table_name": name, "source_format": "records", "starting_position": start})
        run_stream(spark, job, available_now=True, keyring=KR).awaitTermination()
        return spark.table(f"{db}.{name}")

    append("1", kind == FIRST)
    read("everything", "earliest")
    append("2", kind == SECOND)
    read("new_ones", "latest")
    append("3", ~kind.isin(FIRST, SECOND))
    found = [read("everything", "earliest"), read("new_ones", "latest"), read("from_second", "1")]
    rows = [reidentify(df, "s_user_id", KR).select(F.lit(i).alias("reader"), "event_type", F.col("s_user_id").cast("long"))
            for i, df in enumerate(found)]
    both = rows[0].unionAll(rows[1]).unionAll(rows[2])
    return both.groupBy("reader", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("s_user_id").alias("id_sum"))


# Lines of this event type are written truncated (invalid JSON) in the reject fixture.
CORRUPT_TYPE = "error"


def _stream_input(spark, sf, corrupt: bool = False) -> str:
    base = scratch_path(spark, "stream")
    lines = _event_json(spark, sf)
    if corrupt:
        bad = F.col("event_type") == CORRUPT_TYPE
        lines = lines.select(
            F.when(bad, F.expr("substring(value, 1, length(value) - 3)")).otherwise(F.col("value")).alias("value")
        )
    lines.select("value").write.mode("overwrite").text(f"{base}/in")
    return base


def stream_roundtrip(spark, sf):
    base = _stream_input(spark, sf)
    db = "cloakline_" + base.rsplit("-", 1)[-1]
    job = StreamJob.from_dict(
        {"input_path": f"{base}/in", "input_column": "user_id", "schema": EVENT_SCHEMA,
         "output_root": base, "db_name": db, "table_name": "pseudo_table",
         "checkpoint": f"{base}/ck"}
    )
    q = run_stream(spark, job, available_now=True, keyring=KR)
    q.awaitTermination()
    out = spark.table(f"{db}.pseudo_table")
    back = reidentify(out, "s_user_id", KR)
    return back.select("event_id", F.col("s_user_id").alias("user_id"), "event_type")


def stream_rejects(spark, sf):
    base = _stream_input(spark, sf, corrupt=True)
    db = "cloakline_" + base.rsplit("-", 1)[-1]
    job = StreamJob.from_dict(
        {"input_path": f"{base}/in", "input_column": "user_id", "schema": EVENT_SCHEMA,
         "output_root": base, "db_name": db, "table_name": "pseudo_table",
         "checkpoint": f"{base}/ck", "reject_path": f"{base}/rejects"}
    )
    q = run_stream(spark, job, available_now=True, keyring=KR)
    q.awaitTermination()
    return _both_sides(spark, base, db)


def _both_sides(spark, base, db):
    good = spark.table(f"{db}.pseudo_table")
    rejects = spark.read.parquet(f"{base}/rejects")
    # One union and one aggregate (no join): both counts in one row.
    flags = good.select(F.lit(False).alias("rejected")).unionByName(
        rejects.select(F.lit(True).alias("rejected"))
    )
    return flags.agg(
        F.count_if(~F.col("rejected")).alias("n_good"),
        F.count_if(F.col("rejected")).alias("n_rejects"),
    )


def stream_lookup(spark, sf):
    base = _stream_input(spark, sf)
    db = "cloakline_" + base.rsplit("-", 1)[-1]
    job = StreamJob.from_dict(
        {"input_path": f"{base}/in", "input_column": "user_id", "schema": EVENT_SCHEMA,
         "output_root": base, "db_name": db, "table_name": "pseudo_table",
         "checkpoint": f"{base}/ck", "reject_path": f"{base}/rejects", "mode": "service",
         "endpoint_url": "https://service.invalid/Dev/pseudonymization"}
    )
    q = run_stream(spark, job, available_now=True, lookup=PrefixLookup("p_"))
    q.awaitTermination()
    return spark.table(f"{db}.pseudo_table").select("event_id", "s_user_id", "event_type")


def stream_lookup_rejects(spark, sf):
    base = _stream_input(spark, sf, corrupt=True)
    db = "cloakline_" + base.rsplit("-", 1)[-1]
    job = StreamJob.from_dict(
        {"input_path": f"{base}/in", "input_column": "user_id", "schema": EVENT_SCHEMA,
         "output_root": base, "db_name": db, "table_name": "pseudo_table", "reject_path": f"{base}/rejects",
         "mode": "service", "endpoint_url": "https://service.invalid/Dev/pseudonymization"}
    )
    run_stream(spark, job, available_now=True, lookup=PrefixLookup("p_")).awaitTermination()
    return _both_sides(spark, base, db)


def _open_records(spark, sf) -> DataFrame:
    """Events with nested fields and some that no schema names; those of one type are cut off."""
    # Records are dealt out: a scan has as many tasks with rows as its files have row groups.
    e = spread(table(spark, sf, "events"), 4 * spark.sparkContext.defaultParallelism)
    whole = F.to_json(F.struct(
        "event_id", "user_id", "event_type", F.struct(F.col("user_id").cast("string").alias("id"), "props").alias("who"),
        F.array(F.struct(F.col("user_id").alias("u"), F.lit(1).alias("n")),
                F.struct(F.lit(None).cast("long").alias("u"), F.lit(2).alias("n"))).alias("seen"),
        F.map_from_arrays(F.array(F.concat(F.lit("extra_"), "event_type")), F.array("value")).alias("more")))
    bad = F.coalesce(F.col("event_type") == CORRUPT_TYPE, F.lit(False))
    return e.select(F.when(bad, F.substring(whole, 1, 30)).otherwise(whole).alias("value"))


SECRET_PATHS = ["user_id", "who.id", "seen[].u"]


def variant_roundtrip(spark, sf):
    """Identifiers of records that no schema describes, sealed and revealed; all other fields survive."""
    records = parse_records(_open_records(spark, sf)).where("record IS NOT NULL").select("record")
    sealed = pseudonymize_records(records, "record", SECRET_PATHS, KR)
    linked = F.expr("variant_get(record, '$.user_id', 'string') = '~' || variant_get(record, '$.who.id', 'string')")
    back = reidentify_records(sealed.withColumn("linked", linked), "record", SECRET_PATHS, KR)
    get = lambda path, kind: F.expr(f"variant_get(record, '{path}', '{kind}')")
    more = F.map_values(F.expr("cast(variant_get(record, '$.more') as map<string,double>)"))[0]
    return back.select(
        get("$.event_id", "bigint").alias("event_id"), get("$.user_id", "bigint").alias("user_id"),
        get("$.who.id", "string").alias("who_id"), get("$.who.props", "string").alias("props"),
        get("$.seen[0].u", "bigint").alias("seen_u"), get("$.seen[0].n", "bigint").alias("seen_n"),
        get("$.event_type", "string").alias("event_type"), more.alias("value"), "linked")


def variant_rejects(spark, sf):
    found = parse_records(_open_records(spark, sf))
    return found.agg(F.count("record").alias("n_good"), F.count("_corrupt_record").alias("n_rejects"))


def stream_metrics(spark, sf):
    """Counters of each micro-batch, as the listener kept them."""
    base = _stream_input(spark, sf)
    spark.read.text(f"{base}/in").repartition(4).write.text(f"{base}/parts")
    db = "cloakline_" + base.rsplit("-", 1)[-1]
    job = StreamJob.from_dict(
        {"input_path": f"{base}/parts", "input_column": "user_id", "schema": EVENT_SCHEMA, "output_root": base, "db_name": db,
         "table_name": "pseudo_table", "source_options": {"maxFilesPerTrigger": "1"}})
    with kept_metrics(spark, f"{base}/metrics"):
        run_stream(spark, job, available_now=True, keyring=KR, metrics="seen").awaitTermination()
    kept = read_metrics(spark, f"{base}/metrics").where("metric LIKE 'seen.%' OR metric = 'input_rows'")
    return kept.groupBy("metric").agg(F.sum("value").cast("long").alias("total"), F.count_if(F.col("value") > 0).alias("n_batches"))


def stream_lookup_store(spark, sf):
    """Several micro-batches over one store: every user is asked for once."""
    base = _stream_input(spark, sf)
    spark.read.text(f"{base}/in").repartition(4).write.text(f"{base}/parts")
    db = "cloakline_" + base.rsplit("-", 1)[-1]
    store = _store(spark, "users")
    job = StreamJob.from_dict(
        {"input_path": f"{base}/parts", "input_column": "user_id", "schema": EVENT_SCHEMA,
         "output_root": base, "db_name": db, "table_name": "pseudo_table", "mode": "service",
         "source_options": {"maxFilesPerTrigger": "1"},
         "endpoint_url": "https://service.invalid/Dev/pseudonymization"}
    )
    run_stream(spark, job, available_now=True, lookup=PrefixLookup("p_"), store=store).awaitTermination()
    out = spark.table(f"{db}.pseudo_table")
    asked = store.runs().agg(F.sum("n").alias("n_asked"))
    return out.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("s_user_id").alias("n_users"),
        F.countDistinct("batch_id").alias("n_batches"),
        F.sum(F.substring("s_user_id", 3, 40).cast("long")).alias("id_sum")).join(asked)


QUERIES: dict[str, Query] = {
    "roundtrip_customer": roundtrip_customer,
    "roundtrip_random": roundtrip_random,
    "roundtrip_multi_column": roundtrip_multi_column,
    "roundtrip_long_text": roundtrip_long_text,
    "roundtrip_documents": roundtrip_documents,
    "injective_counts": injective_counts,
    "group_sizes": group_sizes,
    "linked_join": linked_join,
    "deterministic_iv": deterministic_iv,
    "blank_null_policy": blank_null_policy,
    "null_as_text": null_as_text,
    "random_run_linkage": random_run_linkage,
    "reveal_filtered_group": reveal_filtered_group,
    "roundtrip_binary": roundtrip_binary,
    "find_identifiers": find_identifiers,
    "sql_find_identifiers": sql_find_identifiers,
    "nested_roundtrip": nested_roundtrip,
    "key_versions": key_versions,
    "stream_reseal": stream_reseal,
    "lookup_blanks": lookup_blanks,
    "lookup_calls": lookup_calls,
    "lookup_isolated": lookup_isolated,
    "lookup_isolated_calls": lookup_isolated_calls,
    "sql_lookup_filter": sql_lookup_filter,
    "stream_lookup_rejects": stream_lookup_rejects,
    "lookup_paced": lookup_paced,
    "lookup_store": lookup_store,
    "lookup_store_runs": lookup_store_runs,
    "stream_lookup_store": stream_lookup_store,
    "lookup_join": lookup_join,
    "lookup_retry": lookup_retry,
    "lookup_roundtrip": lookup_roundtrip,
    "distinct_requests": distinct_requests,
    "sql_lookup_function": sql_lookup_function,
    "sql_array_roundtrip": sql_array_roundtrip,
    "sql_array_random": sql_array_random,
    "sql_json_roundtrip": sql_json_roundtrip,
    "sql_group_reidentify": sql_group_reidentify,
    "sql_chunked_groups": sql_chunked_groups,
    "sql_filter_limit": sql_filter_limit,
    "sql_union_groups": sql_union_groups,
    "top_per_group": top_per_group,
    "chunked_groups": chunked_groups,
    "csv_roundtrip": csv_roundtrip,
    "json_roundtrip": json_roundtrip,
    "variant_roundtrip": variant_roundtrip,
    "variant_rejects": variant_rejects,
    "stream_metrics": stream_metrics,
    "table_append": table_append,
    "records_append": records_append,
    "stream_records": stream_records,
    "stream_roundtrip": stream_roundtrip,
    "stream_rejects": stream_rejects,
    "stream_lookup": stream_lookup,
}


# ------------------------------------------------------------------------ oracles


def _len_law(col: str) -> str:
    return f"CAST(4 * ceil((28 + octet_length(encode({col}))) / 3) AS BIGINT)"


def _edge_sql() -> str:
    return (
        "CASE c_custkey % 8 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '   ' "
        "WHEN 3 THEN chr(9) || chr(10) WHEN 4 THEN 'None' WHEN 5 THEN chr(160) || chr(12288) "
        "WHEN 6 THEN ' ' || c_name || ' ' ELSE c_name END"
    )


def _limited(flags) -> str:
    return (f"SELECT l_returnflag, CAST(least(count(*), {LIMIT}) AS BIGINT) AS n_values, TRUE AS own_group "
            f"FROM lineitem WHERE l_returnflag IN {tuple(flags) + ('',)} GROUP BY l_returnflag")


def oracles() -> dict[str, str]:
    ip, op = KR.ipad.hex(), KR.opad.hex()
    hmac_hex = f"sha256(unhex('{op}') || unhex(sha256(unhex('{ip}') || encode(c_name))))"
    edge = _edge_sql()
    return {
        "roundtrip_customer": f"SELECT c_custkey, c_name, {_len_law('c_name')} AS pseudonym_len, "
                              "TRUE AS changed FROM customer",
        "roundtrip_random": "SELECT c_custkey, c_name, TRUE AS differs FROM customer",
        "roundtrip_multi_column": "SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type, props "
                                  "FROM events",
        "roundtrip_long_text": f"SELECT conv_id, turn, text, {_len_law('text')} AS pseudonym_len "
                               "FROM conversations",
        "roundtrip_documents": "SELECT doc_id, text, TRUE AS length_law FROM documents",
        "injective_counts": "SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_orders, "
                            "count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_suppkey) AS n_suppliers "
                            "FROM lineitem",
        "group_sizes": "SELECT user_id, count(*) AS n FROM events GROUP BY user_id",
        "linked_join": "SELECT c_mktsegment, count(*) AS n_orders, "
                       "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price "
                       "FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment",
        "deterministic_iv": f"SELECT c_custkey, substr({hmac_hex}, 1, 24) AS iv_hex FROM customer",
        "blank_null_policy": f"SELECT c_custkey, CASE WHEN v IS NULL THEN 'null' WHEN v IN ('', '   ', "
                             "chr(9) || chr(10), chr(160) || chr(12288)) THEN 'blank' ELSE 'sealed' END AS kind, "
                             "CASE WHEN v IS NULL THEN NULL WHEN v IN ('', '   ', chr(9) || chr(10), "
                             "chr(160) || chr(12288)) THEN '' ELSE v END AS value "
                             f"FROM (SELECT c_custkey, {edge} AS v FROM customer)",
        "null_as_text": "SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'None' ELSE c_name END AS value "
                        "FROM customer",
        "random_run_linkage": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey",
        "reveal_filtered_group": "SELECT l_returnflag, count(*) AS n, CAST(sum(l_suppkey) AS BIGINT) AS id_sum "
                                 "FROM lineitem WHERE l_returnflag <> 'R' GROUP BY l_returnflag",
        "roundtrip_binary": "SELECT c_custkey, 'FF00FE' || hex(encode(c_name)) AS hex FROM customer",
        "find_identifiers": f"SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN {SOUGHT}",
        "sql_find_identifiers": f"SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders "
                                f"WHERE o_custkey = {SOUGHT[1]}",
        "nested_roundtrip": "SELECT o_orderkey, CAST(any_value(o_custkey) AS VARCHAR) AS o_custkey, "
                            "any_value(o_orderstatus) AS o_orderstatus, CAST(sum(l_suppkey) AS BIGINT) AS supp_sum, "
                            "CAST(sum(l_linenumber) AS BIGINT) AS line_sum, CAST(sum(l_partkey) AS BIGINT) AS part_sum, "
                            "CASE WHEN count(l_orderkey) > 0 THEN count(l_orderkey) * (count(l_orderkey) + 1) // 2 END AS key_sum, "
                            "FALSE AS plain "
                            "FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey",
        "key_versions": "SELECT c_custkey, c_name, CASE WHEN c_mktsegment < 'F' THEN '2023' ELSE '2024' END AS key "
                        "FROM customer",
        "stream_reseal": "SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type FROM events",
        "lookup_blanks": "SELECT c_custkey, CASE WHEN v IS NULL THEN NULL WHEN v IN ('', '   ', chr(9) || chr(10), "
                         "chr(160) || chr(12288)) THEN '' ELSE 'p_' || v END AS v "
                         f"FROM (SELECT c_custkey, {edge} AS v FROM customer)",
        "lookup_calls": f"SELECT count(*) AS n_values, CAST(ceil(count(*) / {CALL}) AS BIGINT) AS n_calls, "
                        f"CAST(least(count(*), {CALL}) AS BIGINT) AS largest FROM ("
                        "SELECT CAST(l_suppkey AS VARCHAR) FROM lineitem UNION "
                        "SELECT CAST(l_partkey AS VARCHAR) FROM lineitem)",
        "lookup_isolated": "SELECT c_custkey, CASE WHEN c_name NOT LIKE '%13' THEN c_name END AS c_name, "
                           "CASE WHEN c_name LIKE '%13' THEN 'a value is refused' END AS reason FROM customer",
        "lookup_isolated_calls": "SELECT count(DISTINCT c_name) AS n_values, "
                                 "count(DISTINCT CASE WHEN c_name LIKE '%13' THEN c_name END) AS n_rejects, "
                                 "TRUE AS few_calls FROM customer",
        "sql_lookup_filter": "SELECT c_custkey, 'p_' || c_name AS e0 FROM customer WHERE c_mktsegment LIKE '%E%'",
        "stream_lookup_rejects": f"SELECT count(*) FILTER (WHERE event_type IS DISTINCT FROM '{CORRUPT_TYPE}') AS n_good, "
                                 f"count(*) FILTER (WHERE event_type = '{CORRUPT_TYPE}') AS n_rejects FROM events",
        "lookup_paced": "SELECT DISTINCT c_name AS value, 'p_' || c_name AS mapped, TRUE AS few_refused FROM customer "
                        "WHERE c_name IS NOT NULL",
        "variant_roundtrip": "SELECT event_id, user_id, CAST(user_id AS VARCHAR) AS who_id, props, user_id AS seen_u, "
                             "CAST(1 AS BIGINT) AS seen_n, event_type, value, TRUE AS linked FROM events "
                             f"WHERE event_type IS DISTINCT FROM '{CORRUPT_TYPE}'",
        "variant_rejects": f"SELECT count(*) FILTER (WHERE event_type IS DISTINCT FROM '{CORRUPT_TYPE}') AS n_good, "
                           f"count(*) FILTER (WHERE event_type = '{CORRUPT_TYPE}') AS n_rejects FROM events",
        "stream_metrics": "SELECT 'input_rows' AS metric, count(*) AS total, CAST(4 AS BIGINT) AS n_batches FROM events UNION ALL "
                          "SELECT 'seen.rows', count(*), 4 FROM events UNION ALL "
                          "SELECT 'seen.user_id_nulls', count(*) - count(user_id), 0 FROM events UNION ALL "
                          "SELECT 'seen.user_id_blanks', 0, 0",
        "lookup_store": "SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer) THEN 'a_' ELSE 'b_' "
                        "END || CAST(o_custkey AS VARCHAR) AS o_custkey, 'b_' || o_orderpriority AS o_orderpriority "
                        "FROM orders",
        "lookup_store_runs": "SELECT '1' AS run, count(DISTINCT l_suppkey) AS n FROM lineitem UNION ALL "
                             "SELECT '2', count(DISTINCT l_partkey) FROM lineitem "
                             "WHERE l_partkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_suppkey IS NOT NULL)",
        "stream_lookup_store": "SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_users, CAST(4 AS BIGINT) AS n_batches, "
                               "CAST(sum(user_id) AS BIGINT) AS id_sum, CAST(count(DISTINCT user_id) AS BIGINT) AS n_asked "
                               "FROM events",
        "lookup_join": "SELECT o_orderkey, 'p_' || CAST(o_custkey AS VARCHAR) AS o_custkey, "
                       "'p_' || o_orderstatus AS o_orderstatus, 'p_' || o_orderpriority AS o_orderpriority "
                       "FROM orders",
        "lookup_retry": "SELECT c_custkey, 'p3_' || c_name AS c_name, 'p3_' || c_mktsegment AS c_mktsegment "
                        "FROM customer",
        "lookup_roundtrip": "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderpriority "
                            "FROM orders",
        "distinct_requests": "SELECT value, 'p_' || value AS mapped FROM ("
                             "SELECT CAST(l_suppkey AS VARCHAR) AS value FROM lineitem UNION "
                             "SELECT CAST(l_partkey AS VARCHAR) AS value FROM lineitem)",
        "sql_lookup_function": "SELECT c_custkey, 'p_' || c_name AS e0, 'p_' || c_mktsegment AS e1 FROM customer",
        "sql_array_roundtrip": "SELECT c_custkey, c_name AS e0, c_mktsegment AS e1, CAST(3 AS BIGINT) AS n, "
                               "TRUE AS stable FROM customer",
        "sql_array_random": "SELECT c_custkey, c_name AS e0, c_name AS e1, TRUE AS differs FROM customer",
        "sql_json_roundtrip": "SELECT c_custkey, CAST(to_json([c_name, c_mktsegment]) AS VARCHAR) AS j "
                              "FROM customer",
        "sql_group_reidentify": "SELECT event_type, count(*) AS n_values, CAST(sum(user_id) AS BIGINT) AS id_sum, "
                                "min(user_id) AS id_min, max(user_id) AS id_max, TRUE AS chunks_ok "
                                "FROM events GROUP BY event_type",
        "sql_chunked_groups": "SELECT event_type, count(*) AS n_values, CAST(sum(user_id) AS BIGINT) AS id_sum, "
                              "min(user_id) AS id_min, max(user_id) AS id_max, TRUE AS chunks_ok "
                              "FROM events WHERE user_id IS NOT NULL GROUP BY event_type",
        "sql_filter_limit": _limited(FLAGS[1:2]),
        "sql_union_groups": _limited(FLAGS),
        "top_per_group": "SELECT event_type, event_id, user_id FROM (SELECT event_type, event_id, user_id, "
                         "row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events) "
                         "WHERE rn <= 5",
        "chunked_groups": "SELECT l_returnflag, count(*) AS n_values, CAST(sum(l_suppkey) AS BIGINT) AS id_sum, "
                          "TRUE AS chunks_ok FROM lineitem GROUP BY l_returnflag",
        "csv_roundtrip": "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer",
        "json_roundtrip": "SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type FROM events",
        "table_append": "SELECT s_suppkey, s_name, CAST(2 AS BIGINT) AS n FROM supplier",
        "records_append": "SELECT s_suppkey, s_name, CAST(2 AS BIGINT) AS n, TRUE AS clean FROM supplier",
        "stream_records": f"SELECT reader, event_type, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS id_sum "
                          f"FROM events, (SELECT unnest([0, 1, 2])::INT AS reader) WHERE reader = 0 "
                          f"OR (reader = 1 AND coalesce(event_type, '') NOT IN ('{FIRST}', '{SECOND}')) "
                          f"OR (reader = 2 AND coalesce(event_type, '') <> '{FIRST}') GROUP BY reader, event_type",
        "stream_roundtrip": "SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type FROM events",
        "stream_lookup": "SELECT event_id, 'p_' || CAST(user_id AS VARCHAR) AS s_user_id, event_type FROM events",
        "stream_rejects": f"SELECT count(*) FILTER (WHERE event_type IS DISTINCT FROM '{CORRUPT_TYPE}') AS n_good, "
                          f"count(*) FILTER (WHERE event_type = '{CORRUPT_TYPE}') AS n_rejects FROM events",
    }
