"""Service mode: pseudonyms from a pluggable batched ``Lookup``.

Plan: the distinct values of all chosen columns with a column mask (one
partial + final aggregate, so a hot value collapses map-side) ->
``mapInPandas`` skipping blank values and sending size-bounded batches to the
lookup with bounded retries -> the mapping is written as a Parquet table to
the shared folder (each value is sent at least once, again only if a task is
retried, and an executor loss re-reads the mapping instead of calling again)
-> joined back per column, each column with only its own values. The table's
keys are salted digests, the salt is drawn per call and stays in the plan: the
folder never holds values beside their answers. Sides are broadcast while
their measured sizes together stay under a bound; the others are sort-merge
joins whose hot values AQE splits, and rows without a value are spread.

A ``Lookup`` is any picklable callable ``list[str] -> list[str]`` of the same
length (one answer per value, in order). It may raise ``RetryableError`` or
return ``None`` to ask for a retry. A null among the answers fails the job
unless the policy says ``null_answers='null'``.

With ``bad_values='reject'`` no single value fails the job: a call that is
refused or answered wrongly is halved until the value at fault stands alone
(``isolated_answers``). It becomes null in its rows and a row of the reject
table; every other value is answered.
"""

from __future__ import annotations

import json
import secrets
import time
import urllib.error
import urllib.parse
import urllib.request
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cloakline.functions.crypto import NULL_TEXT, has_text, may_be_blank, text_of, utf8
from cloakline.operators.table import as_list, column_types, quote
from cloakline.session import ship_package, write_scratch

Lookup = Callable[[list[str]], list[str] | None]

MAPPING_SCHEMA = "value string, mapped string"
REJECT_SCHEMA = "value string, reason string"
# Columns whose index is at or over this share one "all columns" mask bit pattern.
MASK_BITS = 62
#: Hash buckets in which distinct values are numbered.
LOT_BUCKETS = 1024


class RetryableError(Exception):
    """Raised by a lookup for a transient failure (throttling, timeout)."""


class LookupFailed(RuntimeError):
    """The lookup kept failing, or answered with a malformed result."""


class WrongAnswer(LookupFailed):
    """An answer that does not fit the call."""


class RefusedError(Exception):
    """Raised by a lookup for a call that holds a value it will never answer."""


class TooLargeError(Exception):
    """Raised by a lookup for a call over its size limit."""


@dataclass(frozen=True)
class LookupPolicy:
    """Batching and retry limits of one lookup call.

    ``max_bytes`` bounds the UTF-8 payload of the values of one call (plus 3
    bytes of JSON framing per value); the reference's SQL function host
    rejected requests over 6,291,456 bytes. ``bad_values='reject'`` sets values
    aside that the lookup refuses, answers wrongly or finds too large, instead
    of failing; ``max_rejects`` fails a task that sets aside more.
    """

    batch_size: int = 900
    max_bytes: int = 6_000_000
    max_retries: int = 100
    backoff_base: float = 0.05
    backoff_cap: float = 5.0
    null_answers: str = "fail"  # or "null": the value becomes null
    bad_values: str = "fail"  # or "reject"
    max_rejects: int | None = None

    def __post_init__(self):
        if self.bad_values not in ("fail", "reject"):
            raise ValueError("bad_values must be 'fail' or 'reject'")
        if self.null_answers not in ("fail", "null"):
            raise ValueError("null_answers must be 'fail' or 'null'")
        if self.batch_size < 1 or self.max_bytes < 1 or self.max_retries < 0:
            raise ValueError("batch_size and max_bytes must be positive, max_retries >= 0")


def value_cost(value: str) -> int:
    return len(value.encode("utf-8")) + 3


def batches(values: Iterable[str], policy: LookupPolicy) -> Iterator[list[str]]:
    """Group values into calls of at most ``batch_size`` values and ``max_bytes``."""
    batch: list[str] = []
    size = 0
    for v in values:
        cost = value_cost(v)
        if cost > policy.max_bytes:
            raise LookupFailed(f"one value of {cost} bytes exceeds max_bytes={policy.max_bytes}")
        if batch and (len(batch) >= policy.batch_size or size + cost > policy.max_bytes):
            yield batch
            batch, size = [], 0
        batch.append(v)
        size += cost
    if batch:
        yield batch


def fitting(result, batch: list[str], policy: LookupPolicy) -> list:
    """The answers of one call, if they fit it."""
    if not isinstance(result, list):
        raise WrongAnswer(f"lookup returned {type(result).__name__}, not a list")
    if len(result) != len(batch):
        raise WrongAnswer(f"lookup returned {len(result)} answers for {len(batch)} values")
    if policy.null_answers == policy.bad_values == "fail" and any(r is None for r in result):
        raise WrongAnswer(f"lookup returned null for {sum(r is None for r in result)} values")
    return [None if r is None else str(r) for r in result]


def call_with_retry(lookup: Lookup, batch: list[str], policy: LookupPolicy,
                    sleep: Callable[[float], None] = time.sleep) -> list[str]:
    """One lookup call with bounded, capped exponential backoff."""
    if not batch:
        return []
    last = None
    for attempt in range(policy.max_retries + 1):
        try:
            result = lookup(batch)
        except RetryableError as exc:
            result, last = None, exc
        if result is not None and result != "None":
            return fitting(result, batch, policy)
        if attempt < policy.max_retries:
            sleep(min(policy.backoff_cap, policy.backoff_base * (2 ** attempt)))
    raise LookupFailed(
        f"lookup gave no answer after {policy.max_retries} retries ({len(batch)} values): {last!r}"
    )


def isolated_answers(values: Iterable[str], lookup: Lookup, policy: LookupPolicy,
                     sleep: Callable[[float], None] = time.sleep) -> Iterator[tuple[list[str], list, list]]:
    """Answers in order of completion: ``(values, answers, reasons)``, a reason for each value set aside.

    A failed call is searched for one bad value by halving: if the first half
    passes, the bad value is in the second, which needs no call of its own; else
    the second half goes back to the values not yet tried and fills up the next
    call. A value is set aside only after a call with it alone. So ``bad`` values
    among ``n`` cost at most ``ceil(n / batch) + bad * (ceil(log2(batch)) + 2)``
    calls. A call over the service's size limit is halved too, and the size that
    failed bounds later calls. Throttling is retried as ever; a lookup that gives
    no answer at all fails the job.
    """
    source = iter(values)
    waiting: deque[str] = deque()
    limit = policy.max_bytes
    rejects = 0

    def fill() -> list[str]:
        batch, size = [], 0
        while len(batch) < policy.batch_size:
            if not waiting:
                v = next(source, None)
                if v is None:
                    break
                waiting.append(v)
            cost = value_cost(waiting[0])
            if batch and size + cost > limit:
                break
            batch.append(waiting.popleft())
            size += cost
        return batch

    def attempt(batch: list[str]) -> tuple[list | None, str, bool]:
        """The answers, or why there are none, and whether for their size."""
        if len(batch) == 1 and value_cost(batch[0]) > policy.max_bytes:
            return None, "too large", True
        try:
            return call_with_retry(lookup, batch, policy, sleep), "", False
        except TooLargeError as exc:
            return None, f"too large: {exc}", True
        except (RefusedError, WrongAnswer) as exc:
            return None, str(exc), False

    def done(batch: list[str], answers: list):
        nonlocal rejects
        reasons = [None] * len(batch)
        if policy.null_answers == "fail":
            reasons = ["null answer" if a is None else None for a in answers]
            rejects += sum(r is not None for r in reasons)
        return batch, answers, reasons

    while batch := fill():
        answers, why, large = attempt(batch)
        if answers is not None:
            yield done(batch, answers)
            continue
        tried = len(batch) == 1  # whether what is left has failed by itself
        while len(batch) > 1:
            if large:
                limit = min(limit, max(1, sum(map(value_cost, batch)) - 1))
            half = len(batch) // 2
            answers, reason, big = attempt(batch[:half])
            if answers is None:
                waiting.extendleft(reversed(batch[half:]))
                batch, why, large, tried = batch[:half], reason, big, half == 1
                continue
            yield done(batch[:half], answers)
            if large:  # the second half may be small enough
                waiting.extendleft(reversed(batch[half:]))
                batch = []
                break
            batch, tried = batch[half:], False
        if not batch:
            continue
        if not tried:
            answers, why, _ = attempt(batch)
            if answers is not None:
                yield done(batch, answers)
                continue
        rejects += 1
        yield batch, [None], [why]
        if policy.max_rejects is not None and rejects > policy.max_rejects:
            raise LookupFailed(f"more than {policy.max_rejects} values set aside, the last one: {why}")


def is_blank(value: str) -> bool:
    """The reference's blank rule (``str.strip``); ``has_text`` is its column form."""
    return value.strip() == ""


def _mapper(lookup: Lookup, policy: LookupPolicy, with_mask: bool = False):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        masks: dict[str, int] = {}

        def values() -> Iterator[str]:
            # Blank values are never sent (and get no mapping row).
            for pdf in frames:
                pdf = pdf[~pdf["value"].map(is_blank)]
                if with_mask:
                    masks.update(zip(pdf["value"], pdf["mask"]))
                yield from pdf["value"].tolist()

        if policy.bad_values == "reject":
            answered = isolated_answers(values(), lookup, policy)
        else:
            answered = ((b, call_with_retry(lookup, b, policy), None) for b in batches(values(), policy))
        for batch, mapped, reasons in answered:
            out = {"value": batch, "mapped": mapped}
            if with_mask:
                out["mask"] = [masks.pop(v) for v in batch]
            if reasons is not None:
                out["reason"] = reasons
            yield pd.DataFrame(out)

    return run


def key_expr(column: str, null_as_text: bool = False, dtype=None):
    s = text_of(F.col(quote(column)), dtype)
    return F.coalesce(s, F.lit(NULL_TEXT)) if null_as_text else s


def column_bit(i: int) -> int:
    """Mask bit of the ``i``-th column (columns past ``MASK_BITS`` share all bits)."""
    return 1 << i if i < MASK_BITS else -1


def distinct_values(df: DataFrame, columns: Iterable[str], *, null_as_text: bool = False,
                    with_mask: bool = False, drop_blank: bool = True) -> DataFrame:
    """Distinct non-null string values over all ``columns`` (column ``value``).

    One scan: the columns of a row become rows (``inline``) in front of one
    partial + final aggregate. With ``with_mask`` a bigint ``mask`` tells in
    which columns the value occurs (bit ``i`` for column ``i``), so each
    column's join side holds only its own values. ``drop_blank`` removes blank
    values with a per-row whitespace rule (text columns only; a cast number,
    date or boolean is never blank); the mapping builders pass ``False`` and
    handle the few blank *distinct* values themselves, which keeps the regex
    off the per-row path.
    """
    cols = as_list(columns)
    types = column_types(df, cols)

    def entry(i: int, c: str) -> Column:
        v = key_expr(c, null_as_text, types[c])
        if drop_blank and may_be_blank(types[c]):
            v = F.when(has_text(v), v)
        return F.struct(v.alias("value"), F.lit(column_bit(i)).cast("long").alias("mask"))

    if len(cols) == 1:
        rows = df.select(entry(0, cols[0]).alias("e")).select("e.*")
    else:
        rows = df.select(F.inline(F.array(*[entry(i, c) for i, c in enumerate(cols)])))
    rows = rows.where(F.col("value").isNotNull())
    if with_mask:
        return rows.groupBy("value").agg(F.bit_or("mask").alias("mask"))
    return rows.select("value").distinct()


def lookup_mapping(
    df: DataFrame,
    columns: str | Iterable[str],
    lookup: Lookup,
    *,
    policy: LookupPolicy = LookupPolicy(),
    partitions: int | None = None,
    null_as_text: bool = False,
    with_mask: bool = False,
    full_calls: bool = False,
) -> DataFrame:
    """``(value, mapped)`` for every distinct value; each value is sent once.

    ``partitions`` caps the number of concurrent callers (the reference's
    ``repartition_no``); by default the distinct's shuffle partitions are used.
    With ``full_calls`` these callers get the values in lots of ``batch_size``:
    only one call in all is smaller, unless ``max_bytes`` cuts more.
    ``with_mask`` adds the column mask of ``distinct_values``, a policy that
    sets values aside a column ``reason``, null for the answered ones.
    """
    ship_package(df.sparkSession)
    values = distinct_values(df, as_list(columns), null_as_text=null_as_text, with_mask=with_mask,
                             drop_blank=False)
    if full_calls:
        if not partitions:
            raise ValueError("full_calls deals values to a number of partitions")
        values = in_lots(values, policy.batch_size, int(partitions))
    elif partitions:
        values = values.repartition(int(partitions), "value")
    return ask(values, lookup, policy)


def in_lots(values: DataFrame, size: int, partitions: int) -> DataFrame:
    """Distinct values numbered and dealt to the partitions in lots of ``size``.

    A value's number is its place in its hash bucket after all values of the
    buckets before; the buckets' counts are a table of ``LOT_BUCKETS`` rows.
    """
    b, lot = "__cl_bucket", "__cl_lot"
    dealt = values.withColumn(b, F.pmod(F.xxhash64("value"), F.lit(LOT_BUCKETS)))
    before = dealt.groupBy(b).agg(F.count(F.lit(1)).alias("n")).select(
        b, (F.sum("n").over(Window.orderBy(b)) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy(b).orderBy("value")) - 1
    return dealt.withColumn(lot, place).join(F.broadcast(before), b).withColumn(
        lot, F.floor((F.col("before") + F.col(lot)) / size)).repartition(partitions, lot).select(*values.columns)


def ask(values: DataFrame, lookup: Lookup, policy: LookupPolicy) -> DataFrame:
    """Send the distinct values of ``values`` (``value``, perhaps ``mask``) to the lookup."""
    with_mask = "mask" in values.columns
    schema = MAPPING_SCHEMA + (", mask long" if with_mask else "") + (
        ", reason string" if policy.bad_values == "reject" else "")
    return values.mapInPandas(_mapper(lookup, policy, with_mask), schema)


def _payload() -> Column:
    return F.octet_length("value") + F.coalesce(F.octet_length("mapped"), F.lit(0))


def mapping_size(mapping: DataFrame) -> tuple[int, int]:
    row = mapping.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(_payload()), F.lit(0)).alias("bytes"),
    ).first()
    return int(row["n"]), int(row["bytes"])


def column_sizes(mapping: DataFrame, n_columns: int) -> list[int]:
    """Payload bytes of each column's join side, in one aggregate."""
    if "mask" not in mapping.columns:
        return [mapping_size(mapping)[1]] * n_columns
    in_col = lambda i: F.col("mask").bitwiseAND(F.lit(column_bit(i))) != 0
    row = mapping.agg(
        *[F.coalesce(F.sum(F.when(in_col(i), _payload())), F.lit(0)).alias(f"b{i}")
          for i in range(n_columns)]
    ).first()
    return [int(row[f"b{i}"]) for i in range(n_columns)]


def read_once(df: DataFrame) -> DataFrame:
    """``df`` for two reads: written to the shared folder if it may differ or is costly to repeat."""
    from cloakline.plans.inspect import has_exchange, is_deterministic

    return write_scratch(df, "input") if not is_deterministic(df) or has_exchange(df) else df


def materialize_mapping(mapping: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """The mapping in the shared folder (deleted by a ``scratch_scope``), its values replaced by digests.

    Values set aside stay readable, in a column of their own: ``rejected``.
    """
    if "reason" in mapping.columns:
        mapping = mapping.withColumn("rejected", F.when(F.col("reason").isNotNull(), F.col("value")))
    return write_scratch(mapping.withColumn("value", digest(F.col("value"))), "mapping")


def write_rejects(mapping: DataFrame, path: str) -> None:
    """Append the values set aside to the reject table: ``value``, ``reason``. It holds plain values."""
    mapping.where("reason IS NOT NULL").select(F.col("rejected").alias("value"), "reason").write.mode(
        "append").parquet(path)


def salted_digest(salt: bytes) -> Callable[[Column], Column]:
    return lambda value: F.unhex(F.sha2(F.concat(F.lit(salt), utf8(value)), 256))


def _check_skew_handling(spark) -> None:
    """The shuffle join relies on AQE to split a hot value's partition.

    A value (or the null/blank rows) may hold a large share of the table; AQE's
    skew join splits that left-side partition by map blocks, which also
    spreads exact-copy rows, and needs no extra pass. Warn when it is off.
    """
    import warnings

    on = lambda k: spark.conf.get(k, "true").lower() == "true"
    if not (on("spark.sql.adaptive.enabled") and on("spark.sql.adaptive.skewJoin.enabled")):
        warnings.warn(
            "mapping is joined by a shuffle but AQE skew join is disabled: a hot value "
            "would land in one task", RuntimeWarning, stacklevel=3,
        )


def join_mapping(
    df: DataFrame,
    columns: Iterable[str],
    mapping: DataFrame,
    *,
    null_as_text: bool = False,
    digest: Callable[[Column], Column] | None = None,
    broadcast_max_bytes: int | None = None,
    missing: str = "fail",
) -> DataFrame:
    """Replace each column's values by ``mapping.mapped`` (left join, order kept).

    Null stays null, blank becomes ''. Any other value without an answer fails
    the job (``missing='fail'``) or becomes null (``'null'``); a column whose
    rows are filtered out afterwards fails nothing. If the mapping has a
    ``mask`` column (see ``distinct_values``), each column joins only the
    values that occur in it. ``digest``: how ``mapping.value`` was made from
    the values, if it was.

    With ``broadcast_max_bytes`` the mapping must be a stored table: sides are
    measured, and broadcast from the smallest on while their sum stays within
    the bound. Without it Spark picks the joins.
    """
    cols = as_list(columns)
    types = column_types(df, cols)
    small = [False] * len(cols)
    if broadcast_max_bytes is not None:
        sizes = column_sizes(mapping, len(cols))
        room = broadcast_max_bytes
        for i in sorted(range(len(cols)), key=sizes.__getitem__):
            room -= sizes[i]
            small[i] = room >= 0
        if not all(small):
            _check_skew_handling(df.sparkSession)

    def key_of(c: str, spread: bool = True) -> Column:
        """The join key: the value or its digest; a blank value has none.

        Rows without a value are the left side's hot key. Against a stored
        mapping they get one of many keys that match nothing; in the lazy plan,
        which stays deterministic, they are null and AQE splits them.
        """
        s = key_expr(c, null_as_text, types[c])
        has = s.isNotNull() & (s != "") if may_be_blank(types[c]) else s.isNotNull()
        if digest is None:
            return F.when(has, s)
        lone = F.concat(F.lit("\0"), F.spark_partition_id().cast("string")) if spread else F.lit("\0")
        return F.when(has, digest(s)).otherwise(lone.cast("binary"))

    def side_of(i: int, key: str, val: str) -> DataFrame:
        side = mapping
        if "mask" in mapping.columns:
            side = side.where(F.col("mask").bitwiseAND(F.lit(column_bit(i))) != 0)
        return side.select(F.col("value").alias(key), F.col("mapped").alias(val))

    out = df
    big = [i for i in range(len(cols)) if not small[i]] if broadcast_max_bytes is not None else []
    if len(big) >= 2:
        out = _join_tuples(df, cols, big, side_of, key_of)
    replaced = {}
    for i, c in enumerate(cols):
        key, val = f"__cl_key{i}", f"__cl_val{i}"
        s = key_expr(c, null_as_text, types[c])
        if len(big) < 2 or i not in big:  # else ``val`` came with the tuple join
            side = side_of(i, key, val)
            out = out.withColumn(key, key_of(c)).join(F.broadcast(side) if small[i] else side, on=key, how="left")
        found = F.col(val)
        if missing == "fail":
            found = F.coalesce(found, F.raise_error(F.lit(f"column {c}: a value has no answer")).cast("string"))
        rule = F.when(s.isNull(), F.lit(None).cast("string"))
        if may_be_blank(types[c]):
            # No blank value has an answer; the whitespace regex runs only for rows without one.
            rule = rule.when(F.col(val).isNull() & ~has_text(s), F.lit(""))
        replaced[c] = rule.otherwise(found)
    return out.select(*[replaced[c].alias(c) if c in replaced else F.col(quote(c)) for c in df.columns])


def _join_tuples(df: DataFrame, cols: list[str], big: list[int], side_of, key_of) -> DataFrame:
    """Columns ``big`` (sides too large to broadcast) through one shuffle of ``df``.

    Joining each such column on its own would shuffle the whole table once
    per column. The result depends only on the tuple of those values, so the
    distinct tuples (narrow, one partial + final aggregate) are joined with
    each column's side, and the table joins that once on the tuple: one
    shuffle of the table however many columns. Exact-copy tuples collapse in
    the distinct; a hot tuple's partition is split by AQE. Adds
    ``__cl_val<i>`` for each ``i`` in ``big``.
    """
    tk = {i: f"__cl_tk{i}" for i in big}
    keyed = df.withColumns({tk[i]: key_of(cols[i], spread=False) for i in big})
    tuples = keyed.select(*tk.values()).distinct()
    for i in big:
        side = side_of(i, f"__cl_sk{i}", f"__cl_val{i}")
        tuples = tuples.join(side, F.col(tk[i]) == F.col(f"__cl_sk{i}"), "left").drop(f"__cl_sk{i}")
    return keyed.join(tuples, list(tk.values()), "left")


def apply_lookup(
    df: DataFrame,
    columns: str | Iterable[str],
    lookup: Lookup,
    *,
    policy: LookupPolicy = LookupPolicy(),
    partitions: int | None = None,
    null_as_text: bool = False,
    broadcast_max_bytes: int = 64 << 20,
    reject_path: str | None = None,
) -> DataFrame:
    """Service-mode pseudonymize or re-identify (the lookup decides which).

    The input is read twice (distinct values, then the join), so an input that
    shuffles or may differ between reads is written to the shared folder first.
    With a policy that sets bad values aside, those are null in the result and
    appended, with the reason, to the Parquet table at ``reject_path``.
    """
    cols = as_list(columns)
    if (policy.bad_values == "reject") != (reject_path is not None):
        raise ValueError("bad_values='reject' and reject_path go together")
    if df.isStreaming:
        raise ValueError(
            "service mode needs a distinct + join per micro-batch: use "
            "streaming.stream.start_lookup_stream (foreachBatch) for a stream"
        )
    df = read_once(df)
    mapping = lookup_mapping(
        df, cols, lookup, policy=policy, partitions=partitions, null_as_text=null_as_text,
        with_mask=True,
    )
    digest = salted_digest(secrets.token_bytes(32))
    mapping = materialize_mapping(mapping, digest)
    if reject_path is not None:
        write_rejects(mapping, reject_path)
    return join_mapping(
        df, cols, mapping, null_as_text=null_as_text, digest=digest, broadcast_max_bytes=broadcast_max_bytes,
        missing="null" if reject_path is not None else policy.null_answers,
    )


# ---------------------------------------------------------------- JSON / HTTP


@dataclass(frozen=True)
class JsonCodec:
    """Request ``{request_field: [...]}``, response ``{response_field: [...]}``."""

    request_field: str
    response_field: str

    def encode(self, values: list[str]) -> bytes:
        return json.dumps({self.request_field: values}, ensure_ascii=False).encode("utf-8")

    def decode(self, body: bytes | str) -> list[str] | None:
        try:
            obj = json.loads(body)
        except ValueError:
            return None
        result = obj.get(self.response_field) if isinstance(obj, dict) else None
        if result is None or result == "None":
            return None
        return result


# The service contract's field names.
PSEUDONYMIZE_CODEC = JsonCodec("identifiers", "pseudonyms")
REIDENTIFY_CODEC = JsonCodec("reidentifications", "identifiers")
REIDENTIFY_CODEC_SQL = JsonCodec("pseudonyms", "identifiers")

RETRY_STATUS = (429, 500, 502, 503, 504)
REFUSED_STATUS = (400, 422)
TOO_LARGE_STATUS = 413


class HttpJsonLookup:
    """POSTs one JSON request per batch; picklable, for a remote service.

    ``deterministic`` adds ``?deterministic=true|false`` as the reference did.
    The API key is passed in (resolved once on the driver), never fetched per
    call.
    """

    def __init__(self, url: str, codec: JsonCodec, *, api_key: str | None = None,
                 deterministic: bool | None = None, timeout: float = 30.0,
                 header: str = "x-api-key"):
        if deterministic is not None:
            sep = "&" if "?" in url else "?"
            url = f"{url}{sep}{urllib.parse.urlencode({'deterministic': str(deterministic).lower()})}"
        self.url = url
        self.codec = codec
        self.timeout = timeout
        self._headers = {"Content-Type": "application/json"}
        if api_key:
            self._headers[header] = api_key

    def __repr__(self) -> str:
        return f"HttpJsonLookup({self.url!r})"

    def __call__(self, values: list[str]) -> list[str] | None:
        request = urllib.request.Request(
            self.url, data=self.codec.encode(values), headers=self._headers, method="POST"
        )
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as response:
                body = response.read()
        except urllib.error.HTTPError as exc:
            if exc.code in RETRY_STATUS:
                raise RetryableError(f"HTTP {exc.code}") from exc
            if exc.code == TOO_LARGE_STATUS:
                raise TooLargeError(f"HTTP {exc.code}") from exc
            if exc.code in REFUSED_STATUS:
                raise RefusedError(f"HTTP {exc.code}") from exc
            raise
        except (urllib.error.URLError, TimeoutError) as exc:
            raise RetryableError(str(exc)) from exc
        return self.codec.decode(body)
