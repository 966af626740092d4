"""SQL functions: ``pseudonymize``, ``reidentify`` and their JSON-string forms.

Crypto form (``register_functions``): SQL functions over ``transform`` whose
keys come from the one-row keyring view as uncorrelated scalar subqueries;
Spark plans them as one projection, with no Python worker and no shuffle.

Service form (``register_lookup_function``): an Arrow-batched pandas UDF that
flattens the arrays of a batch into size-bounded lookup calls.

Element semantics follow the reference's SQL function: position-wise, no
distinct and no blank filter; a null element stays null.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloakline.functions.crypto import IV_HEX_CHARS, MODE, PADDING
from cloakline.operators.grouping import POS_BITS
from cloakline.keys import KEYRING_VIEW, Keyring
from cloakline.operators.lookup import Lookup, LookupFailed, LookupPolicy, call_with_retry, value_cost

_CRLF = "concat(char(13), char(10))"


def seal_sql(x: str, det: str) -> str:
    """SQL text of ``crypto.seal`` for element ``x``; keys are columns k, ip, op."""
    data = f"encode({x}, 'UTF-8')"
    iv = (
        f"unhex(substring(sha2(concat(op, unhex(sha2(concat(ip, {data}), 256))), 256), 1, {IV_HEX_CHARS}))"
    )
    det_ct = f"aes_encrypt({data}, k, '{MODE}', '{PADDING}', {iv})"
    # rand() guard: evaluate a random-IV pseudonym once (see crypto.seal).
    rnd_ct = f"aes_encrypt(CASE WHEN rand() * 2 >= 0 THEN {data} END, k, '{MODE}')"
    return f"replace(base64(CASE WHEN {det} THEN {det_ct} ELSE {rnd_ct} END), {_CRLF}, '')"


def reveal_sql(x: str, on_error: str = "fail") -> str:
    if on_error == "null":
        raw = f"try_aes_decrypt(try_to_binary({x}, 'base64'), k, '{MODE}')"
    else:
        raw = f"aes_decrypt(to_binary({x}, 'base64'), k, '{MODE}')"
    return f"CASE WHEN {x} = '' THEN '' ELSE CAST({raw} AS STRING) END"


def register_functions(spark: SparkSession, keyring: Keyring, *, view: str = KEYRING_VIEW) -> list[str]:
    """Register the crypto SQL functions for this session; returns their names.

    ``pseudonymize(array<string>, 'true'|'false') -> array<string>``
    ``reidentify(array<string>) -> array<string>`` (fails on a bad pseudonym)
    ``try_reidentify(array<string>)`` (null for a bad pseudonym)
    ``pseudonymize_json(string, string) -> string``, ``reidentify_json(string)``:
    the older form with a JSON array in a string.
    ``chunk_of(rid, n)``: the bounded-array chunk key for grouping in SQL, e.g.
    ``SELECT g, reidentify(array_agg(v)) FROM (SELECT g, v, monotonically_increasing_id() AS rid
    FROM (SELECT g, v FROM t SORT BY g, v)) GROUP BY g, chunk_of(rid, 900)``.

    The public functions pass the keys to inner functions as *uncorrelated*
    scalar subqueries: Spark runs them once per query and the plan stays a
    single projection. (A body like ``(SELECT transform(input, ...) FROM
    keyring)`` is correlated; Spark decorrelates it into a distinct of all
    inputs and a join back, a full shuffle.)
    """
    keyring.register_view(spark, view)
    keys = ", ".join(f"(SELECT {c} FROM {view})" for c in ("k", "ip", "op"))
    det = "lower(deterministic) = 'true'"
    statements = [
        "cloakline_seal_array(input ARRAY<STRING>, deterministic STRING, k BINARY, ip BINARY, op BINARY) "
        f"RETURNS ARRAY<STRING> RETURN transform(input, x -> {seal_sql('x', det)})",
        "cloakline_reveal_array(input ARRAY<STRING>, k BINARY) "
        f"RETURNS ARRAY<STRING> RETURN transform(input, x -> {reveal_sql('x')})",
        "cloakline_try_reveal_array(input ARRAY<STRING>, k BINARY) "
        f"RETURNS ARRAY<STRING> RETURN transform(input, x -> {reveal_sql('x', 'null')})",
        "pseudonymize(input ARRAY<STRING>, deterministic STRING) RETURNS ARRAY<STRING> "
        f"RETURN cloakline_seal_array(input, deterministic, {keys})",
        "reidentify(input ARRAY<STRING>) RETURNS ARRAY<STRING> "
        f"RETURN cloakline_reveal_array(input, (SELECT k FROM {view}))",
        "try_reidentify(input ARRAY<STRING>) RETURNS ARRAY<STRING> "
        f"RETURN cloakline_try_reveal_array(input, (SELECT k FROM {view}))",
        "pseudonymize_json(input STRING, deterministic STRING) RETURNS STRING "
        "RETURN to_json(pseudonymize(from_json(input, 'array<string>'), deterministic))",
        "reidentify_json(input STRING) RETURNS STRING "
        "RETURN to_json(reidentify(from_json(input, 'array<string>')))",
        # The chunk key of ``group_arrays`` for SQL: rows numbered by
        # monotonically_increasing_id() after a SORT BY (within partitions).
        "chunk_of(rid BIGINT, n INT) RETURNS BIGINT "
        f"RETURN shiftleft(shiftright(rid, {POS_BITS}), {POS_BITS}) + floor((rid & {(1 << POS_BITS) - 1}) / n)",
    ]
    for body in statements:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {body}")
    return ["pseudonymize", "reidentify", "try_reidentify", "pseudonymize_json", "reidentify_json", "chunk_of"]


def _answers(arrays: Iterator, lookup: Lookup, policy: LookupPolicy) -> Iterator[list | None]:
    """Each array with its elements answered, in order; calls span arrays.

    Held at once: the elements of one call and the arrays they belong to, so a
    batch of many arrays is never flattened as a whole.
    """
    waiting: list[tuple[list | None, list]] = []  # an array and its answers so far
    pending: list[tuple[list, int]] = []  # where the next answers go
    values: list[str] = []
    size = 0

    def send():
        for (to, at), x in zip(pending, call_with_retry(lookup, values, policy)):
            to[at] = x
        pending.clear()
        values.clear()

    for arr in arrays:
        out = None if arr is None else [None] * len(arr)
        waiting.append((arr, out))
        for at, v in enumerate(arr if arr is not None else ()):
            if v is None:
                continue
            cost = value_cost(v)
            if cost > policy.max_bytes:
                raise LookupFailed(f"one value of {cost} bytes exceeds max_bytes={policy.max_bytes}")
            if values and (len(values) >= policy.batch_size or size + cost > policy.max_bytes):
                send()
                size = 0
                yield from (o for _, o in waiting[:-1])
                del waiting[:-1]
            pending.append((out, at))
            values.append(v)
            size += cost
    send()
    yield from (o for _, o in waiting)


def lookup_array_udf(lookup: Lookup, policy: LookupPolicy = LookupPolicy()):
    """pandas UDF ``array<string> -> array<string>`` backed by a lookup.

    Nondeterministic, whatever the service does: a filter on its result must
    not make Spark call the service a second time.
    """

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def call(arrays: pd.Series) -> pd.Series:
        return pd.Series(list(_answers(iter(arrays), lookup, policy)), dtype=object)

    return call.asNondeterministic()


def register_lookup_function(spark: SparkSession, name: str, lookup: Lookup,
                             policy: LookupPolicy = LookupPolicy()) -> str:
    """Register a service-backed ``name(array<string>) -> array<string>``."""
    from cloakline.session import ship_package

    ship_package(spark)
    spark.udf.register(name, lookup_array_udf(lookup, policy))
    return name
