"""Pseudonymize / re-identify columns of a DataFrame (batch or streaming).

Crypto mode is a single projection: ``withColumns`` replaces the chosen
columns in place (names, order and the other columns untouched), so Catalyst
keeps predicate pushdown and column pruning across it and the plan is
``Scan -> Project`` with no shuffle and no Python worker. That is the plan at
every size; no job runs when it is built.

``strategy='distinct'`` (per call or per column) is the caller's choice for
identifier columns that repeat a lot: sealing costs ~20 us per value, so each
distinct value is sealed once and joined back, in the same lazy plan. Which
join that is, Spark decides from the measured size of the distinct side. Both
plans give the same output and fail on the same rows: a pseudonym that can't
be revealed is carried as null through the join, and only a row that reaches
the projection raises.

``linkage='run'`` with random pseudonyms needs one pseudonym per distinct
value and run: distinct values are sealed once, the mapping (keyed by an HMAC
of the value, never the value) is written to the shared folder, since a random
result must not change when recomputed, and joined back.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloakline.functions import crypto
from cloakline.keys import Keyring
from cloakline.plans.inspect import has_exchange, is_deterministic


def quote(name: str) -> str:
    """A column name for ``F.col``: dots and backticks are part of the name."""
    return "`" + name.replace("`", "``") + "`"


def as_list(columns: str | Iterable[str]) -> list[str]:
    cols = [columns] if isinstance(columns, str) else list(columns)
    if not cols:
        raise ValueError("no columns given")
    if len(set(cols)) != len(cols):
        raise ValueError(f"duplicate columns: {cols}")
    return cols


def column_types(df: DataFrame, cols: list[str]) -> dict[str, T.DataType]:
    """Types of the chosen columns (exact names); complex types are refused."""
    types = {f.name: f.dataType for f in df.schema.fields}
    missing = [c for c in cols if c not in types]
    if missing:
        raise ValueError(f"columns not in DataFrame: {missing}")
    for c in cols:
        crypto.check_type(c, types[c])
    return {c: types[c] for c in cols}


def spread(df: DataFrame, min_partitions: int | str | None = None) -> DataFrame:
    """Round-robin fan-out of a scan with fewer partitions than ``min_partitions``.

    Off unless asked for (a number, or "auto" for the session's cores): it
    shuffles whole rows. Worth it for a small table in one row group, whose
    values would all be sealed on one core.
    """
    if min_partitions is None or df.isStreaming or has_exchange(df):
        return df
    n = df.sparkSession.sparkContext.defaultParallelism if min_partitions == "auto" else int(min_partitions)
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


STRATEGIES = ("row", "distinct")
BROADCAST_MAX_BYTES = 64 << 20


def strategies(cols: list[str], strategy: str | Mapping[str, str], types: dict[str, T.DataType]) -> dict[str, str]:
    """Strategy of each column; binary columns are always handled by row."""
    chosen = {c: strategy if isinstance(strategy, str) else strategy.get(c, "row") for c in cols}
    if not set(chosen.values()) <= set(STRATEGIES):
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    return {c: "row" if isinstance(types[c], T.BinaryType) else x for c, x in chosen.items()}


def _by_distinct(df: DataFrame, cols: list[str], value_fn, *, null_as_text: bool, missing: str) -> DataFrame:
    """Each distinct value of ``cols`` through ``value_fn`` once, joined back; one lazy plan."""
    from cloakline.operators.lookup import distinct_values, join_mapping

    if df.isStreaming:
        raise ValueError("strategy='distinct' needs a batch DataFrame; a stream is a projection")
    if not is_deterministic(df):
        raise ValueError("strategy='distinct' reads its input twice, and this plan may differ between reads "
                         "(random values, a limit, ties): write it first, or use strategy='row'")
    v = F.col("value")
    mapping = distinct_values(df, cols, null_as_text=null_as_text, with_mask=True, drop_blank=False).select(
        "value", F.when(crypto.has_text(v), value_fn(v)).alias("mapped"), "mask")
    return join_mapping(df, cols, mapping, null_as_text=null_as_text, missing=missing)


def pseudonymize(
    df: DataFrame,
    columns: str | Iterable[str],
    keyring: Keyring,
    *,
    deterministic: bool = True,
    linkage: str = "row",
    null_as_text: bool = False,
    strategy: str | Mapping[str, str] = "row",
    broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
    min_partitions: int | str | None = None,
) -> DataFrame:
    """Replace values of ``columns`` by pseudonyms; output columns are strings.

    ``linkage`` only matters when ``deterministic=False``: ``'row'`` gives a
    fresh pseudonym per row, ``'run'`` one per distinct value in this call.
    ``strategy`` ('row' or 'distinct', for all columns or by column) picks the
    deterministic plan.
    """
    cols = as_list(columns)
    types = column_types(df, cols)
    chosen = strategies(cols, strategy, types)
    if linkage not in ("row", "run"):
        raise ValueError("linkage must be 'row' or 'run'")
    keys = keyring.columns(df.sparkSession)
    if not deterministic and linkage == "run":
        if df.isStreaming:
            raise ValueError("linkage='run' needs a distinct + join per batch; on a stream use "
                             "linkage='row' or a foreachBatch sink")
        if any(isinstance(t, T.BinaryType) for t in types.values()):
            raise ValueError("linkage='run' links text values; encode a binary column first")
        from cloakline.operators.lookup import distinct_values, join_mapping, materialize_mapping, read_once

        df = read_once(df)
        v = F.col("value")
        mapping = distinct_values(df, cols, null_as_text=null_as_text, with_mask=True, drop_blank=False).select(
            "value", F.when(crypto.has_text(v), crypto.seal(v, keys, deterministic=False)).alias("mapped"), "mask")

        def digest(value):
            return F.unhex(crypto.hmac_sha256_hex(crypto.utf8(value), keys))

        return join_mapping(df, cols, materialize_mapping(mapping, digest), null_as_text=null_as_text,
                            digest=digest, broadcast_max_bytes=broadcast_max_bytes)
    df = spread(df, min_partitions)
    once = [c for c in cols if deterministic and chosen[c] == "distinct"]
    if once:
        df = _by_distinct(df, once, lambda v: crypto.seal(v, keys, True), null_as_text=null_as_text, missing="fail")
    return df.withColumns({
        c: crypto.pseudonymize_value(F.col(quote(c)), keys, deterministic=deterministic,
                                     null_as_text=null_as_text, dtype=types[c])
        for c in cols if c not in once
    })


def reidentify(
    df: DataFrame,
    columns: str | Iterable[str],
    keyring: Keyring,
    *,
    on_error: str = "fail",
    binary: str | Iterable[str] = (),
    strategy: str | Mapping[str, str] = "row",
    min_partitions: int | str | None = None,
) -> DataFrame:
    """Turn pseudonyms in ``columns`` back into values (null/blank kept).

    Columns named in ``binary`` come back as the bytes that were sealed, the
    others as strings. ``strategy`` as in ``pseudonymize``.
    """
    cols = as_list(columns)
    types = column_types(df, cols)
    chosen = strategies(cols, strategy, types)
    if on_error not in ("fail", "null"):
        raise ValueError("on_error must be 'fail' or 'null'")
    raw = {binary} if isinstance(binary, str) else set(binary)
    keys = keyring.columns(df.sparkSession)
    df = spread(df, min_partitions)
    once = [c for c in cols if chosen[c] == "distinct" and c not in raw]
    if once:
        df = _by_distinct(df, once, lambda v: crypto.reveal(v, keys, "null"), null_as_text=False, missing=on_error)
    return df.withColumns({
        c: crypto.reidentify_value(F.col(quote(c)), keys, on_error=on_error, binary=c in raw)
        for c in cols if c not in once
    })


def rename_with_prefix(df: DataFrame, columns: Iterable[str], prefix: str = "s_") -> DataFrame:
    """``<col>`` -> ``s_<col>`` as the reference's jobs name their output."""
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in columns})


def strip_prefix(df: DataFrame, columns: Iterable[str], prefix: str = "s_") -> DataFrame:
    renames = {}
    for c in columns:
        if not c.startswith(prefix):
            raise ValueError(f"{c} does not start with {prefix}")
        renames[c] = c[len(prefix):]
    return df.withColumnsRenamed(renames)
