"""Grouped arrays with a payload guard, grouped re-identification, n per group.

The reference's SQL re-identifies ``ARRAY_AGG(s_vin) GROUP BY dept_id``: one
array per group, which failed once a group passed the request limit, and
which puts a whole group into one task. Here a group becomes *chunks* of at
most ``batch_size`` values:

1. rows are sorted by (group, value) *within* each partition (local,
   spillable sort, no shuffle), so a group's rows are contiguous inside a
   partition, and the order -- hence the numbering below -- depends only on
   the partition's rows: a task re-run after an executor loss assigns every
   row to the same chunk as the first attempt;
2. ``monotonically_increasing_id`` gives (partition, position); the chunk key
   is ``(partition, position div batch_size)``, so a chunk never holds more
   than ``batch_size`` rows, however large the group;
3. one aggregate on ``(group, chunk)`` builds the arrays; a hot group spreads
   over as many keys (and tasks) as it has chunks.

No window over a whole group and nothing collected on the driver.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cloakline.functions import crypto
from cloakline.keys import BOUND_KEY_COLUMNS, Keyring, bind_keys
from cloakline.operators.table import as_list, column_types, quote, reidentify

POS_BITS = 33  # monotonically_increasing_id: partition id << 33 | row position
POS_MASK = (1 << POS_BITS) - 1


def group_arrays(
    df: DataFrame,
    group_cols: str | Iterable[str],
    value_col: str,
    *,
    batch_size: int = 900,
    out_col: str | None = None,
    keep_nulls: bool = True,
) -> DataFrame:
    """``(group..., chunk, out_col array<string>)``, each array <= ``batch_size``.

    Like ``ARRAY_AGG``, nulls are kept when ``keep_nulls``; order inside an
    array is unspecified. ``chunk`` is an opaque bigint, unique per group.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    groups = as_list(group_cols)
    column_types(df, [value_col])
    out_col = out_col or value_col
    rid = F.col("__cl_rid")
    chunk = F.shiftleft(F.shiftright(rid, POS_BITS), POS_BITS) + F.floor(
        rid.bitwiseAND(F.lit(POS_MASK)) / F.lit(batch_size)
    ).cast("long")
    value = F.col(quote(value_col)).cast("string")
    groups = [quote(g) for g in groups]
    numbered = (
        df.select(*groups, value.alias("__cl_v"))
        .sortWithinPartitions(*groups, "__cl_v")
        .withColumn("__cl_rid", F.monotonically_increasing_id())
        .withColumn("chunk", chunk)
    )
    if keep_nulls:
        agg = F.transform(F.collect_list(F.struct(F.col("__cl_v").alias("v"))), lambda s: s["v"])
    else:
        agg = F.collect_list("__cl_v")
    return numbered.groupBy(*groups, "chunk").agg(agg.alias(out_col))


def reidentify_arrays(
    df: DataFrame, array_col: str, keyring: Keyring, *, on_error: str = "fail"
) -> DataFrame:
    bound, keys = bind_keys(df, keyring)
    return bound.withColumn(
        array_col, F.transform(F.col(array_col), lambda x: crypto.reveal_element(x, keys, on_error))
    ).drop(*BOUND_KEY_COLUMNS)


def pseudonymize_arrays(
    df: DataFrame, array_col: str, keyring: Keyring, *, deterministic: bool = True
) -> DataFrame:
    bound, keys = bind_keys(df, keyring)
    return bound.withColumn(
        array_col, F.transform(F.col(array_col), lambda x: crypto.seal_element(x, keys, deterministic))
    ).drop(*BOUND_KEY_COLUMNS)


def group_reidentify(
    df: DataFrame,
    group_cols: str | Iterable[str],
    pseudonym_col: str,
    keyring: Keyring,
    *,
    batch_size: int = 900,
    out_col: str | None = None,
    on_error: str = "fail",
    strategy: str = "row",
) -> DataFrame:
    """Re-identify a column grouped into bounded arrays (reference query, guarded).

    Values are revealed *before* grouping, through the table operator: with
    ``strategy='distinct'`` a column of repeating (deterministic) pseudonyms is
    decrypted once per distinct value and joined back, instead of once per
    array element. The element rule is kept: '' stays '', null stays null,
    and a whitespace-only pseudonym (which the table form would treat as a
    blank) fails, or is null with ``on_error='null'``.
    """
    if on_error not in ("fail", "null"):
        raise ValueError("on_error must be 'fail' or 'null'")
    groups = as_list(group_cols)
    column_types(df, [pseudonym_col])
    out_col = out_col or pseudonym_col
    # A copy of the pseudonym rides along to tell a whitespace-only pseudonym
    # (table form: '') from a real '' -- checked only where the result is ''.
    orig = "__cl_orig"
    pre = df.select(*map(quote, groups), F.col(quote(pseudonym_col)), F.col(quote(pseudonym_col)).alias(orig))
    revealed = reidentify(pre, pseudonym_col, keyring, on_error=on_error, strategy=strategy)
    o, r = F.col(orig).cast("string"), F.col(quote(pseudonym_col))
    bad = (r == F.lit("")) & (o != F.lit("")) & ~crypto.has_text(o)
    guard = (
        F.raise_error(F.lit("invalid pseudonym: whitespace only")) if on_error == "fail" else F.lit(None)
    ).cast("string")
    fixed = revealed.select(*map(quote, groups), F.when(bad, guard).otherwise(r).alias(pseudonym_col))
    return group_arrays(fixed, groups, pseudonym_col, batch_size=batch_size, out_col=out_col)


def n_per_group(
    df: DataFrame,
    group_cols: str | Iterable[str],
    order_cols: str | Iterable[str],
    n: int,
) -> DataFrame:
    """First ``n`` rows of each group by ``order_cols`` (deterministic if unique).

    ``row_number() <= n`` lets Catalyst add a partial ``WindowGroupLimit``
    before the shuffle, so each task sends at most ``n`` rows per group.
    """
    if n < 1:
        raise ValueError("n must be positive")
    w = Window.partitionBy(*as_list(group_cols)).orderBy(*as_list(order_cols))
    return df.withColumn("__cl_rn", F.row_number().over(w)).where(F.col("__cl_rn") <= n).drop("__cl_rn")
