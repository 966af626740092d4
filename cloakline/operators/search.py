"""Point lookups on pseudonyms: the constant is sealed, the column is not revealed.

Deterministic pseudonyms of equal values are equal, so ``reidentify(x) = 'v'`` is
``x = pseudonym('v')``. Sealing the constant once, before the query is planned,
leaves a plain comparison that reaches the Parquet scan: row groups are skipped
by their Bloom filters (``write_indexed``), and no row is deciphered.

``revealed(...)`` writes such conditions for DataFrames, ``sealed_sql`` binds
sealed parameters to SQL text. Random pseudonyms can't be found this way.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakline.functions.crypto import check_type, pseudonymize_value
from cloakline.keys import Keyring
from cloakline.operators.table import as_list, quote


def pseudonyms_of(spark: SparkSession, values: Iterable[Any], keyring: Keyring) -> list[str | None]:
    """Pseudonyms of a few constants of one type, in order, by the rules of the table form (null, blank)."""
    rows = [(i, v) for i, v in enumerate(values)]
    if all(v is None for _, v in rows):
        return [None] * len(rows)
    df = spark.createDataFrame(rows, ["i", "v"])
    dtype = df.schema["v"].dataType
    check_type("constant", dtype)
    sealed = df.select("i", pseudonymize_value(F.col("v"), keyring.columns(spark), dtype=dtype).alias("p"))
    found = {r["i"]: r["p"] for r in sealed.collect()}
    return [found[i] for i, _ in rows]


class Revealed:
    """A pseudonymized column, compared by its values: ``==``, ``!=``, ``isin``, ``is_null``."""

    __hash__ = None

    def __init__(self, spark: SparkSession, column: str, keyring: Keyring):
        self.spark, self.keyring, self.column = spark, keyring, F.col(quote(column))

    def _sealed(self, values: Iterable[Any]) -> list[str]:
        values = list(values)
        if any(v is None for v in values):
            raise ValueError("compare with null by is_null()")
        return pseudonyms_of(self.spark, values, self.keyring)

    def __eq__(self, value: Any) -> Column:  # type: ignore[override]
        return self.column == F.lit(self._sealed([value])[0])

    def __ne__(self, value: Any) -> Column:  # type: ignore[override]
        return self.column != F.lit(self._sealed([value])[0])

    def isin(self, *values: Any) -> Column:
        values = values[0] if len(values) == 1 and isinstance(values[0], (list, tuple, set)) else values
        return self.column.isin(self._sealed(values))

    def is_null(self) -> Column:
        return self.column.isNull()


def revealed(df: DataFrame, column: str, keyring: Keyring) -> Revealed:
    """``df.where(revealed(df, "s_vin", kr) == vin)``: rows whose pseudonym stands for ``vin``."""
    if column not in df.columns:
        raise ValueError(f"no column {column}")
    return Revealed(df.sparkSession, column, keyring)


def sealed_sql(spark: SparkSession, query: str, keyring: Keyring, sealed: dict[str, Any],
               args: dict[str, Any] | None = None) -> DataFrame:
    """``spark.sql`` with named parameters; those in ``sealed`` are bound as pseudonyms.

    ``sealed_sql(spark, "SELECT * FROM t WHERE s_vin = :vin", kr, {"vin": vin})``;
    a list becomes an array, for ``array_contains(:vins, s_vin)``.
    """
    bound: dict[str, Any] = dict(args or {})
    for name, value in sealed.items():
        if name in bound:
            raise ValueError(f"parameter {name} is given twice")
        many = isinstance(value, (list, tuple))
        found = pseudonyms_of(spark, value if many else [value], keyring)
        bound[name] = F.array(*map(F.lit, found)) if many else found[0]
    return spark.sql(query, args=bound)


def write_indexed(df: DataFrame, path: str, columns: str | Iterable[str], *, mode: str = "append",
                  distinct: int = 1_000_000) -> None:
    """Write Parquet with a Bloom filter on each pseudonym column, for about ``distinct`` values a row group."""
    writer = df.write.mode(mode)
    for c in as_list(columns):
        writer = (writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
                  .option(f"parquet.bloom.filter.expected.ndv#{c}", str(distinct))
                  # Pseudonyms hardly repeat within a row group; a dictionary would only be given up midway.
                  .option(f"parquet.enable.dictionary#{c}", "false"))
    writer.parquet(path)
