"""Sources, sinks and catalog DDL of the pseudonymization jobs.

Readers are plain ``spark.read`` calls (pushdown and pruning stay with
Catalyst); CSV is read without inference, every column a string. Appends to a
catalog table resolve columns *by name* (``saveAsTable`` on the built-in
catalog, ``writeTo().append()`` on a v2 catalog), never by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, *, sep: str = ",", header: bool = True) -> DataFrame:
    """Headered CSV, all columns strings (no schema inference pass)."""
    return spark.read.options(header=header, sep=sep, inferSchema=False).csv(path)


def with_corrupt_column(schema: T.StructType, corrupt: str = CORRUPT_COLUMN) -> T.StructType:
    if corrupt in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField(corrupt, T.StringType(), True)])


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType | str, *, corrupt: str = CORRUPT_COLUMN
) -> DataFrame:
    """One JSON object per line with an explicit schema; bad lines keep their text in ``corrupt``."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    return (
        spark.read.schema(with_corrupt_column(schema, corrupt))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt)
        .json(path)
    )


def quote(identifier: str) -> str:
    return "`" + identifier.replace("`", "``") + "`"


def literal(text: str) -> str:
    """``text`` as an SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def qualified(db: str, table: str, catalog: str | None = None) -> str:
    parts = ([catalog] if catalog else []) + [db, table]
    return ".".join(quote(p) for p in parts)


def table_location(root: str, mode: str, db: str, table: str) -> str:
    """``<root>/{batch|realtime}/warehouse/<db>/<table>`` as the reference laid out tables."""
    if mode not in ("batch", "realtime"):
        raise ValueError("mode must be 'batch' or 'realtime'")
    return f"{root.rstrip('/')}/{mode}/warehouse/{db}/{table}"


def ensure_database(spark: SparkSession, db: str, *, location: str | None = None,
                    catalog: str | None = None) -> None:
    name = ".".join(quote(p) for p in ([catalog] if catalog else []) + [db])
    loc = f" LOCATION {literal(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def ensure_table(
    spark: SparkSession,
    db: str,
    table: str,
    schema: T.StructType,
    *,
    fmt: str = "parquet",
    location: str | None = None,
    catalog: str | None = None,
    properties: dict[str, str] | None = None,
    partitioned_by: tuple[str, ...] = (),
) -> str:
    """``CREATE TABLE IF NOT EXISTS`` with the schema of the DataFrame to append."""
    cols = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    name = qualified(db, table, catalog)
    loc = f" LOCATION {literal(location)}" if location else ""
    parts = f" PARTITIONED BY ({', '.join(map(quote, partitioned_by))})" if partitioned_by else ""
    props = ""
    if properties:
        props = " TBLPROPERTIES (" + ", ".join(f"{literal(k)} = {literal(v)}" for k, v in properties.items()) + ")"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {fmt}{parts}{loc}{props}")
    return name


def append_to_table(df: DataFrame, db: str, table: str, *, catalog: str | None = None,
                    v2: bool = False) -> None:
    """Append by column name to an existing table."""
    name = qualified(db, table, catalog)
    if v2:
        df.writeTo(name).append()
    else:
        df.write.mode("append").saveAsTable(name)


def append_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows (the ETL job's ``show(5)``); call after values are replaced."""
    return df.limit(n)
