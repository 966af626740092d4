"""Records of unknown shape: JSON as VARIANT, identifiers replaced at paths, everything else kept.

A declared schema drops the fields it doesn't name. Here a record is parsed
whole; ``user.id`` and ``items[].sku`` name the identifiers, the objects around
them are rebuilt, and every other field, known or not, stays as it came.

A path that a record doesn't have changes nothing. A value of another shape than
the path expects (a string where an object should be) is sealed whole, so what
stands at a path never gets through in plain. Strings are sealed as the table
form seals them, so they link with plain columns; other values are sealed as
their JSON text and marked by ``~``, and come back as what they were. JSON null
stays null; numbers keep their value, not their spelling (2.50 is 2.5).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloakline.functions import crypto
from cloakline.keys import BOUND_KEY_COLUMNS, KeyColumns, Keyring, bind_keys
from cloakline.operators.nested import EACH, _tree
from cloakline.operators.table import as_list, quote

#: In front of a pseudonym of a value that is no string.
TYPED = "~"
RECORD, TEXT = "record", "_corrupt_record"
#: What JSON allows in front of a value.
JSON_SPACE = " \t\r\n"


def parse_records(df: DataFrame, value_col: str = "value", record: str = RECORD, corrupt: str = TEXT) -> DataFrame:
    """``df`` with ``value_col`` replaced by ``record`` (VARIANT) and ``corrupt``: the text of what is no JSON object.

    Spark's parser reads the first JSON value of a text and ignores what follows it.
    """
    text = F.col(quote(value_col)).cast("string")
    others = [F.col(quote(c)) for c in df.columns if c != value_col]
    # A text is parsed once: no filter on the record moves below explode.
    whole = df.select(*others, text.alias(corrupt), F.explode(F.array(F.try_parse_json(text))).alias(record))
    parsed, text = F.col(quote(record)), F.col(quote(corrupt))
    is_object = F.coalesce(parsed.isNotNull() & F.startswith(F.ltrim(text, F.lit(JSON_SPACE)), F.lit("{")), F.lit(False))
    return whole.select(*others, F.when(is_object, parsed).alias(record), F.when(~is_object, text).alias(corrupt))


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with ``value`` computed once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _is_null(v: Column) -> Column:
    return v.isNull() | F.is_variant_null(v)


def _rewrite(v: Column, tree: dict, leaf: Callable[[Column], Column]) -> Column:
    if not tree:
        return F.when(_is_null(v), v).otherwise(leaf(v))
    if set(tree) == {EACH}:
        inside = v.try_cast("array<variant>")

        def new(items: Column) -> Column:
            return F.transform(items, lambda x: _rewrite(x, tree[EACH], leaf))
    elif EACH in tree:
        raise ValueError("a path goes into elements and fields of one place")
    else:
        inside = v.try_cast("map<string,variant>")

        def field(k: Column, x: Column) -> Column:
            out = None
            for name, sub in tree.items():
                one = _rewrite(x, sub, leaf)
                out = F.when(k == name, one) if out is None else out.when(k == name, one)
            return out.otherwise(x)

        def new(fields: Column) -> Column:
            return F.transform_values(fields, field)

    rebuilt = _once(inside, lambda x: F.when(x.isNotNull(), F.to_variant_object(new(x))).otherwise(leaf(v)))
    return F.when(_is_null(v), v).otherwise(rebuilt)


def _apply(df: DataFrame, column: str, paths: str | Iterable[str], keyring: Keyring, leaf) -> DataFrame:
    if not isinstance(df.schema[column].dataType, T.VariantType):
        raise ValueError(f"column {column} is no VARIANT; parse it with parse_records")
    tree = _tree(as_list(paths))
    bound, keys = bind_keys(df, keyring)
    return bound.withColumn(column, _rewrite(F.col(quote(column)), tree, lambda v: leaf(v, keys))).drop(*BOUND_KEY_COLUMNS)


def pseudonymize_records(df: DataFrame, column: str, paths: str | Iterable[str], keyring: Keyring, *,
                         deterministic: bool = True) -> DataFrame:
    """Replace what stands at ``paths`` of the VARIANT ``column`` (batch or streaming)."""

    def leaf(v: Column, keys: KeyColumns) -> Column:
        def string(text: Column) -> Column:
            return F.when(crypto.has_text(text), crypto.seal(text, keys, deterministic)).otherwise(F.lit(""))

        sealed = F.when(F.schema_of_variant(v) == "STRING", _once(v.try_cast("string"), string)).otherwise(
            _once(F.to_json(v), lambda text: F.concat(F.lit(TYPED), crypto.seal(text, keys, deterministic))))
        return sealed.cast("variant")

    return _apply(df, column, paths, keyring, leaf)


def reidentify_records(df: DataFrame, column: str, paths: str | Iterable[str], keyring: Keyring, *,
                       on_error: str = "fail") -> DataFrame:
    """The inverse; a pseudonym that can't be revealed fails, or becomes JSON null (``on_error='null'``)."""

    def leaf(v: Column, keys: KeyColumns) -> Column:
        def value(text: Column) -> Column:
            json = F.parse_json(crypto.reveal(F.substring(text, 2, 2**31 - 1), keys, on_error))
            string = F.when(text == "", text).otherwise(crypto.reveal(text, keys, on_error))
            return F.when(F.startswith(text, F.lit(TYPED)), json).otherwise(string.cast("variant"))

        return F.coalesce(_once(v.try_cast("string"), value), F.parse_json(F.lit("null")))

    return _apply(df, column, paths, keyring, leaf)
