"""Pseudonyms as Catalyst column expressions.

A pseudonym is ``base64(iv || AES-GCM(value) || tag)`` with a 12-byte IV:
the same layout as the reference service's output (12 + N + 16 bytes). In
deterministic mode the IV is the first 12 bytes of HMAC-SHA256(iv_key, value),
so equal values give equal pseudonyms (joinable) and different values give
different IVs. In random mode Spark draws a fresh IV per row.

Everything here is a built-in Spark function, evaluated inside whole-stage
codegen with no Python worker and no shuffle. Keys arrive as ``KeyColumns``
(scalar subqueries); see ``keys.py``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloakline.keys import KeyColumns

# Cipher mode, padding, IV length in hex characters, and the
# whitespace rule of the reference's blank filter (Python ``str.strip``:
# Unicode White_Space plus the separators U+001C..U+001F).
MODE = "GCM"
PADDING = "DEFAULT"
IV_HEX_CHARS = 24
TEXT_PATTERN = r"(?U)[^\s\x{1C}-\x{1F}]"
NULL_TEXT = "None"


def utf8(value: Column) -> Column:
    return F.encode(value.cast("string"), "UTF-8")


def check_type(name: str, dtype: T.DataType) -> None:
    """Arrays, maps, structs and variants have no stable text form and are refused."""
    if not isinstance(dtype, (T.AtomicType, T.NullType)) or isinstance(dtype, T.VariantType):
        raise ValueError(f"column {name}: {dtype.simpleString()} can't be pseudonymized, pick its fields")


def text_of(value: Column, dtype: T.DataType | None = None) -> Column:
    """The string form that is sealed; it does not depend on session settings.

    A timestamp with time zone is an instant: its text is UTC with a ``Z``,
    whatever ``spark.sql.session.timeZone`` says.
    """
    if isinstance(dtype, T.TimestampType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.concat(F.timestamp_add("MICROSECOND", F.unix_micros(value), epoch).cast("string"), F.lit("Z"))
    return value.cast("string")


def hmac_sha256_hex(data: Column, keys: KeyColumns) -> Column:
    """HMAC-SHA256 over binary ``data`` as a lowercase hex string."""
    inner = F.unhex(F.sha2(F.concat(keys.ip, data), 256))
    return F.sha2(F.concat(keys.op, inner), 256)


def deterministic_iv(data: Column, keys: KeyColumns) -> Column:
    return F.unhex(F.substring(hmac_sha256_hex(data, keys), 1, IV_HEX_CHARS))


def b64(data: Column) -> Column:
    # base64() wraps lines after 76 characters; pseudonyms are single tokens.
    return F.replace(F.base64(data), F.lit("\r\n"), F.lit(""))


def seal(value: Column, keys: KeyColumns, deterministic: bool | Column = True) -> Column:
    """Pseudonym of a value (any atomic type, compared as its string form).

    Null in, null out. ``deterministic`` may be a boolean Column (SQL form).
    """
    return seal_bytes(utf8(value), keys, deterministic)


def seal_bytes(data: Column, keys: KeyColumns, deterministic: bool | Column = True) -> Column:
    """``seal`` of bytes as they are."""
    det = F.aes_encrypt(data, keys.k, F.lit(MODE), F.lit(PADDING), deterministic_iv(data, keys))
    # A random IV makes the result differ on every evaluation, but Catalyst
    # treats aes_encrypt as deterministic: it may evaluate it twice (a filter
    # pushed through the projection, a plan read twice) or share one result
    # between two columns of equal values. The always-true rand() guard on its
    # input marks it nondeterministic: one evaluation for each column and row.
    # (The optimizer folds a bare ``rand() >= 0``, so the guard is a product.)
    rnd = F.aes_encrypt(F.when(F.rand() * 2 >= F.lit(0.0), data), keys.k, F.lit(MODE))
    if isinstance(deterministic, Column):
        return b64(F.when(deterministic, det).otherwise(rnd))
    return b64(det if deterministic else rnd)


def reveal(pseudonym: Column, keys: KeyColumns, on_error: str = "fail", binary: bool = False) -> Column:
    """Value of a pseudonym, as a string or as the bytes that were sealed.

    ``on_error='fail'`` raises on a tampered, truncated or foreign pseudonym;
    ``'null'`` yields null instead.
    """
    if on_error not in ("fail", "null"):
        raise ValueError("on_error must be 'fail' or 'null'")
    if on_error == "null":
        raw = F.try_aes_decrypt(F.try_to_binary(pseudonym, F.lit("base64")), keys.k, F.lit(MODE))
    else:
        raw = F.aes_decrypt(F.to_binary(pseudonym, F.lit("base64")), keys.k, F.lit(MODE))
    return raw if binary else raw.cast("string")


def has_text(value: Column) -> Column:
    """True when the value has a non-whitespace character (reference blank rule)."""
    return value.rlike(TEXT_PATTERN)


def may_be_blank(dtype: T.DataType) -> bool:
    """Only text can be empty or whitespace; a cast number, date or boolean can't."""
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))


def pseudonymize_value(
    value: Column,
    keys: KeyColumns,
    *,
    deterministic: bool = True,
    null_as_text: bool = False,
    dtype: T.DataType = T.StringType(),
) -> Column:
    """Table-form rule: null stays null, blank becomes '', the rest is sealed.

    ``null_as_text`` reproduces the reference, which sent ``str(None)``. Only
    text columns pay for the blank regex. Binary values are sealed as bytes;
    of those only the empty one is blank.
    """
    if isinstance(dtype, T.BinaryType):
        none = seal(F.lit(NULL_TEXT), keys, deterministic) if null_as_text else F.lit(None).cast("string")
        return (F.when(value.isNull(), none).when(F.octet_length(value) == 0, F.lit(""))
                .otherwise(seal_bytes(value, keys, deterministic)))
    s = text_of(value, dtype)
    if null_as_text:
        s = F.coalesce(s, F.lit(NULL_TEXT))
    rule = F.when(s.isNull(), F.lit(None).cast("string"))
    if may_be_blank(dtype):
        rule = rule.when(~has_text(s), F.lit(""))
    return rule.otherwise(seal(s, keys, deterministic))


def reidentify_value(value: Column, keys: KeyColumns, *, on_error: str = "fail", binary: bool = False) -> Column:
    """Table-form inverse: null stays null, blank stays ''."""
    s = value.cast("string")
    kind = "binary" if binary else "string"
    return (
        F.when(s.isNull(), F.lit(None).cast(kind))
        .when(~has_text(s), F.lit("").cast(kind))
        .otherwise(reveal(s, keys, on_error, binary))
    )


def seal_element(x: Column, keys: KeyColumns, deterministic: bool | Column = True) -> Column:
    """Array-form rule: every element is sealed, '' included; null stays null."""
    return seal(x, keys, deterministic)


def reveal_element(x: Column, keys: KeyColumns, on_error: str = "fail") -> Column:
    """Array-form inverse; '' (a blank placeholder of the table form) stays ''."""
    return F.when(x == "", F.lit("")).otherwise(reveal(x, keys, on_error))


def pseudonym_length(n_bytes: Column) -> Column:
    """Length law: base64 of 12 + n + 16 bytes."""
    return (F.ceil((n_bytes + 28) / 3) * 4).cast("long")
