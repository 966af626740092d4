"""Key versions: pseudonyms that name their key, and tables that change keys.

A versioned pseudonym is ``<key id>.<pseudonym>``. A ``KeyringSet`` holds the
keyrings by id and says which one seals; whatever the id of a pseudonym, it is
revealed in the same pass: the keys are one map, read once per query by a scalar
subquery, and each row takes its own. ``reseal`` moves pseudonyms to the current
key; it is a projection, so a stream can do it, or an update of one partition.

Under one key equal values have equal pseudonyms; across keys they don't, so
reseal before joining. Pseudonyms without an id (sealed before there were
versions) are the ``unversioned`` key's, if the set names one.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakline.functions import crypto
from cloakline.keys import KeyColumns, Keyring
from cloakline.operators.table import as_list, column_types, quote

_ID = re.compile(r"[A-Za-z0-9_-]{1,32}")


@dataclass(frozen=True)
class KeyringSet:
    keyrings: Mapping[str, Keyring]
    current: str
    unversioned: str | None = None

    def __post_init__(self):
        bad = [i for i in self.keyrings if not _ID.fullmatch(i)]
        if bad:
            raise ValueError(f"key ids are up to 32 letters, digits, - and _: {bad}")
        for i in (self.current, self.unversioned):
            if i is not None and i not in self.keyrings:
                raise ValueError(f"no keyring {i!r}")

    def cipher_keys(self, spark: SparkSession) -> Column:
        """A map of the cipher keys by id; '' is the unversioned one."""
        keys = {i: k.enc_key for i, k in self.keyrings.items()}
        if self.unversioned is not None:
            keys[""] = keys[self.unversioned]
        table = pa.table({"keys": pa.array([list(keys.items())], pa.map_(pa.string(), pa.binary()))})
        return spark.createDataFrame(table).scalar()


def key_id(pseudonym: Column) -> Column:
    """The id a pseudonym names, '' if none (base64 has no dot)."""
    return F.when(F.instr(pseudonym, ".") > 0, F.substring_index(pseudonym, ".", 1)).otherwise(F.lit(""))


def _seal(value: Column, ring: KeyringSet, keys: KeyColumns, **rule) -> Column:
    sealed = crypto.pseudonymize_value(value, keys, **rule)
    return F.when(sealed == "", sealed).otherwise(F.concat(F.lit(f"{ring.current}."), sealed))


def _reveal(pseudonym: Column, keys: Column, on_error: str) -> Column:
    s = pseudonym.cast("string")
    name = key_id(s)
    key = F.try_element_at(keys, name)
    body = F.substring_index(s, ".", -1)
    # The message names the key, not the pseudonym.
    known = key if on_error == "null" else F.coalesce(key, F.raise_error(F.concat(F.lit("unknown key id "), name)).cast("binary"))
    value = crypto.reveal(body, KeyColumns(known, None, None), on_error)
    return F.when(s.isNull(), F.lit(None).cast("string")).when(~crypto.has_text(s), F.lit("")).otherwise(value)


def pseudonymize_versioned(df: DataFrame, columns: str | Iterable[str], ring: KeyringSet, *,
                           deterministic: bool = True, null_as_text: bool = False) -> DataFrame:
    """Replace values by pseudonyms under the current key, its id in front."""
    cols = as_list(columns)
    types = column_types(df, cols)
    keys = ring.keyrings[ring.current].columns(df.sparkSession)
    return df.withColumns({c: _seal(F.col(quote(c)), ring, keys, deterministic=deterministic,
                                    null_as_text=null_as_text, dtype=types[c]) for c in cols})


def reidentify_versioned(df: DataFrame, columns: str | Iterable[str], ring: KeyringSet, *,
                         on_error: str = "fail") -> DataFrame:
    """The values, whichever key of the set they are sealed under.

    An unknown key id, like a damaged pseudonym, fails or (``on_error='null'``) gives null.
    """
    if on_error not in ("fail", "null"):
        raise ValueError("on_error must be 'fail' or 'null'")
    cols = as_list(columns)
    column_types(df, cols)
    keys = ring.cipher_keys(df.sparkSession)
    return df.withColumns({c: _reveal(F.col(quote(c)), keys, on_error) for c in cols})


def reseal(df: DataFrame, columns: str | Iterable[str], ring: KeyringSet, *, deterministic: bool = True) -> DataFrame:
    """Pseudonyms of other keys of the set, sealed anew under the current one; the current one's stay (batch or streaming)."""
    cols = as_list(columns)
    column_types(df, cols)
    keys = ring.cipher_keys(df.sparkSession)
    seal = ring.keyrings[ring.current].columns(df.sparkSession)
    new = {}
    for c in cols:
        s = F.col(quote(c)).cast("string")
        fresh = s.isNull() | (key_id(s) == ring.current) | ~crypto.has_text(s)
        moved = F.concat(F.lit(f"{ring.current}."), crypto.seal(_reveal(s, keys, "fail"), seal, deterministic))
        new[c] = F.when(fresh, s).otherwise(moved)
    return df.withColumns(new)
