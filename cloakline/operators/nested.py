"""Identifiers inside structs, arrays and maps, replaced in place.

A path names them: ``customer.name``, ``lines[].supplier`` (in every element),
``tags{}`` (every value of a map), ``tags{key}`` (its keys), ``rows[].m{}.vin``.
The rewriter follows the paths through the schema and rebuilds the columns
around them: one projection of built-in expressions, no explode, no shuffle; the
other fields, their order and nulls at every level stay as they are.

Leaves follow the table form: null stays null, blank becomes '', other values are
sealed as their text, binary ones as their bytes; replaced leaves are strings.
Map keys are all sealed, blank ones too, so two keys never become one.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloakline.functions import crypto
from cloakline.keys import BOUND_KEY_COLUMNS, KeyColumns, Keyring, bind_keys
from cloakline.operators.table import as_list, quote

EACH, VALUES, KEYS = "[]", "{}", "{key}"
_STEP = re.compile(r"(\[\]|\{key\}|\{\})|(?:^|\.)(?:`((?:[^`]|``)+)`|([^.\[\]{}`]+))")

Leaf = Callable[[Column, T.DataType], Column]


def steps(path: str) -> list[str]:
    """``a.b[].c`` -> ``[a, b, [], c]``; names with dots or brackets go into backticks."""
    out, at = [], 0
    while at < len(path):
        m = _STEP.match(path, at)
        if not m:
            raise ValueError(f"path {path!r}: can't read {path[at:]!r}")
        out.append(m[1] or (m[2].replace("``", "`") if m[2] else m[3]))
        at = m.end()
    if not out or out[0] in (EACH, VALUES, KEYS):
        raise ValueError(f"path {path!r} starts with a column")
    return out


def _tree(paths: Iterable[str]) -> dict:
    """The paths as nested dicts; an empty dict is a leaf."""
    root: dict = {}
    for path in paths:
        node, parts = root, steps(path)
        for i, step in enumerate(parts):
            last = i == len(parts) - 1
            if step in node and (last or not node[step]):
                raise ValueError(f"path {path!r} meets another path")
            node = node.setdefault(step, {})
    return root


def _rewrite(value: Column, dtype: T.DataType, tree: dict, leaf: Leaf, key_leaf: Leaf, at: str) -> Column:
    if not tree:
        if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
            raise ValueError(f"{at} is a {dtype.simpleString()}: name a field in it")
        crypto.check_type(at, dtype)
        return leaf(value, dtype)
    go = lambda v, t, sub, name: _rewrite(v, t, sub, leaf, key_leaf, name)
    if isinstance(dtype, T.StructType):
        missing = set(tree) - set(dtype.fieldNames())
        if missing:
            raise ValueError(f"{at} has no field {sorted(missing)}")
        fields = [(go(value.getField(f.name), f.dataType, tree[f.name], f"{at}.{f.name}")
                   if f.name in tree else value.getField(f.name)).alias(f.name) for f in dtype.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType) and set(tree) == {EACH}:
        return F.transform(value, lambda x: go(x, dtype.elementType, tree[EACH], f"{at}[]"))
    if isinstance(dtype, T.MapType) and set(tree) <= {VALUES, KEYS}:
        if VALUES in tree:
            value = F.transform_values(value, lambda _, x: go(x, dtype.valueType, tree[VALUES], f"{at}{{}}"))
        if KEYS in tree:
            if tree[KEYS]:
                raise ValueError(f"{at}{{key}}: keys have no fields")
            crypto.check_type(at, dtype.keyType)
            value = F.transform_keys(value, lambda k, _: key_leaf(k, dtype.keyType))
        return value
    raise ValueError(f"{at} is a {dtype.simpleString()}, which has no {sorted(tree)}")


def _apply(df: DataFrame, paths: str | Iterable[str], keyring: Keyring, leaf, key_leaf) -> DataFrame:
    tree = _tree(as_list(paths))
    types = {f.name: f.dataType for f in df.schema.fields}
    missing = set(tree) - set(types)
    if missing:
        raise ValueError(f"columns not in DataFrame: {sorted(missing)}")
    bound, keys = bind_keys(df, keyring)
    new = {c: _rewrite(F.col(quote(c)), types[c], sub, lambda v, t: leaf(v, t, keys), lambda v, t: key_leaf(v, t, keys), c)
           for c, sub in tree.items()}
    return bound.withColumns(new).drop(*BOUND_KEY_COLUMNS)


def pseudonymize_nested(df: DataFrame, paths: str | Iterable[str], keyring: Keyring, *,
                        deterministic: bool = True, null_as_text: bool = False) -> DataFrame:
    """Replace the identifiers at ``paths`` by pseudonyms (batch or streaming)."""

    def leaf(v: Column, t: T.DataType, keys: KeyColumns) -> Column:
        return crypto.pseudonymize_value(v, keys, deterministic=deterministic, null_as_text=null_as_text, dtype=t)

    def key_leaf(v: Column, t: T.DataType, keys: KeyColumns) -> Column:
        data = v if isinstance(t, T.BinaryType) else crypto.utf8(crypto.text_of(v, t))
        return crypto.seal_bytes(data, keys, deterministic)

    return _apply(df, paths, keyring, leaf, key_leaf)


def reidentify_nested(df: DataFrame, paths: str | Iterable[str], keyring: Keyring, *, on_error: str = "fail") -> DataFrame:
    """The inverse: the values as strings. A key that can't be revealed always fails, as a map has no null key."""
    return _apply(
        df, paths, keyring, lambda v, t, keys: crypto.reidentify_value(v, keys, on_error=on_error),
        lambda v, t, keys: crypto.reveal(v, keys))
