"""cloakline: reversible pseudonymization on Spark DataFrames, streams and SQL."""

from cloakline.keys import KeySource, Keyring
from cloakline.operators.grouping import group_arrays, group_reidentify, n_per_group
from cloakline.operators.lookup import (
    HttpJsonLookup,
    JsonCodec,
    LookupPolicy,
    RetryableError,
    apply_lookup,
    lookup_mapping,
)
from cloakline.operators.table import pseudonymize, reidentify
from cloakline.functions.sql import register_functions, register_lookup_function

__all__ = [
    "KeySource", "Keyring", "pseudonymize", "reidentify", "apply_lookup", "lookup_mapping",
    "LookupPolicy", "RetryableError", "JsonCodec", "HttpJsonLookup", "group_arrays",
    "group_reidentify", "n_per_group", "register_functions", "register_lookup_function",
]
