"""Key material: where the secret comes from and how Spark sees it.

The secret is resolved once, on the driver (the reference fetched it per
call). Two keys are derived from it, one for AES-GCM and one for the HMAC
that yields deterministic IVs; using one key for both would tie the IV to
the cipher key.

Spark never sees the key as a literal: a literal is printed by ``explain()``
and written to event logs. The keyring is a one-row ``LocalRelation`` and each
key enters an expression as an uncorrelated scalar subquery, which Spark
evaluates once per query and shows only as ``scalar-subquery#N``. Its size is
fixed (one row, 160 bytes), whatever the data size.
"""

from __future__ import annotations

import hashlib
import hmac
import os
from collections.abc import Callable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession

# Derivation labels and HMAC pad bytes (RFC 2104).
_ENC_LABEL = b"cloakline/aes-gcm/v1"
_IV_LABEL = b"cloakline/hmac-iv/v1"
_BLOCK = 64
_IPAD = 0x36
_OPAD = 0x5C

KEYRING_VIEW = "__cloakline_keyring"


class KeySource:
    """Where the master secret comes from; resolved once on the driver."""

    def __init__(self, fetch: Callable[[], bytes], label: str):
        self._fetch = fetch
        self._label = label

    def __repr__(self) -> str:  # never the secret itself
        return f"KeySource({self._label})"

    def resolve(self) -> bytes:
        secret = self._fetch()
        if isinstance(secret, str):
            secret = secret.encode("utf-8")
        if not isinstance(secret, (bytes, bytearray)) or len(secret) < 16:
            raise ValueError("master secret must be at least 16 bytes")
        return bytes(secret)

    @classmethod
    def from_bytes(cls, secret: bytes) -> "KeySource":
        return cls(lambda: secret, "bytes")

    @classmethod
    def from_hex(cls, text: str) -> "KeySource":
        return cls(lambda: bytes.fromhex(text.strip()), "hex")

    @classmethod
    def from_env(cls, name: str) -> "KeySource":
        def fetch() -> bytes:
            value = os.environ.get(name)
            if value is None:
                raise KeyError(f"environment variable {name} is not set")
            return bytes.fromhex(value.strip())

        return cls(fetch, f"env:{name}")

    @classmethod
    def from_file(cls, path: str) -> "KeySource":
        def fetch() -> bytes:
            with open(path, "rb") as fh:
                raw = fh.read().strip()
            try:
                return bytes.fromhex(raw.decode("ascii"))
            except ValueError:
                return raw

        return cls(fetch, f"file:{path}")

    @classmethod
    def from_callable(cls, fn: Callable[[], bytes], label: str = "callable") -> "KeySource":
        """For secret managers: ``fn`` returns the secret bytes."""
        return cls(fn, label)


def _derive(master: bytes, label: bytes) -> bytes:
    return hmac.new(master, label, hashlib.sha256).digest()


@dataclass(frozen=True)
class Keyring:
    """Derived keys. ``repr`` hides them."""

    enc_key: bytes = field(repr=False)
    iv_key: bytes = field(repr=False)

    @classmethod
    def from_source(cls, source: KeySource) -> "Keyring":
        master = source.resolve()
        return cls(_derive(master, _ENC_LABEL), _derive(master, _IV_LABEL))

    @classmethod
    def from_secret(cls, secret: bytes) -> "Keyring":
        return cls.from_source(KeySource.from_bytes(secret))

    @property
    def ipad(self) -> bytes:
        block = self.iv_key.ljust(_BLOCK, b"\0")
        return bytes(b ^ _IPAD for b in block)

    @property
    def opad(self) -> bytes:
        block = self.iv_key.ljust(_BLOCK, b"\0")
        return bytes(b ^ _OPAD for b in block)

    def frame(self, spark: SparkSession) -> DataFrame:
        """One-row DataFrame ``(k, ip, op)``; a LocalRelation, no Python job."""
        table = pa.table(
            {
                "k": pa.array([self.enc_key], pa.binary()),
                "ip": pa.array([self.ipad], pa.binary()),
                "op": pa.array([self.opad], pa.binary()),
            }
        )
        return spark.createDataFrame(table)

    def columns(self, spark: SparkSession) -> "KeyColumns":
        return KeyColumns.of(self.frame(spark))

    def register_view(self, spark: SparkSession, name: str = KEYRING_VIEW) -> str:
        self.frame(spark).createOrReplaceTempView(name)
        return name


@dataclass(frozen=True)
class KeyColumns:
    """The three keys as scalar-subquery Columns over one keyring frame."""

    k: Column
    ip: Column
    op: Column

    @classmethod
    def of(cls, frame: DataFrame) -> "KeyColumns":
        return cls(
            frame.select("k").scalar(),
            frame.select("ip").scalar(),
            frame.select("op").scalar(),
        )


BOUND_KEY_COLUMNS = ("__cl_k", "__cl_ip", "__cl_op")


def bind_keys(df: DataFrame, keyring: "Keyring") -> tuple[DataFrame, KeyColumns]:
    """Keys as columns of ``df``, for use inside lambdas (``transform``).

    Spark rejects a subquery inside a higher-order function at analysis; a
    column holding the scalar subquery is accepted. Drop ``BOUND_KEY_COLUMNS``
    afterwards.
    """
    keys = keyring.columns(df.sparkSession)
    k, ip, op = BOUND_KEY_COLUMNS
    bound = df.withColumns({k: keys.k, ip: keys.ip, op: keys.op})
    from pyspark.sql import functions as F

    return bound, KeyColumns(F.col(k), F.col(ip), F.col(op))
