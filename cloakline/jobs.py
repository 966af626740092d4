"""Job configurations and runners: batch table, CSV -> Parquet, stream.

Configs are frozen dataclasses built from a dict or YAML. The reference's
key names are accepted as they are, so an existing config file works: keys
that only name its infrastructure are ignored, any other unknown key is an
error. Blank values count as not given.

A secret is named by ``secret_name``: ``env:NAME``, ``file:/path`` and
``hex:...`` are read directly, any other name goes to the resolver given to
the runner. It is resolved once, on the driver; in crypto mode it is the key,
in service mode the API key.
"""

from __future__ import annotations

import dataclasses
import os
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cloakline.keys import KeySource, Keyring
from cloakline.operators.lookup import (
    PSEUDONYMIZE_CODEC,
    REIDENTIFY_CODEC,
    HttpJsonLookup,
    Lookup,
    LookupPolicy,
    apply_lookup,
)
from cloakline.operators.store import MappingStore, apply_stored_lookup
from cloakline.operators.table import pseudonymize, reidentify, rename_with_prefix, strip_prefix
from cloakline.session import scratch_scope
from cloakline.sources import io, records
from cloakline.streaming import stream

ACTIONS = ("pseudonymize", "reidentify")
MODES = ("crypto", "service")

# The reference's config key names, mapped to ours.
ALIASES = {
    "input_s3_path": "input_path",
    "input_loc": "input_path",
    "output_bucket_name": "output_root",
    "output_loc": "output_path",
    "input_column": "input_columns",
    "kinesis_stream_name": "stream_name",
    "kinesis_endpoint_url": "stream_endpoint_url",
    "kinesis_region": "stream_region",
}
# Keys of the reference's configs that name infrastructure only.
INFRASTRUCTURE = {"aws_region"}
#: What the reference's stream carries, for a config that gives no schema.
DEFAULT_STREAM_SCHEMA = "vin string, ts string"
Resolver = Callable[[str], "str | bytes"]


def key_source(spec: str, resolver: Resolver | None = None) -> KeySource:
    """``env:NAME``, ``file:/path`` or ``hex:...``; any other name is the resolver's."""
    kind, _, value = spec.partition(":")
    if kind == "env":
        return KeySource.from_env(value)
    if kind == "file":
        return KeySource.from_file(value)
    if kind == "hex":
        return KeySource.from_hex(value)
    if resolver is not None:
        secret = resolver(spec)
        return KeySource.from_callable(lambda: secret.encode() if isinstance(secret, str) else secret)
    raise ValueError(f"unknown key source {spec!r}; use env:, file: or hex:, or give a resolver")


def api_key_of(spec: str, resolver: Resolver | None = None) -> str:
    """The API key that ``secret_name`` names, as text."""
    kind, _, value = spec.partition(":")
    if kind == "env":
        return os.environ[value]
    if kind == "file":
        with open(value) as fh:
            return fh.read().strip()
    if resolver is None:
        raise ValueError(f"secret {spec!r} needs a resolver (or env:, file:)")
    secret = resolver(spec)
    return secret.decode() if isinstance(secret, bytes) else secret


def flag(name: str, value: Any) -> bool:
    """A boolean or its text; anything else is an error."""
    if isinstance(value, bool):
        return value
    text = str(value).strip().lower()
    if text not in ("true", "false"):
        raise ValueError(f"{name} must be true or false, not {value!r}")
    return text == "true"


def _normalize(data: dict[str, Any], fields: set[str]) -> dict[str, Any]:
    out: dict[str, Any] = {}
    unknown = []
    for k, v in data.items():
        name = ALIASES.get(k, k)
        if name in fields:
            if v is None or isinstance(v, str) and not v.strip():
                continue
            if k == "output_bucket_name" and ":" not in str(v) and not str(v).startswith((".", "/")):
                v = f"s3://{v}"  # a bare bucket name, as in the reference
            out[name] = v
        elif k not in INFRASTRUCTURE:
            unknown.append(k)
    if unknown:
        raise ValueError(f"unknown settings {sorted(unknown)}")
    if "input_columns" in out:
        cols = out["input_columns"]
        out["input_columns"] = (cols,) if isinstance(cols, str) else tuple(cols)
    if "determinism" in out:
        out["determinism"] = flag("determinism", out["determinism"])
    return out


class _Config:
    @classmethod
    def from_dict(cls, data: dict[str, Any], **overrides: Any):
        names = {f.name for f in dataclasses.fields(cls)}
        values = _normalize({**data, **overrides}, names)
        # The action is the endpoint's; one given beside it must agree.
        url = values.get("endpoint_url")
        if url:
            named = action_from_url(url, known_only=values.get("mode") == "service")
            if named and values.setdefault("action", named) != named:
                raise ValueError(f"action {values['action']!r} contradicts the endpoint {url!r}")
        missing = [
            f.name for f in dataclasses.fields(cls)
            if f.name not in values and f.default is dataclasses.MISSING
            and f.default_factory is dataclasses.MISSING
        ]
        if missing:
            raise ValueError(f"{cls.__name__}: missing required settings {missing}")
        return cls(**values)

    @classmethod
    def from_yaml(cls, text_or_path: str, **overrides: Any):
        """Config from YAML text or a file path (JSON text works without PyYAML)."""
        if "\n" not in text_or_path and not text_or_path.strip().startswith("{"):
            with open(text_or_path) as fh:
                text_or_path = fh.read()
        try:
            import yaml
        except ImportError:  # optional dependency: JSON is a subset of YAML
            import json

            try:
                return cls.from_dict(json.loads(text_or_path) or {}, **overrides)
            except ValueError as exc:
                raise ImportError("YAML configs need PyYAML; pass JSON or a dict instead") from exc
        return cls.from_dict(yaml.safe_load(text_or_path) or {}, **overrides)

    def _check(self) -> None:
        if getattr(self, "action", "pseudonymize") not in ACTIONS:
            raise ValueError(f"action must be one of {ACTIONS}")
        if getattr(self, "mode", "crypto") not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        if getattr(self, "mode", "crypto") == "service" and not getattr(self, "endpoint_url", None):
            raise ValueError("service mode needs endpoint_url")


@dataclass(frozen=True)
class BatchJob(_Config):
    """With ``commit_id`` the output is a record folder (``sources.records``) instead of a table: all of the
    run's rows appear at once, and running it again under that id adds nothing."""

    input_path: str
    input_columns: tuple[str, ...]
    db_name: str
    table_name: str
    output_root: str
    determinism: bool = True
    action: str = "pseudonymize"
    mode: str = "crypto"
    endpoint_url: str | None = None
    secret_name: str | None = None
    repartition_no: int | None = None
    table_format: str = "parquet"
    catalog: str | None = None
    prefix: str = "s_"
    properties: dict[str, str] = field(default_factory=dict)
    commit_id: str | None = None

    def __post_init__(self):
        self._check()


@dataclass(frozen=True)
class CsvJob(_Config):
    input_path: str
    output_path: str
    input_columns: tuple[str, ...]
    determinism: bool = True
    action: str = "pseudonymize"
    mode: str = "crypto"
    endpoint_url: str | None = None
    secret_name: str | None = None
    repartition_no: int | None = None
    sep: str = ","
    prefix: str = "s_"
    commit_id: str | None = None

    def __post_init__(self):
        self._check()


@dataclass(frozen=True)
class StreamJob(_Config):
    """``input_path`` for file sources; a managed stream is named by ``stream_name`` and read with
    ``source_format`` (its connector must be on the class path); ``records`` reads a record folder.
    ``starting_position`` is where a new query starts (earliest, latest, a commit's number, a time); a
    restarted one goes on where it was. Without ``checkpoint`` it lies beside the table."""

    input_columns: tuple[str, ...]
    output_root: str
    db_name: str
    table_name: str
    input_path: str | None = None
    schema: str = DEFAULT_STREAM_SCHEMA
    checkpoint: str | None = None
    stream_name: str | None = None
    stream_endpoint_url: str | None = None
    stream_region: str | None = None
    source_format: str = "text"
    source_options: dict[str, str] = field(default_factory=dict)
    starting_position: str | None = None
    determinism: bool = True
    action: str = "pseudonymize"
    mode: str = "crypto"
    endpoint_url: str | None = None
    secret_name: str | None = None
    trigger: str = stream.DEFAULT_TRIGGER
    reject_path: str | None = None
    repartition_no: int | None = None
    prefix: str = "s_"
    catalog: str | None = None

    def __post_init__(self):
        self._check()


# The last URL segment of the reference service's two endpoints.
URL_ACTIONS = {"pseudonymization": "pseudonymize", "reidentification": "reidentify"}


def action_from_url(url: str, known_only: bool = True) -> str | None:
    """Action named by the endpoint URL's last path segment; unknown names are rejected.

    (The reference took the segment as given and re-identified on anything
    that was not ``pseudonymization``.) With ``known_only=False`` an unknown
    name gives None: a config template holds a placeholder.
    """
    import urllib.parse

    segment = urllib.parse.urlparse(url).path.rstrip("/").rsplit("/", 1)[-1]
    if segment not in URL_ACTIONS:
        if not known_only:
            return None
        raise ValueError(f"endpoint {url!r} names no known action ({sorted(URL_ACTIONS)})")
    return URL_ACTIONS[segment]


def _service_lookup(job, api_key: str | None) -> Lookup:
    codec = PSEUDONYMIZE_CODEC if job.action == "pseudonymize" else REIDENTIFY_CODEC
    det = job.determinism if job.action == "pseudonymize" else None
    return HttpJsonLookup(job.endpoint_url, codec, api_key=api_key, deterministic=det)


def transform(df: DataFrame, job, *, keyring: Keyring | None = None, lookup: Lookup | None = None,
              api_key: str | None = None, resolver: Resolver | None = None,
              policy: LookupPolicy = LookupPolicy(), value_rejects: str | None = None,
              store: MappingStore | None = None, keep_original: bool = False) -> DataFrame:
    """Apply the job's action to its columns and name the output columns.

    ``store``: answers that service mode keeps between runs and micro-batches
    (one store for each action and kind of answer). ``value_rejects``: where service mode puts values that the lookup does not
    answer (with a policy that sets them aside).

    ``resolver(secret_name)`` gives the key (crypto mode) or the API key
    (service mode).

    ``keep_original`` keeps each input column as ``real_<col>`` as well (the
    reference added it, then dropped it before writing).
    """
    cols = list(job.input_columns)
    if keep_original:
        df = df.withColumns({f"real_{c}": F.col(io.quote(c)) for c in cols})
    if job.mode == "service":
        if lookup is None:
            if api_key is None and job.secret_name:
                api_key = api_key_of(job.secret_name, resolver)
            lookup = _service_lookup(job, api_key)
        given = dict(policy=policy, partitions=job.repartition_no, reject_path=value_rejects)
        out = (apply_lookup(df, cols, lookup, **given) if store is None
               else apply_stored_lookup(df, cols, lookup, store, **given))
    else:
        if keyring is None:
            if not job.secret_name:
                raise ValueError("crypto mode needs a keyring or secret_name")
            keyring = Keyring.from_source(key_source(job.secret_name, resolver))
        if job.action == "pseudonymize":
            out = pseudonymize(df, cols, keyring, deterministic=job.determinism)
        else:
            out = reidentify(df, cols, keyring)
    if job.action == "pseudonymize":
        return rename_with_prefix(out, cols, job.prefix)
    return strip_prefix(out, cols, job.prefix) if all(c.startswith(job.prefix) for c in cols) else out


def run_batch(spark: SparkSession, job: BatchJob, **kw) -> str:
    """Parquet in -> pseudonymize -> append to ``db.table`` (created if absent); its name.

    A job with a commit id appends to the record folder at the table's
    location instead, and returns that.
    """
    with scratch_scope(spark):
        return _run_batch(spark, job, **kw)


def _append_once(df: Callable[[], DataFrame], path: str, commit_id: str) -> None:
    """Nothing runs, no lookup is asked, if the id is committed already."""
    if not records.RecordFolder(path).has(commit_id):
        records.write_records(df(), path, commit_id)


def _run_batch(spark: SparkSession, job: BatchJob, **kw) -> str:
    location = io.table_location(job.output_root, "batch", job.db_name, job.table_name)
    if job.commit_id:
        _append_once(lambda: transform(io.read_parquet(spark, job.input_path), job, **kw), location, job.commit_id)
        return location
    out = transform(io.read_parquet(spark, job.input_path), job, **kw)
    io.ensure_database(spark, job.db_name, catalog=job.catalog,
                       location=location.rsplit("/", 1)[0])
    name = io.ensure_table(
        spark, job.db_name, job.table_name, out.schema, fmt=job.table_format,
        location=location, catalog=job.catalog, properties=job.properties or None,
    )
    io.append_to_table(out, job.db_name, job.table_name, catalog=job.catalog,
                       v2=job.table_format not in ("parquet", "orc", "json", "csv"))
    return name


def run_csv_batch(spark: SparkSession, job: CsvJob, *, preview_rows: int = 5, **kw) -> DataFrame:
    """CSV in -> pseudonymize -> append Parquet; returns a preview read back from the output."""
    with scratch_scope(spark):
        source = lambda: transform(io.read_csv(spark, job.input_path, sep=job.sep), job, **kw)
        if job.commit_id:
            _append_once(source, job.output_path, job.commit_id)
            return io.preview(records.read_records(spark, job.output_path), preview_rows)
        io.append_parquet(source(), job.output_path)
    return io.preview(io.read_parquet(spark, job.output_path), preview_rows)


def run_stream(spark: SparkSession, job: StreamJob, *, available_now: bool = False, metrics: str | None = None,
               **kw) -> StreamingQuery:
    """Stream in -> parse JSON -> pseudonymize -> append to ``db.table`` (created if absent).

    Crypto mode appends through the table's streaming sink; service mode and
    ``reject_path`` write each micro-batch to its own ``batch_id`` partition,
    which a replay replaces. A record that does not parse goes to
    ``reject_path`` or fails the query. ``metrics``: a name under which row,
    null and blank counts of each micro-batch are observed.
    """
    # One resolution for the whole query, on the driver.
    if job.mode == "crypto" and kw.get("keyring") is None and job.secret_name:
        kw["keyring"] = Keyring.from_source(key_source(job.secret_name, kw.pop("resolver", None)))
    options = dict(job.source_options)
    for k, v in (("streamName", job.stream_name), ("endpointUrl", job.stream_endpoint_url),
                 ("region", job.stream_region)):
        if v:
            options.setdefault(k, v)
    if job.starting_position:
        options.setdefault("startingPosition", job.starting_position)
    if job.source_format == records.RecordSource.name():
        records.register(spark)
    reader = spark.readStream.format(job.source_format).options(**options)
    parsed = stream.parse_json(reader.load(job.input_path) if job.input_path else reader.load(), job.schema)
    batches = job.mode == "service" or job.reject_path is not None
    if metrics:
        parsed = stream.observe_counts(parsed, metrics, job.input_columns)
    location = io.table_location(job.output_root, "realtime", job.db_name, job.table_name)
    checkpoint = job.checkpoint or f"{location}_checkpoint"
    io.ensure_database(spark, job.db_name, catalog=job.catalog, location=location.rsplit("/", 1)[0])
    # The output's schema: the parsed columns, the chosen ones as strings under their new names.
    types = {f.name: f.dataType for f in parsed.drop(io.CORRUPT_COLUMN).schema.fields}
    for c in job.input_columns:
        types[c] = T.StringType()
    rename = {}
    if job.action == "pseudonymize":
        rename = {c: job.prefix + c for c in job.input_columns}
    elif all(c.startswith(job.prefix) for c in job.input_columns):
        rename = {c: c[len(job.prefix):] for c in job.input_columns}
    fields = [T.StructField(rename.get(c, c), t) for c, t in types.items()]
    if batches:
        fields.append(T.StructField(stream.BATCH_COLUMN, T.LongType()))
    name = io.ensure_table(
        spark, job.db_name, job.table_name, T.StructType(fields), location=location, catalog=job.catalog,
        partitioned_by=(stream.BATCH_COLUMN,) if batches else ())
    if batches:
        return stream.start_batch_sink(
            parsed, lambda df: transform(df, job, **kw), None, checkpoint, table=name,
            reject_path=job.reject_path, trigger=job.trigger, available_now=available_now,
        )
    return stream.start_table_sink(
        transform(stream.require_parsed(parsed), job, **kw), name, checkpoint,
        trigger=job.trigger, available_now=available_now,
    )
