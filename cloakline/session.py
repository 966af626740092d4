"""Session helpers: a local session for tests/bench, and the shared folder.

Lineage is cut with ``DataFrame.checkpoint()`` (never ``localCheckpoint``),
which writes to ``spark.checkpoint.dir``. On a cluster that setting names a
shared folder and is read from the session; a private temporary folder is
set only when it is unset *and* the master is local (tests, bench).
"""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", app: str = "cloakline", **conf: str) -> SparkSession:
    cores = str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session (set locally if unset)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get(CHECKPOINT_CONF, None)
    if not current:
        current = sc.getConf().get(CHECKPOINT_CONF, None)
    if not current:
        if not _is_local(spark):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; point it at a folder shared by the cluster"
            )
        current = tempfile.mkdtemp(prefix="cloakline-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``cloakline`` importable in Python workers (once per SparkContext).

    Only the service-mode paths (``mapInPandas``, pandas UDFs) run Python on
    executors; they unpickle lookups defined in this package. On a cluster the
    package is deployed with the job (``--py-files`` or an installed wheel),
    so nothing is done there. In local mode (tests, bench) the workers only
    see the driver's cwd, so the package is zipped below the session's
    checkpoint folder and added with ``addPyFile``.
    """
    import os
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED or not _is_local(spark):
        return
    base = checkpoint_dir(spark)
    if "://" in base and not base.startswith("file:"):
        return
    folder = os.path.join(base.removeprefix("file:"), "pkg", uuid.uuid4().hex[:12])
    os.makedirs(folder, exist_ok=True)
    target = os.path.join(folder, "cloakline.zip")
    root = os.path.dirname(os.path.abspath(__file__))
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for sub, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(sub, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(target)
    _SHIPPED.add(app)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh (not yet existing) path below the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/scratch/{name}-{uuid.uuid4().hex[:12]}"


_scopes = threading.local()


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the scratch tables written inside the block when it ends.

    Service mode, ``linkage='run'`` and inputs that must be read twice leave
    tables in the shared folder, which lazy results read: put the calls and
    the write of their result in one block, and nothing stays. The jobs and
    the per-batch stream sink do. Tables written outside of any block go when
    the driver's interpreter ends. Per thread, so concurrent streams in one
    driver keep their own lists.
    """
    stack = getattr(_scopes, "stack", None)
    if stack is None:
        stack = _scopes.stack = []
    created: list[str] = []
    stack.append(created)
    try:
        yield created
    finally:
        stack.pop()
        for path in created:
            delete_path(spark, path)


_UNSCOPED: list[tuple[SparkSession, str]] = []


@atexit.register
def _delete_unscoped() -> None:
    """Scratch tables that no scope owns; the gateway still answers when Python ends."""
    for spark, path in _UNSCOPED:
        try:
            delete_path(spark, path)
        except Exception:  # noqa: BLE001 -- the JVM is gone: nothing can be deleted any more
            return


def track_scratch(spark: SparkSession, path: str) -> None:
    stack = getattr(_scopes, "stack", None)
    if stack:
        stack[-1].append(path)
    else:
        _UNSCOPED.append((spark, path))


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursive delete through the Hadoop file system of ``path``."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def write_scratch(df, name: str):
    """Write ``df`` as a Parquet table below the shared folder and read it back.

    Cuts the lineage like ``checkpoint()`` (a lost executor re-reads the files,
    nothing is recomputed), gives Catalyst the table's statistics, and the
    path is known, so a ``scratch_scope`` can delete it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    track_scratch(spark, path)
    return spark.read.parquet(path)
