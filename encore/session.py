"""Session construction and shared scratch locations.

Scratch output (text round trips, versioned tables, stream checkpoints) goes
under the shared folder the cluster names in ``spark.checkpoint.dir``. Only
when that is unset (local tests) do we create one of our own.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def scale_conf(shuffle_bytes: int, total_cores: int,
               target_partition_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Settings that keep each task's data near ``target_partition_bytes``.

    ``shuffle_bytes`` is the size of the largest shuffle: after column
    pruning and partial aggregation that is the (user, track) pairs times the
    similar-track fan-out, far less than the raw events. Shuffle partitions
    are max(2 x cores, shuffle_bytes / target). Scans split at the same target.
    """
    wanted = max(2 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(wanted),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes":
            str(2 * target_partition_bytes),
    }


@contextmanager
def sized(spark: SparkSession, shuffle_bytes: int | None = None, partitions: int | None = None):
    """What runs inside is planned with these settings; those before come back after it.

    ``shuffle_bytes`` (as an earlier run's event log gives it) sizes all
    through ``scale_conf``; ``partitions`` sets the number of shuffle
    partitions and goes before; with neither the session's settings stay.
    """
    conf = scale_conf(shuffle_bytes, spark.sparkContext.defaultParallelism) if shuffle_bytes else {}
    if partitions:
        conf["spark.sql.shuffle.partitions"] = str(partitions)
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


_FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """The shuffle files of what is written inside go as soon as each write has ended.

    Else they stay until the driver's garbage collector finds them. For writes that
    are read back: nothing later reads a shuffle of theirs.
    """
    before = spark.conf.get(_FILE_CLEANUP, None)
    spark.conf.set(_FILE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FILE_CLEANUP) if before is None else spark.conf.set(_FILE_CLEANUP, before)


def build_session(master: str = "local[8]", app_name: str = "encore",
                  shuffle_partitions: int | None = 8,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def local_checkpoint_dir(master: str) -> str:
    """A machine-local folder, for a ``local`` or ``local[...]`` master only."""
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return tempfile.mkdtemp(prefix="encore-ckpt-")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting a local one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context, read the setting
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = local_checkpoint_dir(sc.master)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused directory under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/encore/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch tables named inside go when the block ends, also after an error.

    For jobs, whose outputs are written by then. Only paths that
    ``scratch_path`` gave out inside the block are removed, through Hadoop's file
    system of each, so any shared folder will do.
    """
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield made
    finally:
        _SCOPES.remove(made)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in made:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)


_SHIPPED: set[str] = set()


def _zip_package() -> str:
    """Zip the package's source on the driver.

    This is code, not data: Spark's file server hands it to every executor
    (as ``--py-files`` would), so it may live in a driver-local folder.
    """
    import os
    import zipfile

    import encore
    pkg_dir = os.path.dirname(os.path.abspath(encore.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="encore-pyfiles-"), "encore.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _dirs, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    return archive


def ship_package(spark: SparkSession) -> None:
    """Make ``encore`` importable by the Python workers (what ``--py-files`` does).

    Pandas stages run functions of this package in worker processes; on a
    cluster (or from any working directory) those workers only see modules
    shipped with the application. The package is zipped once per
    application and added with ``addPyFile`` (``addArtifacts`` on Spark
    Connect).
    """
    import warnings
    try:
        sc = spark.sparkContext
        key = sc.applicationId
    except Exception:  # Spark Connect
        sc, key = None, f"connect-{spark.session_id}"
    if key in _SHIPPED:
        return
    try:
        archive = _zip_package()
        if sc is not None:
            sc.addPyFile(archive)
        else:
            spark.addArtifacts(archive, pyfile=True)
        _SHIPPED.add(key)
    except Exception as exc:
        if sc is None or not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise  # elsewhere the Python stages would fail later
        warnings.warn(  # local workers may import it from the working directory
            f"could not ship the encore package to the workers: {exc}")
