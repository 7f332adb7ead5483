"""SparkSession settings shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall-clock semantics (stored instants hold
# local wall-clock values, see the time rules in the README), ANSI arithmetic,
# adaptive execution with skew-join splitting.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # streaming state on disk with incremental checkpoints: not bound by an executor's heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows of an Arrow batch: whole texts travel in them, so keep batches small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def build_session(master: str | None = None, app: str = "skyledger",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's settings.

    On a cluster ``master`` stays None and the launcher decides; tests pass
    ``local[*]``.  The Spark UI stays off: no HTTP server is opened.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session (driver-made)."""
    for k, v in BASE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a running session: keep what is there
            pass


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go when their query ends.

    Otherwise they lie on the executors' disks until the driver collects its garbage, so a job of many steps keeps those of
    all its steps.  Stages whose files are missed all the same run again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def session_key(spark: SparkSession) -> tuple[str, str]:
    """What names a session for good: an object's address may be taken again by a later session."""
    try:
        return spark.sparkContext.applicationId, spark._jsparkSession.sessionUUID()
    except Exception:  # noqa: BLE001  (remote session)
        return "session", str(id(spark))


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, staged tables and streaming checkpoints.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared folder
    there).  Only when nothing is set — local tests — a scratch folder is
    created and registered on the context so later calls agree.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (remote session: configuration only)
        sc = None
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and sc is not None:
        d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        master = sc.master if sc is not None else ""
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="skyledger-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-path of the shared checkpoint folder for one table or stream."""
    return os.path.join(checkpoint_dir(spark), name)
