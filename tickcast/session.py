"""Session helpers: pin UTC, turn on AQE, and find the shared scratch folder.

Paths are always parameters; the only folder this library picks on its own is
a fresh sub-folder of the cluster's ``spark.checkpoint.dir`` (a shared file
system on a real cluster). A machine-local folder is only created when that
setting is absent, which happens in unit tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job of the library relies on. Time zone: news days are UTC
# days and timestamps are parsed in the session zone, so the zone is pinned.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def cluster_settings(input_bytes: int, partition_bytes: int = 256 << 20, max_partitions: int | None = None) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input.

    Start with enough shuffle partitions that each holds about
    ``partition_bytes`` of the largest input (AQE then coalesces the small
    post-aggregation stages to the advisory size and splits skewed join
    partitions), and read files in splits of the same size. At 100 TB and
    256 MiB that is ~400k; ``max_partitions`` is the caller's choice.
    """
    n = max(8, -(-int(input_bytes) // int(partition_bytes)))
    n = min(n, max_partitions) if max_partitions else n
    size = f"{int(partition_bytes) >> 20}m"
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # streaming state (daily windows, pair slots) off the JVM heap
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def build_session(
    master: str | None = "local[*]",
    app_name: str = "tickcast",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    On a cluster pass ``master=None`` so spark-submit decides, and size
    ``shuffle_partitions`` to the data (AQE coalesces small ones).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    return ensure_session(spark)


def ensure_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else built."""
    for key, value in SESSION_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


SHIP_CONF = "spark.tickcast.shipPackage"


def ship_package(spark: SparkSession) -> None:
    """Make ``tickcast`` importable in Python workers (what ``--py-files``
    does at submit time): zip the package once and add it to the context.
    Arrow functions of the library reference package code by name. Where
    the package is installed on the executors (or passed with
    ``--py-files``), set ``spark.tickcast.shipPackage=false``."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED or spark.conf.get(SHIP_CONF, "true").lower() == "false":
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    fd, zpath = tempfile.mkstemp(prefix="tickcast-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(pkg_dir):
            if "__pycache__" in dirpath:
                continue
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(dirpath, name)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a private one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        # One machine only: executors of a cluster don't share its folders.
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tickcast-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A new, unique folder under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "tickcast", *parts, uuid.uuid4().hex])


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Apply runtime SQL settings for a block and restore the caller's."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def stream_settings(spark: SparkSession, state_partitions: int | None = None) -> dict[str, str]:
    """Settings for starting a stateful streaming query. AQE does not apply
    to streaming, and the shuffle partition count of a streaming query is
    fixed in its checkpoint at first start, so it is sized on purpose: by
    default one state partition per core of the cluster."""
    n = state_partitions or max(1, spark.sparkContext.defaultParallelism)
    return {"spark.sql.shuffle.partitions": str(n)}
