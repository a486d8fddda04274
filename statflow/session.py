"""Session helpers.

Nothing here creates a cluster: on a real cluster the caller builds the
session and we only read its settings. ``local_session`` exists for tests,
the bench and the driver contract.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session tuned for the small test scales (UI off, UTC, AQE)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("statflow")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every statflow job relies on, applied to any session.

    * UTC session time zone: epoch-millisecond columns and hour buckets must
      not depend on where the driver runs.
    * RocksDB state store for the keyed stream state (state grows with hosts).
    * A checkpoint directory only where the cluster names none (tests).
    """
    conf = spark.conf
    conf.set("spark.sql.session.timeZone", "UTC")
    if not conf.get("spark.sql.streaming.stateStore.providerClass", None) or (
        conf.get("spark.sql.streaming.stateStore.providerClass")
        .endswith("HDFSBackedStateStoreProvider")
    ):
        try:
            conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        except Exception:  # static once a stream ran; keep what is there
            pass
    checkpoint_root(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``statflow`` importable in the Python workers, once per
    application: the package is zipped from its source folder and added with
    ``addPyFile`` (what ``--py-files`` does), so executors that do not have
    it installed can run the Arrow/pandas functions defined here."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="statflow-pkg-"), "statflow.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, dirs, files in os.walk(pkg):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("statflow", os.path.relpath(full, pkg)))
    sc.addPyFile(target)
    _SHIPPED.add(app)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster's shared storage). Only
    when it is unset, as in local tests, a fresh folder under the system temp
    directory is chosen and recorded in the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = tempfile.mkdtemp(prefix="statflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


# Bytes per task aimed at for scans and shuffles on a cluster.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def tune_for_scale(spark: SparkSession, input_bytes: int, target_bytes: int = TARGET_PARTITION_BYTES) -> dict:
    """Size scan splits and shuffle partitions for ``input_bytes`` of input.

    Scans split at ``target_bytes``; the initial shuffle partition count is
    input / target (AQE then coalesces small ones to the advisory size and
    splits skewed ones). Returns the settings applied.
    """
    parts = max(200, -(-int(input_bytes) // target_bytes))
    settings = {
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_bytes),
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    return settings
