"""Session settings the operators are designed for, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings that matter for the operators; everything else is left to the cluster.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot key on one side of a join is split over several tasks by AQE.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Of a name that is twice in a JSON object the last one counts; without this, whole-record outputs of such a record
    # hold its declared members alone.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Python state processors keep their state in RocksDB.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"


def build(master: str | None = None, app: str = "tidehouse", **extra: str) -> SparkSession:
    """Create (or get) a session with the recommended settings; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared folder of the cluster, for written tables and stream checkpoints.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Only a local session without that setting falls
    back to a temporary folder; on a cluster a machine-local folder would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="tidehouse-")
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex}") if "://" not in root else \
        f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
