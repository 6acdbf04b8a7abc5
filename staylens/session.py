"""Session helpers: configuration the operators rely on and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job needs regardless of cluster size. Event timestamps are UTC
# (search_date = UTC calendar day), so the session zone must be UTC too.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The JVM never compiles a method over 8000 bytes of code. Steps as wide as landing would go into one such
    # method and run interpreted, row by row; under this limit Spark splits their projections instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "staylens",
                  extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local runs (on a cluster the launcher sets master)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        **REQUIRED_CONF,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.schemaInference": "false",
        **(extra or {}),
    }
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings operators depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir``. Only in local mode, where driver
    and tasks share the machine, a scratch folder stands in for a missing one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="staylens-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, uniquely named path under the shared checkpoint root (not created)."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/staylens/{name}-{uuid.uuid4().hex[:12]}"
