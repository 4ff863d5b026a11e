"""Session helpers.

Only settings a Spark user would set for this workload; everything else is
left to the cluster's defaults.  The checkpoint directory is read from the
session (``spark.checkpoint.dir``) and only set when it is missing, as in
tests and local runs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "wagelens") -> SparkSession:
    """Local session for tests, the bench and the contract smoke check."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _runs_locally(spark: SparkSession) -> bool:
    """Is the driver the only process (``local`` or ``local[..]`` master)?"""
    return spark.conf.get("spark.master", "").partition("[")[0] == "local"


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, object
    store); it is never replaced.  Locally (tests) a fresh scratch folder is
    taken.  Works without a SparkContext handle (Spark Connect sessions).
    """
    current = None
    sc = None
    try:
        sc = spark.sparkContext
        current = sc.getConf().get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    except Exception:  # noqa: BLE001 - no SparkContext handle (Spark Connect)
        sc = None
    if not current:
        try:
            current = spark.conf.get(CHECKPOINT_CONF, None)
        except Exception:  # noqa: BLE001 - conf not readable at runtime
            current = None
    if current:
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    if not _runs_locally(spark):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share; there is no local fallback on a cluster")
    path = fallback or tempfile.mkdtemp(prefix="wagelens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc is not None:
        sc.setCheckpointDir(path)
    try:
        spark.conf.set(CHECKPOINT_CONF, path)
    except Exception:  # noqa: BLE001 - core confs may be read-only at runtime
        pass
    return path


def session_key(spark: SparkSession) -> str:
    """Identifies the running application (one warehouse build per application)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect: fall back to the session id
        return str(getattr(spark, "session_id", id(spark)))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
