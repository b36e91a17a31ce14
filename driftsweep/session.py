"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "8g",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", app: str = "driftsweep", extra: dict | None = None) -> SparkSession:
    """Local session used by tests and the bench; on a cluster use the cluster's own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    A private folder stands in for it only where driver and executors are one process (tests,
    local runs); any other master without the setting is an error, as executors would not
    see the driver's folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="driftsweep-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def app_id(spark: SparkSession) -> str:
    """Identifier of the running application (memo keys for tables written once per run)."""
    return spark.sparkContext.applicationId


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Make ``driftsweep`` importable in Python workers (workbook decoding).

    Spark's own mechanism, as ``--py-files`` does: the package is zipped once on the driver
    and added with ``addPyFile``, which serves it to every executor. Idempotent.
    """
    sc = spark.sparkContext
    if getattr(sc, "_driftsweep_shipped", False):
        return
    import os
    import shutil

    import driftsweep

    pkg_dir = os.path.dirname(os.path.abspath(driftsweep.__file__))
    out = tempfile.mkdtemp(prefix="driftsweep-pyfiles-")
    archive = shutil.make_archive(os.path.join(out, "driftsweep"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="driftsweep")
    sc.addPyFile(archive)
    sc._driftsweep_shipped = True


def prepare(spark: SparkSession) -> SparkSession:
    """Checkpoint folder + package on executors: call once per session before sweeping."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark
