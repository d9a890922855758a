"""Session helpers: sane defaults for local runs and the shared folder for lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "vitrine",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench. Cluster jobs bring their own session."""
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("VITRINE_DRIVER_MEMORY", "8g")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only when the session names none (local tests) do we set one ourselves.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - sessions without a SparkContext handle
            base = None
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="vitrine-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(base)
            base = spark.sparkContext.getCheckpointDir() or base
        except Exception:  # noqa: BLE001
            spark.conf.set("spark.checkpoint.dir", base)
    base = base.rstrip("/")
    return "/".join([base, *parts]) if parts else base


def fresh_dir(spark: SparkSession, *parts: str) -> str:
    """A new, unique sub-folder of the shared folder."""
    return shared_dir(spark, *parts, uuid.uuid4().hex)
