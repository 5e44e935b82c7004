"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that hold at any size. Partition counts are left to AQE: it starts
# from `initialPartitionNum` and merges small shuffle partitions at run time.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "certflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; the cluster's own values win when given in `conf`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder named in `spark.checkpoint.dir`.

    Every executor must see what another one wrote, so a machine-local folder
    is used only when the setting is absent and the master is local.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="certflow-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
