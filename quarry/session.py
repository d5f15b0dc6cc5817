"""Spark session helpers.

The library never assumes it owns the session: query functions read what they
need (for example ``spark.checkpoint.dir``) from the session they are given.
``build_session`` is for tests, the bench and command-line use only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on when it builds its own session. AQE re-plans
# joins and coalesces shuffle partitions at runtime; skew-join splits oversized
# shuffle partitions of inner joins (the hot-user case of the activity table).
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(
    master: str = "local[8]",
    app_name: str = "quarry",
    shuffle_partitions: int = 8,
    extra: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` names a shared filesystem folder and
    is used as is; unset, it is an error there. Only in local mode (tests) is a
    private scratch folder created and registered when it is unset.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path below the shared checkpoint folder, unique per call.

    Tables the library writes for itself (incremental targets, stream sinks,
    lineage cuts) live here, never in a machine-local temporary folder.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "quarry", *parts, uuid.uuid4().hex])


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
