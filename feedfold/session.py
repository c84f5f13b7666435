"""Session and scratch-folder helpers."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession


def build_session(
    app: str, master: str | None = None, conf: Mapping[str, str] | None = None
) -> SparkSession:
    """A session with the settings the jobs are tuned for.

    Skewed joins are split even where that costs a shuffle further on: one
    task holding a third of the rows costs more. Shuffle partitions are the
    cluster's to set; AQE coalesces what is too many.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A machine-local folder is used only in local mode with the setting unset.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    local = tempfile.mkdtemp(prefix="feedfold-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/feedfold/{name}-{uuid.uuid4().hex[:12]}"


def staging_path(spark: SparkSession, name: str, target: str) -> str:
    """Where the job filling a target table stages; each run overwrites the last one's copy."""
    tag = hashlib.md5(target.encode()).hexdigest()[:12]
    return f"{shared_dir(spark)}/feedfold/staged/{tag}-{name}"
