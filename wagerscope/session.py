"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "wagerscope", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, adaptive execution and skew-join splitting on.

    Shuffle partitions are left to the cluster's own setting: adaptive
    execution coalesces them when they turn out small.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """A fresh folder for tables a job writes and reads back.

    Lies under ``spark.checkpoint.dir`` so every executor sees it.  Only a
    local-mode session without that setting falls back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        shared = tempfile.mkdtemp(prefix="wagerscope-")
    return f"{shared.rstrip('/')}/wagerscope-{uuid.uuid4().hex}"
