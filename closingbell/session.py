"""Spark settings the jobs rely on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Run-time settings; safe to set on a session that somebody else created.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build(app: str, master: str | None = None, **settings) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one job under the cluster's shared ``spark.checkpoint.dir``.

    Only a local session that names no such folder gets a temporary one: on a cluster every
    executor would write to a disk of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.conf.get("spark.master", "local").startswith("local") or "cluster" in spark.conf.get("spark.master", ""):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="closingbell-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/closingbell/{name}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, key: str, value):
    """A run-time setting for the jobs started inside the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
