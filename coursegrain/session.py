"""Session settings the jobs rely on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session_builder(app: str = "coursegrain"):
    return (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's checkpoint folder.

    ``spark.checkpoint.dir`` names storage every executor can reach.  Only where
    it is unset and Spark runs in this one process (tests, local runs) a temporary
    folder takes its place; on a cluster an unset folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), "coursegrain-shared")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored_table(df: DataFrame, purpose: str) -> DataFrame:
    """Write once below the shared folder and read back: readers share the work, and a lost executor repeats a read only."""
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
