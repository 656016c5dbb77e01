"""Shared folders for tables that a run writes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession, name: str = "run") -> str:
    """A fresh folder under the one the cluster shares; a local one only on a local master where none is set, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="blockweave-")
    return f"{root}/{name}-{uuid.uuid4().hex}"
