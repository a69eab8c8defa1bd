"""Folder for intermediate tables that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``.

    Where that is unset only a local session may fall back to the machine's own temporary
    folder: on a cluster other executors could not read what one of them wrote there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="terravane-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
