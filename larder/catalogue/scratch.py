"""A folder for tables that a query writes and reads back."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """A new path in the cluster's shared folder; local sessions without one use a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        # local-cluster has executors of its own.
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="larder-")
    return f"{shared.rstrip('/')}/larder-{uuid.uuid4().hex}"
