"""Where a job may keep its working files."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one the session names in ``spark.checkpoint.dir``, removed at its end.

    A local session without that setting gets a temporary folder; a cluster has to name one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        # "local-cluster" has executors of its own, which share no folder with the driver.
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors reach")
        shared = _local_folder()
    root = f"{shared.rstrip('/')}/tidemark/{spark.sparkContext.applicationId}"
    _removed_at_end(spark, root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def _removed_at_end(spark: SparkSession, root: str) -> None:
    """Make the session's own folder; it goes when the driver ends, as results are read until then."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        files.mkdirs(path)
        files.deleteOnExit(path)


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")
