"""Folders for written tables, on the storage that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Folders of our own by application: Spark lets no running session change ``spark.checkpoint.dir``.
_OWN: dict[str, str] = {}


def fresh_folder(spark: SparkSession) -> str:
    """A path of its own under the cluster's ``spark.checkpoint.dir``; only where that is unset (tests), under a folder of this machine."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        app = spark.sparkContext.applicationId
        where = _OWN.get(app) or _OWN.setdefault(app, "file://" + tempfile.mkdtemp(prefix="gritstone-"))
    return f"{where.rstrip('/')}/gritstone-{uuid.uuid4().hex}"
