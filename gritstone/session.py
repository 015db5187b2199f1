"""Session factory and shipping of this package to Python workers."""

from __future__ import annotations

import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(app: str = "gritstone", cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A local session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", os.environ.get("GRITSTONE_PARTITIONS", "8"))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give Python workers this package, through the driver's own file server.

    Called by operators that run Python on executors, so that they also work where the package is on the driver's path only.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp()
    target = Path(folder, "gritstone.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(str(target))
    shutil.rmtree(folder, ignore_errors=True) if not target.exists() else None
    _SHIPPED.add(context.applicationId)
