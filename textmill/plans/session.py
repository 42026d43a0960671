"""Sessions, and the package on the executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def session(cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "6g"))
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[2]
    folder = tempfile.mkdtemp(prefix="textmill-")  # the driver serves the archive from here until the application ends
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = f"{folder}/textmill.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted((top / "textmill").rglob("*.py")):
            z.write(f, f.relative_to(top))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
