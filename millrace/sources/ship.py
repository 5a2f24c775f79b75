"""Giving the executors' Python this package, whether or not it is installed there."""

from __future__ import annotations

import shutil
import tempfile
import threading
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()
_one_at_a_time = threading.Lock()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for each application; the driver's own file server hands it out."""
    app = spark.sparkContext.applicationId
    with _one_at_a_time:  # queries may be made in several threads
        if app in _shipped:
            return
        package = Path(__file__).resolve().parents[1]
        to = tempfile.mkdtemp(prefix="millrace-package-")
        archive = shutil.make_archive(f"{to}/{package.name}", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)
