"""Sessions: the settings this library wants, and the package on every worker."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once for an application; they needn't have it installed."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        here = Path(__file__).resolve().parent
        sc.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp(prefix='spark-ship-')}/{here.name}", "zip", here.parent, here.name))
        _SHIPPED.add(sc.applicationId)


def local_session(cpus: int = 8, partitions: int = 8) -> SparkSession:
    """A session on this machine, for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", partitions)
    for key, value in {"spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.sql.session.timeZone": "UTC", "spark.ui.showConsoleProgress": "false"}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
