"""Session builder with the settings the library expects."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def build_session(app: str = "fleet", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, Arrow transfer and the UTC zone.

    ``spark.sql.shuffle.partitions`` is left to the cluster: adaptive execution
    coalesces a generous start value, and no query here depends on the number.
    Keyword names use ``__`` for the dots of a Spark setting.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")  # concurrent trials share the cluster
        # Python work per row is high: do not fold small shuffles into one task.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, for functions that run in Python there."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="fleet-package-"), "fleet.zip")
    with zipfile.ZipFile(archive, "w") as target:
        for folder, _, names in os.walk(os.path.join(root, "fleet")):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    target.write(path, os.path.relpath(path, root))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
