"""Intermediate tables in the folder that the cluster shares.

Steps that must see one fixed layout of their rows (ordinals, prefix sums) or
that are read many times (boosting state) write a table and read it back. This
cuts the lineage in a way that survives the loss of executors.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}
_OPEN: list[Scratch] = []
_TABLES: list[tuple[str, str]] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary one in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="fleet-")
    return _LOCAL_ROOTS[context.applicationId]


def checkpoint_folder(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` write in the shared folder, where no other folder has been set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))


class Scratch:
    """One folder of intermediate tables under the shared root."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{scratch_root(spark).rstrip('/')}/fleet-{uuid.uuid4().hex}"
        _OPEN.append(self)

    def store(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        """Write ``df`` once and return the written table."""
        target = f"{self.path}/{name}"
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def drop(self, name: str = "") -> None:
        """Delete one table of this folder, or all of it. Its tables cannot be read afterwards."""
        target = f"{self.path}/{name}" if name else self.path
        path = self.spark._jvm.org.apache.hadoop.fs.Path(target)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        if not name and self in _OPEN:
            _OPEN.remove(self)


def temporary_table(spark: SparkSession, kind: str) -> str:
    """A new table name that ``release`` drops."""
    name = f"fleet_{kind}_{uuid.uuid4().hex}"
    _TABLES.append((spark.sparkContext.applicationId, name))
    return name


def release(spark: SparkSession) -> int:
    """Delete all intermediate tables of this application; results that still read them cannot be used afterwards.

    Operators return lazy results over their tables, so only the caller knows when they are done with. Returns the
    number of folders deleted.
    """
    mine = [s for s in _OPEN if s.spark.sparkContext.applicationId == spark.sparkContext.applicationId]
    for scratch in mine:
        scratch.drop()
    for entry in [t for t in _TABLES if t[0] == spark.sparkContext.applicationId]:
        spark.sql(f"DROP TABLE IF EXISTS {entry[1]}")
        _TABLES.remove(entry)
    return len(mine)
