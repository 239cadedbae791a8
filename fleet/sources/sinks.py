"""Writing tables, shards and small results."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleet.operators.keys import not_yet_written

# The columns of a stored forecast.
FORECAST_COLUMNS = "group_name string, ds date, yhat float"


def overwrite_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def ensure_table(spark: SparkSession, name: str, builder: Callable[[], DataFrame]) -> bool:
    """Create the table from ``builder()`` unless it exists; tells whether it was created."""
    if spark.catalog.tableExists(name):
        return False
    builder().write.mode("overwrite").saveAsTable(name)
    return True


def append_rows(df: DataFrame, name: str) -> None:
    """Append, creating the table on first use."""
    df.write.mode("append").saveAsTable(name)


def append_forecast(df: DataFrame, group: str, name: str) -> None:
    """Append a forecast in its stored form."""
    append_rows(
        df.select(F.col(group).cast("string").alias("group_name"), F.col("ds").cast("date"), F.col("yhat").cast("float")),
        name,
    )


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def list_folder(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names in a folder that start with ``prefix``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    names = sorted(status.getPath().getName() for status in found)
    return [name for name in names if name.startswith(prefix)]


def write_shards(df: DataFrame, path: str, shard: str = "shard") -> None:
    """One directory per shard in one job; shards that already have data are skipped.

    The rows of a shard are brought together, and those of a large shard cut in even tasks, by adaptive execution.
    """
    spark = df.sparkSession
    if path_exists(spark, path):
        df = not_yet_written(df, spark.read.parquet(path), [shard])
    df.hint("rebalance", shard).write.mode("append").partitionBy(shard).parquet(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def keep(df: DataFrame) -> DataFrame:
    """Hold a frame for repeated use, in memory and spilling to disk."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def to_driver(df: DataFrame, max_rows: int) -> pd.DataFrame:
    """A small result as pandas; anything above ``max_rows`` rows belongs in a table."""
    rows = df.limit(max_rows + 1).toPandas()
    if len(rows) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows: write it to a table")
    return rows
