"""Reading tables, queries and files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fleet.functions.draws import uniform
from fleet.functions.names import last_part

# Default and large batch sizes of a batch scan.
BATCH_ROWS = 4096
LARGE_BATCH_ROWS = 200_000

LINEAGE_SCHEMA = (
    "name string, system_type string, entity_type string, description string, url string, "
    "source_table string, properties map<string,string>, ts timestamp"
)


def read_table(
    spark: SparkSession, name: str, limit: int | None = None, lineage_table: str | None = None, reader: str = "batch"
) -> DataFrame:
    """A catalog table, optionally limited and recorded in a lineage table."""
    df = spark.table(name)
    if limit is not None:
        df = df.limit(limit)
    if lineage_table:
        log_read(spark, name, lineage_table, reader)
    return df


def read_query(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """Any SQL; keyword data frames are bound to ``{name}`` in the text."""
    return spark.sql(sql, **views)


def read_with_fallback(
    spark: SparkSession, table: str, parquet_path: str, query: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """The catalog table, or its parquet copy where the table does not resolve."""
    try:
        df = spark.table(table)
        df.schema
    except AnalysisException:
        df = spark.read.parquet(parquet_path)
    return query(df) if query else df


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_delimited(spark: SparkSession, path: str, schema: str | None = None, sep: str = "\t") -> DataFrame:
    """Delimited text with a header; without a schema the types are inferred by an extra pass."""
    reader = spark.read.option("sep", sep).option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_binary_files(spark: SparkSession, path: str, glob: str = "*.jpg") -> DataFrame:
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    )


def read_images(spark: SparkSession, path: str, glob: str = "*.jpg") -> DataFrame:
    """Image files with path, ``size`` and decoded pixel data; both are null for an unreadable file."""
    images = (
        spark.read.format("image")
        .option("dropInvalid", False)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
    )
    return images.select(
        F.col("image.origin").alias("path"),
        F.when(F.col("image.nChannels") > 0, F.struct("image.width", "image.height")).alias("size"),
        F.when(F.col("image.nChannels") > 0, F.col("image.data")).alias("content"),
    )


def group_rows(df: DataFrame, **equals) -> DataFrame:
    """Rows of one group; equality filters reach the scan."""
    for name, value in equals.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def scan_batches(spark: SparkSession, path: str, schema: str, batch_size: int = BATCH_ROWS) -> DataFrame:
    """Scan parquet with a declared schema in record batches; one row per batch.

    Returns the batch's rows as ``rows`` and its memory as ``bytes``.
    """
    source = spark.read.schema(schema).parquet(path)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, batch_size):
                piece = batch.slice(start, batch_size)
                yield pa.RecordBatch.from_pydict({"rows": [piece.num_rows], "bytes": [piece.nbytes]})

    return source.mapInArrow(sizes, "rows long, bytes long")


def checked_vectors(df: DataFrame, vector: str, dim: int) -> DataFrame:
    """Vectors of exactly ``dim`` numbers; any other length fails the query."""
    message = F.concat(F.lit(f"expected {dim} numbers, found "), F.size(vector).cast("string"))
    return df.withColumn(vector, F.when(F.size(vector) == dim, F.col(vector)).otherwise(F.raise_error(message)))


def query_vectors(df: DataFrame, key: str, dim: int, high: int = 256, seed: int = 7) -> DataFrame:
    """A query vector of random integers in [0, high) for every key, made on the executors."""
    values = [F.floor(uniform(seed, F.col(key), F.lit(i)) * high).cast("float") for i in range(dim)]
    return df.select(F.col(key).cast("long").alias("query_id"), F.array(*values).alias("query"))


def log_read(spark: SparkSession, table: str, lineage_table: str, reader: str = "batch", url: str = "") -> None:
    """Append one row about a read to the lineage table, creating it on first use."""
    at = dt.datetime.now(dt.timezone.utc)
    stamp = F.lit(at.strftime("%Y%m%dT%H%M%SZ"))
    who = F.lit(spark.sparkContext.sparkUser())
    facts = {"reader": F.lit(reader), "table": F.lit(table), "user": who, "timestamp": stamp}
    row = spark.range(1).select(
        F.concat_ws("-", F.lit("read"), last_part(F.lit(table)), stamp).alias("name"),
        F.lit("SPARK").alias("system_type"),
        F.lit("application").alias("entity_type"),
        F.concat_ws(" ", who, F.lit("loaded"), F.lit(table), F.lit("with the"), F.lit(reader), F.lit("reader")).alias("description"),
        F.lit(url).alias("url"),
        F.lit(table).alias("source_table"),
        F.create_map(*[x for name, value in facts.items() for x in (F.lit(name), value)]).alias("properties"),
        F.lit(at).cast("timestamp").alias("ts"),
    )
    row.to(T.StructType.fromDDL(LINEAGE_SCHEMA)).write.mode("append").saveAsTable(lineage_table)
