"""Incremental ingest of image files into a table."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from fleet.functions.names import LABEL_PATTERN, label_from_path

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
SIZE_TYPE = T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())])
MIN_SIDE = 400


def stream_files(spark: SparkSession, path: str, glob: str = "*.jpg", files_per_batch: int | None = None) -> DataFrame:
    """A stream of files: those that exist and those that arrive, each once."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _header_size(content: bytes) -> tuple[int | None, int | None]:
    """Width and height from the first bytes of a PNG, GIF or JPEG file."""
    if content[:8] == b"\x89PNG\r\n\x1a\n" and len(content) >= 24:
        return struct.unpack(">II", content[16:24])
    if content[:4] == b"GIF8" and len(content) >= 10:
        return struct.unpack("<HH", content[6:10])
    at = 2
    while content[:2] == b"\xff\xd8" and at + 9 <= len(content) and content[at] == 0xFF:
        marker, length = content[at + 1], struct.unpack(">H", content[at + 2 : at + 4])[0]
        if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            height, width = struct.unpack(">HH", content[at + 5 : at + 9])
            return width, height
        at += 2 + length
    return None, None


@F.pandas_udf(SIZE_TYPE)
def image_size(content: pd.Series) -> pd.DataFrame:
    """Size of each image; null where the content is no image."""
    sizes = pd.DataFrame([_header_size(c) for c in content], columns=["width", "height"])
    return sizes.astype("Int32")


def image_rows(files: DataFrame, pattern: str = LABEL_PATTERN) -> DataFrame:
    """``path``, ``size``, ``label`` and ``content`` of image files, batch or stream."""
    return files.select("path", image_size("content").alias("size"), label_from_path("path", pattern).alias("label"), "content")


def append_stream(
    rows: DataFrame, target: str, checkpoint: str, once: bool = True, interval: str = "1 minute", table: bool = False
) -> StreamingQuery:
    """Append a stream to a path or table. ``once`` takes what is there and stops; otherwise it keeps running."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.toTable(target) if table else writer.start(target)


def ingest_images(
    spark: SparkSession, source: str, target: str, checkpoint: str, glob: str = "*.jpg", partitions: int | None = None,
    pattern: str = LABEL_PATTERN, once: bool = True, table: bool = False,
) -> StreamingQuery:
    """Files to rows to the target, exactly once per file over any number of runs."""
    files = stream_files(spark, source, glob)
    if partitions:
        files = files.repartition(partitions)
    return append_stream(image_rows(files, pattern), target, checkpoint, once, table=table)


def label_counts(images: DataFrame, min_side: int = MIN_SIDE) -> DataFrame:
    """Images per label whose width and height are at least ``min_side``, ordered by the count."""
    large = images.where((F.col("size.width") >= min_side) & (F.col("size.height") >= min_side))
    return large.groupBy("label").agg(F.count(F.lit(1)).alias("cnt")).orderBy("cnt", "label")
