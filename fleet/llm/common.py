"""Small helpers shared by the operators."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import posixpath
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from fleet.operators.keys import join_on
from fleet.operators.scans import global_ordinal
from fleet.scratch import scratch_root

ROWS_AT_ONCE = 64


def map_rows(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: pa.Schema, kind: str, rows: int = ROWS_AT_ONCE) -> DataFrame:
    """Apply ``fn`` to short runs of rows, given and returned as lists by column name.

    Runs are short so that texts of any length stay a small part of a task's memory. ``kind`` is the Spark form of
    ``schema``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                out = fn(batch.slice(at, rows).to_pydict())
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return df.mapInArrow(giving_back(run), kind)


_KEPT: dict[str, Callable[[], None]] = {}
_LAST: list[str] = []


def take_worker(owner: str, clear: Callable[[], None] | None = None) -> None:
    """Say which operator a Python worker works for; on a change, give back what the others keep in it.

    Workers outlive jobs and serve one operator after another. ``clear`` empties what the owner itself keeps.
    """
    if clear:
        _KEPT[owner] = clear
    if _LAST != [owner]:
        _LAST[:] = [owner]
        for other, drop in _KEPT.items():
            if other != owner:
                drop()
        gc.collect()
        give_back()


def give_back() -> None:
    """Return memory that is free but kept for later use to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def giving_back(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``fn`` for ``mapInArrow``, which leaves no free memory with the idle worker at the end of a task."""

    @functools.wraps(fn)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        give_back()

    return run


#: Spark's settings for the rows and bytes that go to Python and back at once, and the rows that a scan decodes at once.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.sql.parquet.columnarReaderBatchSize": "512",
}


def small_batches(spark) -> None:
    """Bound what tasks hold of texts on their way to Python and back, unless the session says otherwise.

    Spark's own bounds, 10,000 rows and 64 MB, let long texts take several hundred MB outside the heap of an executor.
    """
    for name, value in BATCHES.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)


def shared_folder(spark, name: str) -> str:
    """A new folder under the one that the cluster shares, as a URI or path."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as URI or path."""
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def write_file(folder: str, name: str, parts: list[bytes]) -> None:
    """Write one file under its final name only when it is complete, so that retried tasks leave no half file."""
    system, root = file_system(folder)
    system.create_dir(root, recursive=True)
    last, first = posixpath.join(root, name), posixpath.join(root, f"_{name}-{uuid.uuid4().hex}")
    with system.open_output_stream(first) as out:
        for part in parts:
            out.write(part)
    system.move(first, last)


def read_file(folder: str, name: str) -> bytes:
    system, root = file_system(folder)
    with system.open_input_stream(posixpath.join(root, name)) as source:
        return source.read()


GIVEN_ID = "_fl_given_id"


def unique_ids(docs: DataFrame) -> DataFrame:
    """``docs`` with the given ids in ``GIVEN_ID`` and a ``doc_id`` that is never null and never repeated.

    Ids that tell rows apart stay; rows with a null or repeated id are numbered above the largest one, in the order of id
    and content, so that runs agree. A table without such rows is not shuffled.
    """
    marked = docs.withColumn(GIVEN_ID, F.col("doc_id"))
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_fl_rows")).where("doc_id IS NULL OR _fl_rows > 1").select("doc_id")
    if repeated.isEmpty():
        return marked
    above = docs.agg(F.max("doc_id")).first()[0]
    known = join_on(marked, repeated, ["doc_id"], "left_anti")
    content = [F.col("doc_id").asc_nulls_last(), F.xxhash64(*docs.columns)]
    numbered = global_ordinal(join_on(marked, repeated, ["doc_id"], "left_semi"), content, "_fl_at")
    fresh = (F.col("_fl_at") + F.lit(0 if above is None else above + 1)).cast("long")
    return known.unionByName(numbered.withColumn("doc_id", fresh).drop("_fl_at"))


def given_ids(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` with the ids that ``unique_ids`` put aside."""
    return docs.withColumn("doc_id", F.col(GIVEN_ID)).select(*columns)
