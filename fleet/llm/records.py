"""Token ids as length-delimited binary records with masked checksums, and an offset index for shuffled reads.

Data file, little-endian, one record after another:

    uint64 length | uint32 masked crc of these 8 bytes | payload | uint32 masked crc of the payload

with payload = int64 key, then the ids as unsigned 16- or 32-bit integers. The mask of a crc32 c is
((c >> 15) | (c << 17)) + 0xa282ead8 modulo 2^32, a public convention that keeps checksums of checksummed data apart.
Index file: the bytes ``IDX1``, uint32 bytes per id, uint64 number of records, then for each record int64 key, uint64
offset of the record, uint64 number of ids.

Files are written by the tasks of one range partitioning on the key into a folder that all executors share, under
fresh names; a manifest table lists those of the attempts that Spark committed. So a lost or repeated task leaves at
most a file that nobody reads. A null text is empty; null keys are written as the least integer and read back as null;
repeated rows are written as often as they occur; an empty table gives an empty manifest.
"""

from __future__ import annotations

import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fleet.llm.bpe import encoder, ids_crc32
from fleet.llm.common import ROWS_AT_ONCE, file_system, shared_folder

MAGIC = b"IDX1"
NO_KEY = -(1 << 63)
_INDEX = np.dtype([("key", "<i8"), ("offset", "<u8"), ("n_ids", "<u8")])
_MANIFEST = pa.schema([("part", pa.int32()), ("file", pa.string()), ("records", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32())])


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(key: int, ids: bytes) -> bytes:
    payload = struct.pack("<q", key) + ids
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def unframe(record: bytes) -> tuple[int, bytes]:
    """Key and id bytes of one framed record; fails when a checksum does not hold."""
    length, check = struct.unpack_from("<QI", record)
    if masked(record[:8]) != check:
        raise ValueError("damaged record length")
    payload = record[12 : 12 + length]
    if len(payload) != length or masked(payload) != struct.unpack_from("<I", record, 12 + length)[0]:
        raise ValueError("damaged record")
    return struct.unpack_from("<q", payload)[0], payload[8:]


def write_records(df: DataFrame, tokenizer: str, end_id: int, folder: str | None = None) -> tuple[str, DataFrame]:
    """Encode ``(doc_id, text)`` and write data and index files in ascending ``doc_id`` order.

    Returns the folder and the manifest: part (ascending as the keys), file, records, n_ids and bytes per id.
    """
    spark = df.sparkSession
    folder = folder or shared_folder(spark, "records")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer), TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        width, index, at, sink = np.dtype(encode.dtype).itemsize, [], 0, None
        system, root = file_system(folder)
        end = np.array([end_id], encode.dtype).tobytes()
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = batch.slice(first, ROWS_AT_ONCE).to_pydict()
                if sink is None:
                    system.create_dir(root, recursive=True)
                    sink = system.open_output_stream(posixpath.join(root, f"{name}.rec"))
                for key, ids in zip(rows["doc_id"], encode.encode(rows["text"])):
                    key = NO_KEY if key is None else key
                    record = frame(key, ids + end)
                    index.append((key, at, (len(ids) + len(end)) // width))
                    at += len(record)
                    sink.write(record)
        if sink is None:
            return
        sink.close()
        table = np.array(index, _INDEX)
        with system.open_output_stream(posixpath.join(root, f"{name}.idx")) as out:
            out.write(MAGIC + struct.pack("<IQ", width, len(table)) + table.tobytes())
        values = (part, name, len(table), int(table["n_ids"].sum()), width)
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _MANIFEST)], schema=_MANIFEST)

    keys = [F.col("doc_id"), F.xxhash64("text")]
    placed = df.select("doc_id", "text").repartitionByRange(*keys).sortWithinPartitions(*keys, "text")
    manifest = f"{folder}/manifest"
    placed.mapInArrow(write, "part int, file string, records long, n_ids long, width int").write.parquet(manifest)
    return folder, read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/manifest")


def read_index(folder: str, name: str) -> tuple[int, np.ndarray]:
    """Bytes per id, and key, offset and number of ids of each record of a file."""
    system, root = file_system(folder)
    with system.open_input_file(posixpath.join(root, f"{name}.idx")) as source:
        data = source.read()
    if data[:4] != MAGIC:
        raise ValueError(f"{name}: no index")
    width, n = struct.unpack_from("<IQ", data, 4)
    return width, np.frombuffer(data, _INDEX, n, 16)


def read_at(folder: str, name: str, places: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Key and ids of the records at these places of a file, in this order: a shuffled read by the index."""
    width, index = read_index(folder, name)
    system, root = file_system(folder)
    with system.open_input_file(posixpath.join(root, f"{name}.rec")) as source:
        for place in places:
            size = int(index["n_ids"][place]) * width + 24
            key, ids = unframe(source.read_at(size, int(index["offset"][place])))
            yield key, np.frombuffer(ids, f"<u{width}")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: doc_id, start (ids in all records before it), n_tokens, ids (array)."""
    return _scan(spark, folder, "ids array<long>", lambda ids: ids.astype(np.int64), pa.list_(pa.int64()))


def record_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """As ``read_records``, with the crc32 of the ids as little-endian unsigned 32-bit integers in their place."""
    return _scan(spark, folder, "ids_crc32 long", ids_crc32, pa.int64())


def _scan(spark: SparkSession, folder: str, column: str, value, kind: pa.DataType) -> DataFrame:
    manifest = read_manifest(spark, folder)
    files = max(1, manifest.count())  # one row per file: the running sum over them is small
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    dealt = manifest.select("file", before.alias("before"), F.pmod("part", F.lit(files)).alias("part")).repartition(files, "part")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), (column.split()[0], kind)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                width, index = read_index(folder, row["file"])
                system, root = file_system(folder)
                starts = row["before"] + np.concatenate([[0], np.cumsum(index["n_ids"].astype(np.int64))])
                with system.open_input_stream(posixpath.join(root, f"{row['file']}.rec"), buffer_size=1 << 20) as source:
                    for first in range(0, len(index), ROWS_AT_ONCE):
                        out: list[list] = [[], [], [], []]
                        for i in range(first, min(first + ROWS_AT_ONCE, len(index))):
                            key, ids = unframe(source.read(int(index["n_ids"][i]) * width + 24))
                            ids = np.frombuffer(ids, f"<u{width}")
                            for values, v in zip(out, (None if key == NO_KEY else key, starts[i], len(ids), value(ids))):
                                values.append(v)
                        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, schema)], schema=schema)

    return dealt.select("file", "before").mapInArrow(read, f"doc_id long, start long, n_tokens long, {column}")
