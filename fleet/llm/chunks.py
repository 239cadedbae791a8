"""Document fingerprints by content-defined chunking.

A gear hash runs over the UTF-8 bytes; a chunk ends where its upper bits are zero. Chunk sizes are normalised: a rarer
pattern counts before the normal size and a more frequent one after it, within a least and a largest size. Boundaries
depend on the bytes before them only, so an insertion moves them but does not change the chunks elsewhere. The
fingerprint is the set of the chunks' 64-bit digests with their lengths; the likeness of one fingerprint to another is
the share of its bytes whose chunks the other has too.

An empty or null text has an empty fingerprint, which is like another empty one (1) and unlike all others (0).
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from fleet.llm.common import ROWS_AT_ONCE

LEAST, NORMAL, LARGEST = 16, 64, 256
#: Chances of a boundary at a byte: 2^-8 before the normal size, 2^-4 after it. Upper bits depend on most bytes.
RARE, OFTEN = np.uint32(0xFF000000), np.uint32(0xF0000000)
REACH = 32
GEAR = np.random.default_rng(64).integers(0, 1 << 32, 257, dtype=np.uint32)
GEAR[256] = 0  # stands before a text
NO_KEY = -(1 << 63)

_ENTRY = np.dtype([("digest", "<u8"), ("length", "<u2")])


def _gear_hashes(data: list[bytes]) -> tuple[np.ndarray, list[int]]:
    """Hashes of all bytes of several texts, each as if alone, and where the texts start."""
    starts, at, parts = [], 0, []
    gap = np.full(REACH, 256, np.uint16)
    for d in data:
        parts += [gap, np.frombuffer(d, np.uint8).astype(np.uint16)]
        starts.append(at + REACH)
        at += REACH + len(d)
    h = GEAR[np.concatenate(parts)] if parts else np.empty(0, np.uint32)
    step = 1
    while step < REACH:  # h[i] = sum of GEAR[b[i-j]] << j for j below twice the step
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    return h, starts


def chunk_ends(data: list[bytes]) -> list[list[int]]:
    """Ends of the chunks of each text."""
    h, starts = _gear_hashes(data)
    often = np.flatnonzero((h & OFTEN) == 0)
    rare = often[(h[often] & RARE) == 0].tolist()
    often = often.tolist()
    found = []
    for d, first in zip(data, starts):
        ends, begin, stop = [], first, first + len(d)
        i, j = bisect_left(rare, first), bisect_left(often, first)
        while begin < stop:
            i = bisect_left(rare, begin + LEAST - 1, i)
            if i < len(rare) and rare[i] < begin + NORMAL - 1:
                end = rare[i] + 1
            else:
                j = bisect_left(often, begin + NORMAL - 1, j)
                end = min(often[j] + 1 if j < len(often) else stop, begin + LARGEST)
            begin = min(end, stop)
            ends.append(begin - first)
        found.append(ends)
    return found


def fingerprints(data: list[bytes]) -> list[np.ndarray]:
    """Distinct digests of the chunks of each text, ascending, with their lengths."""
    out = []
    digest = xxhash.xxh3_64_intdigest
    for d, ends in zip(data, chunk_ends(data)):
        begins = [0, *ends[:-1]]
        table = np.empty(len(ends), _ENTRY)
        table["digest"] = np.array([digest(d[a:b]) for a, b in zip(begins, ends)], np.uint64)
        table["length"] = np.subtract(ends, begins) if ends else 0
        _, first = np.unique(table["digest"], return_index=True)
        out.append(table[first])
    return out


def as_text(fingerprint: np.ndarray) -> str:
    return base64.b64encode(fingerprint.tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), _ENTRY)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Containment of ``a`` in ``b``, by length."""
    if not len(a):
        return float(not len(b))
    total = int(a["length"].sum(dtype=np.int64))
    return int(a["length"][np.isin(a["digest"], b["digest"], assume_unique=True)].sum(dtype=np.int64)) / total


def edit(text: str, following: str) -> str:
    """The text with its last half replaced by the beginning of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _bucket(key: Column, splits: list[int]) -> Column:
    """Number of splits below the key, by binary search."""
    if not splits:
        return F.lit(0)
    table = F.array(*[F.lit(s).cast("long") for s in splits])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(splits).bit_length()))])
    step = lambda at, width: F.when(F.get(table, at + width - 1) < key, at + width).otherwise(at)
    return F.aggregate(steps, F.lit(0), step)


def in_descending_order(df: DataFrame, key: str, text: str, parts: int) -> DataFrame:
    """Rows ``_bucket, _extra, _key, text``: partitions sorted by descending key that hold what follows their last row.

    Buckets are ranges of keys. The largest row of every bucket also goes to the bucket above it (``_extra`` = 1), that
    of the topmost to the lowest, so that each row's follower is at hand after one shuffle. Equal keys come by text.
    """
    keyed = df.select(F.coalesce(F.col(key), F.lit(NO_KEY)).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    quantiles = [i / parts for i in range(1, parts)]
    splits = sorted(set(keyed.agg(F.percentile_approx("_key", quantiles, 100 * parts)).first()[0] or [])) if quantiles else []
    bucket = _bucket(F.col("_key"), splits)
    tops = {r[0]: r[1] for r in keyed.groupBy(bucket.alias("b")).agg(F.max("_key")).collect()}  # a row per bucket
    filled = sorted(tops)
    above = dict(zip(filled, filled[1:] + filled[:1]))
    table = lambda values, kind: F.array(*[F.lit(values.get(b)).cast(kind) for b in range(len(splits) + 1)])
    copy = F.struct(F.get(table(above, "int"), F.col("_bucket")).alias("_bucket"), F.lit(1).alias("_extra"))
    own = F.struct(F.col("_bucket").cast("int").alias("_bucket"), F.lit(0).alias("_extra"))
    is_top = F.col("_key") == F.get(table(tops, "long"), F.col("_bucket"))
    dealt = keyed.withColumn("_bucket", bucket).select("_key", "text", F.inline(F.when(is_top, F.array(own, copy)).otherwise(F.array(own))))
    placed = dealt.select("_bucket", "_extra", "_key", "text").repartition(parts, "_bucket")
    return placed.sortWithinPartitions("_bucket", "_extra", F.desc("_key"), "text")


_OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])
_OUT_SQL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprint_and_edit(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of every text of ``(doc_id, text)`` and of its edited form, with their likeness.

    The edited form takes its last half from the document that follows in descending ``doc_id`` order; the first
    follows the last. Repeated rows follow one another.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, key, text, mark, closed = None, None, "", None, True
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = batch.slice(at, ROWS_AT_ONCE).to_pydict()
                marks = fingerprints([t.encode() for t in rows["text"]])
                jobs = []
                for b, extra, k, t, m in zip(rows["_bucket"], rows["_extra"], rows["_key"], rows["text"], marks):
                    if b == bucket and not closed:
                        jobs.append((key, text, mark, edit(text, t), m))
                        closed = extra == 1
                    elif b != bucket:
                        closed = False
                    bucket, key, text, mark = b, k, t, m
                edited = [e.encode() for _, _, _, e, _ in jobs]
                values = [
                    (None if k == NO_KEY else k, len(t), hashlib.sha256(e).hexdigest(), as_text(m), as_text(em), likeness(m, em), likeness(m, following))
                    for (k, t, m, _, following), e, em in zip(jobs, edited, fingerprints(edited))
                ]
                columns = zip(*values) if values else [()] * len(_OUT)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _OUT)], schema=_OUT)

    return in_descending_order(df, "doc_id", "text", parts).mapInArrow(compare, _OUT_SQL)
