"""Exact top-k search by inner product over buckets of vectors of similar length.

Vectors are range-partitioned by descending length into buckets. Queries first meet the bucket of the longest vectors, which
gives each a score that its k-th result must reach. A query then goes only to buckets whose longest vector can reach that
score, in blocks, so that neither side is ever whole in one task. Inside a bucket the score over both lengths is the cosine
that a vector needs there. If that local threshold is tight, the coordinates in which the query is largest bound the same
coordinate of the unit vectors, and only vectors inside all bounds are verified; otherwise the bucket is cut by length.
Verified scores are exact integers.

Vectors are integers after scaling, clipped to 2^26 in absolute value; shorter ones count as padded with zeros. Vectors that
are null or hold a null, NaN or infinity take no part. Every row is a vector of its own, repeated ids too; a null id is a
candidate behind all others of its score and never a query. An empty table gives nothing. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from fleet.operators.keys import block_cogroup
from fleet.scratch import Scratch

BUCKET, MOST_BUCKETS = 8_192, 4_096
QUERY_ROWS = 20_000
FOCUS = 2
#: Share of a bucket that coordinate bounds may leave before a scan by length is cheaper.
WORTH = 0.2
SLAB = 1 << 22
_LIMIT = 1 << 26
_SLACK = 1e-9
_KIND = "_q long, query_id long, vec_id long, score long, _v long"
_FOUND = pa.schema([("_q", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("_v", pa.int64())])


def scaled(vectors: DataFrame, scale: int) -> DataFrame:
    """``vec_id, _row, packed, length``: whole-number vectors as little-endian 32-bit integers, with a number per row."""
    schema = pa.schema([("vec_id", pa.int64()), ("packed", pa.binary()), ("length", pa.float64())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                out = []
                for vec_id, values in zip(part["vec_id"].to_pylist(), part["embedding"]):
                    x = values.values.to_numpy(zero_copy_only=False).astype(np.float64)
                    x = np.clip(np.floor(x * scale), -_LIMIT, _LIMIT)
                    out.append((vec_id, x.astype("<i4").tobytes(), float(np.sqrt((x * x).sum()))))
                columns = zip(*out) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    fit = F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    clean = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(fit)
    return clean.mapInArrow(pack, "vec_id long, packed binary, length double").withColumn("_row", F.monotonically_increasing_id())


def _matrix(packed: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(packed), width), np.float64)
    for i, cell in enumerate(packed):
        values = np.frombuffer(cell, "<i4")
        out[i, : len(values)] = values
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows: doubles where they are exact, 64-bit integers otherwise."""
    largest = (np.abs(a).max(initial=0) * np.abs(b).max(initial=0)) * a.shape[1]
    return a @ b.T if largest < 2**53 else a.astype(np.int64) @ b.T.astype(np.int64)


class Bucket:
    """The vectors of one bucket, the longest first, with coordinates of their unit vectors sorted as they are asked for."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        order = np.argsort(-lengths, kind="stable")
        self.vectors, self.ids, self.rows, self.lengths = vectors[order], ids[order], rows[order], lengths[order]
        self.longest = float(self.lengths[0]) if len(order) else 0.0
        self._sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _coordinate(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        if at not in self._sorted:
            unit = self.vectors[:, at] / np.maximum(self.lengths, 1e-300)
            order = np.argsort(unit)
            self._sorted[at] = unit[order], order
        return self._sorted[at]

    def by_length(self, needed: float) -> int:
        """How many vectors, from the longest, can have a product of ``needed`` with a unit vector."""
        return int(np.searchsorted(-self.lengths, -(needed * (1 - _SLACK) - _SLACK), side="right")) if needed > 0 else len(self.lengths)

    def by_coordinates(self, unit: np.ndarray, cosine: float) -> np.ndarray | None:
        """Vectors inside the bounds of the query's largest coordinates; none if the bounds leave too many."""
        needed = np.arccos(min(1.0, cosine))
        inside = None
        for at in np.argsort(-np.abs(unit))[:FOCUS]:
            own = np.arccos(np.clip(unit[at], -1, 1))
            low, high = np.cos(min(np.pi, own + needed)) - _SLACK, np.cos(max(0.0, own - needed)) + _SLACK
            values, order = self._coordinate(int(at))
            rows = order[np.searchsorted(values, low, "left") : np.searchsorted(values, high, "right")]
            inside = rows if inside is None else np.intersect1d(inside, rows, assume_unique=True)
            if len(inside) > WORTH * len(self.ids):
                return None
        return inside

    def search(self, queries: np.ndarray, own_rows: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``query, places, scores``: the k best of each query that reach its floor, smaller ids first among equals."""
        lengths = np.sqrt((queries * queries).sum(axis=1))
        scan: dict[int, list[int]] = {}
        for i, (floor, length) in enumerate(zip(floors, lengths)):
            cosine = floor / (length * self.longest) if length * self.longest > 0 else (0.0 if floor <= 0 else 2.0)
            if cosine > 1 + _SLACK:
                continue
            some = self.by_coordinates(queries[i] / length, cosine) if cosine > 0 and length > 0 else None
            if some is not None:
                yield self._best(i, some, products(queries[i : i + 1], self.vectors[some])[0], own_rows[i], floor, k)
                continue
            upto = self.by_length(floor / length) if length > 0 else len(self.ids)
            if upto:  # queries of like reach share a product; all rows of a group see its largest reach
                scan.setdefault(-(-upto * 8 // max(1, len(self.ids))), []).append(i)
        for eighths, members in scan.items():
            upto = min(len(self.ids), -(-eighths * len(self.ids) // 8))
            step = max(1, SLAB // upto)
            for at in range(0, len(members), step):
                part = members[at : at + step]
                for i, scores in zip(part, products(queries[part], self.vectors[:upto])):
                    yield self._best(i, None, scores, own_rows[i], floors[i], k)

    def _best(self, i: int, places: np.ndarray | None, scores: np.ndarray, own: int, floor: float, k: int) -> tuple[int, np.ndarray, np.ndarray]:
        fit = (self.rows[: len(scores)] if places is None else self.rows[places]) != own
        if len(scores) > k + 1:  # the query itself may be among the best
            least = max(floor, float(np.partition(scores, len(scores) - k - 1)[-k - 1]))
        else:
            least = floor
        at = np.flatnonzero(fit & (scores >= least))
        where = at if places is None else places[at]
        order = np.lexsort((self.rows[where], self.ids[where], -scores[at]))[:k]
        return i, where[order], scores[at][order]


def _search(k: int):
    nowhere = np.iinfo(np.int64).max

    def run(held: pa.Table, asked: pa.Table) -> pa.Table:
        packed, mine = held["packed"].to_pylist(), asked["packed"].to_pylist()
        width = max((len(x) // 4 for x in packed + mine), default=0)
        ids = np.array([nowhere if x is None else x for x in held["vec_id"].to_pylist()], np.int64)
        bucket = Bucket(_matrix(packed, width), ids, held["_row"].to_numpy())
        numbers, names, floors = asked["_row"].to_numpy(), asked["vec_id"].to_numpy(), asked["floor"].to_numpy()
        columns = [[] for _ in _FOUND]
        for i, where, scores in bucket.search(_matrix(mine, width), numbers, floors, k) if len(ids) else ():
            found = (np.full(len(where), numbers[i]), np.full(len(where), names[i]), bucket.ids[where], scores.astype(np.int64), bucket.rows[where])
            for column, values in zip(columns, found):
                column.append(values)
        arrays = [np.concatenate(c) if c else np.empty(0, np.int64) for c in columns]
        unnamed = arrays[2] == nowhere
        return pa.table([pa.array(a, pa.int64(), mask=unnamed if f.name == "vec_id" else None) for a, f in zip(arrays, _FOUND)], schema=_FOUND)

    return run


def top_products(vectors: DataFrame, queries: Column, k: int, scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score``: for rows that ``queries`` selects, the k largest products with all other rows.

    ``vectors`` has ``vec_id`` and ``embedding``; components are scaled and rounded down first.
    """
    scratch = Scratch(vectors.sparkSession)
    stored = scratch.store(scaled(vectors, scale), "scaled")
    size = stored.count()
    buckets = min(MOST_BUCKETS, max(1, -(-size // BUCKET)))
    ranged = stored.repartitionByRange(buckets, F.col("length").desc(), "_row").withColumn("bucket", F.spark_partition_id())
    held = scratch.store(ranged, "buckets")
    lengths = held.groupBy("bucket").agg(F.max("length").alias("longest")).orderBy("bucket").collect()  # MOST_BUCKETS rows at most
    asked = scratch.store(stored.where(queries), "queries")
    least = F.lit(float("-inf"))

    def meet(pairs: DataFrame, some: DataFrame) -> DataFrame:
        right = pairs.select("_row", "vec_id", "packed", "floor", "bucket")
        rows = max(BUCKET, -(-size // buckets)) * 2
        return block_cogroup(some.drop("length"), right, ["bucket"], _search(k), _KIND, ["_row"], ["_row"], rows, QUERY_ROWS)

    first = lengths[0]["bucket"] if lengths else 0
    opening = scratch.store(meet(asked.withColumn("floor", least).withColumn("bucket", F.lit(first)), held.where(F.col("bucket") == first)), "opening")
    by_rank = Window.partitionBy("_q").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "_v")
    floors = opening.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") == k).select(F.col("_q").alias("_row"), F.col("score").cast("double").alias("floor"))
    found = opening
    if len(lengths) > 1:
        known = asked.join(floors, "_row", "left").withColumn("floor", F.coalesce("floor", least))
        others = F.array(*[F.struct(F.lit(r["bucket"]).alias("bucket"), F.lit(r["longest"]).alias("longest")) for r in lengths[1:]])
        open_ = F.filter(others, lambda b: F.col("length") * b["longest"] * (1 + _SLACK) + _SLACK >= F.col("floor"))
        pairs = known.withColumn("_b", F.explode(open_)).withColumn("bucket", F.col("_b.bucket"))
        found = opening.unionByName(meet(pairs, held.where(F.col("bucket") != first)))
    ranked = found.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def top_sql(every: int, k: int, scale: int) -> str:
    """The same rows from all products, in SQL."""
    return f"""
WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= {k}
"""
