"""Vector search: shards, exact search, inverted lists, product codes, routing and merging.

Distances are squared L2. Ties go to the lower id. Vectors have ``id`` and
``vector``, queries ``query_id`` and ``query``; hits are ``query_id, id, distance``
and, after the merge, ``rank`` from 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fleet.functions.draws import uniform
from fleet.operators.keys import block_cogroup
from fleet.operators.scans import global_ordinal
from fleet.scratch import Scratch
from fleet.sources.sinks import list_folder

# Fixed value: the size of a product code's alphabet.
CODES = 256

# Rows of one block of each side. Equal blocks repeat both sides about equally often.
VECTOR_ROWS = 20_000
QUERY_ROWS = 20_000
PAIR_STEP = 1 << 16  # pairs whose differences are held at a time
QUERY_STEP = 256  # queries of a block that are compared at a time, at most
STEP_BYTES = 8 << 20  # of their distances to the block
BROADCAST_BYTES = 32 << 20
#: Version of the rows that an index is built from.
LEAST_VERSION = -(1 << 63)
HIT_SCHEMA = "query_id long, id long, distance double"


def shard_vectors(df: DataFrame, rows_per_shard: int, order: str = "id", out: str = "shard") -> DataFrame:
    """Number the rows in order and cut them in shards of equal size; no row is lost whatever the ids."""
    placed = global_ordinal(df, [order], "_ordinal")
    return placed.withColumn(out, F.floor(F.col("_ordinal") / rows_per_shard)).drop("_ordinal")


def route_to_shard(user_id: Column, shards: Column | int) -> Column:
    return F.pmod(F.coalesce(user_id, F.lit(0)), shards if isinstance(shards, Column) else F.lit(shards))


def fan_out(queries: DataFrame, shards: int) -> DataFrame:
    """Send every query to all shards."""
    return queries.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))


def topk_merge(hits: DataFrame, k: int) -> DataFrame:
    """The best ``k`` hits of every query over all shards; each task first keeps its own best."""
    order = Window.partitionBy("query_id").orderBy("distance", "id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.withColumn("rank", F.col("rank").cast("long"))


# --- numpy helpers for one block -------------------------------------------------


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _ints(column) -> np.ndarray:
    return column.to_numpy().astype(np.int64) if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)


def _distances(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    return (queries**2).sum(1)[:, None] - 2.0 * (queries @ vectors.T) + (vectors**2).sum(1)[None, :]


def _step(vectors: int, most: int = QUERY_STEP) -> int:
    """Queries whose distances to a block of vectors take ``STEP_BYTES`` or less."""
    return max(1, min(most, STEP_BYTES // (8 * max(vectors, 1))))


def _nearest(query_ids, queries, ids, vectors, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exact best ``k`` of a block per query: a product narrows the block, differences decide."""
    found = []
    slack = 1e-9 * (1.0 + (vectors**2).sum(1).max(initial=0.0))
    step = _step(len(vectors))
    for start in range(0, len(queries), step):
        part = queries[start : start + step]
        rough = _distances(vectors, part)
        kth = np.partition(rough, min(k, rough.shape[1]) - 1, axis=1)[:, min(k, rough.shape[1]) - 1]
        row, near = np.nonzero(rough <= (kth + slack + 1e-9 * (part**2).sum(1))[:, None])
        exact = np.concatenate([
            ((vectors[near[at : at + PAIR_STEP]] - part[row[at : at + PAIR_STEP]]) ** 2).sum(1) for at in range(0, len(row), PAIR_STEP)
        ])
        _, kept, far = _keep_best(row, np.arange(len(row)), exact, k, ids[near])
        found.append((query_ids[start + row[kept]], ids[near[kept]], far))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return tuple(np.concatenate(part) for part in zip(*found))


def _hits(q, i, d) -> dict:
    return {"query_id": pa.array(q, pa.int64()), "id": pa.array(i, pa.int64()), "distance": pa.array(d, pa.float64())}


def _keep_best(q, i, d, k: int, tie=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best ``k`` rows of every query id; equal distances by ``tie``, the ids if not given."""
    order = np.lexsort((i if tie is None else tie, d, q))
    q, i, d = q[order], i[order], d[order]
    starts = np.r_[0, np.flatnonzero(np.diff(q)) + 1] if len(q) else np.empty(0, int)
    place = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
    keep = place < k
    return q[keep], i[keep], d[keep]


def _small(df: DataFrame, columns: list[str], row_bytes: int) -> pa.Table | None:
    """The rows as one table if they fit the broadcast limit, else None."""
    most = max(BROADCAST_BYTES // row_bytes, 1)
    rows = df.select(*columns).limit(most + 1).toArrow()
    return rows if rows.num_rows <= most else None


def _dim(df: DataFrame, column: str) -> int:
    first = df.select(F.size(column)).first()
    return first[0] if first else 1


# --- exact search ----------------------------------------------------------------


def knn_exact(
    queries: DataFrame, vectors: DataFrame, k: int, query_rows: int = QUERY_ROWS, vector_rows: int = VECTOR_ROWS
) -> DataFrame:
    """Exact nearest neighbours of every query.

    A query set below the broadcast limit goes to the vectors, which are then scanned
    once and not shuffled. A larger one meets them as a grid of blocks.
    """
    dim = _dim(queries, "query")
    batch = _small(queries, ["query_id", "query"], 8 * dim + 16)
    if batch is not None:
        ids, matrix = _ints(batch["query_id"]), _matrix(batch["query"])
        shared = queries.sparkSession.sparkContext.broadcast((ids, matrix))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            query_ids, targets = shared.value
            best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
            for rows in batches:
                if rows.num_rows and len(query_ids):
                    found = _nearest(query_ids, targets, _ints(rows.column("id")), _matrix(rows.column("vector")), k)
                    best = _keep_best(*(np.concatenate(pair) for pair in zip(best, found)), k)
            yield pa.RecordBatch.from_pydict(_hits(*best))

        return topk_merge(vectors.select("id", "vector").mapInArrow(scan, HIT_SCHEMA), k)

    hits = block_cogroup(
        vectors.select("id", "vector"), queries.select("query_id", "query"), [], _block_search(k), HIT_SCHEMA, ["id"], ["query_id"], vector_rows, query_rows,
    )
    return topk_merge(hits, k)


def _block_search(k: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found = _nearest(
            _ints(right["query_id"]), _matrix(right["query"]), _ints(left["id"]), _matrix(left["vector"]), k
        )
        return pa.table(_hits(*found))

    return search


def search_shards(
    queries: DataFrame, vectors: DataFrame, k: int, shard: str = "shard",
    query_rows: int = QUERY_ROWS, vector_rows: int = VECTOR_ROWS,
) -> DataFrame:
    """Search only the shards that each query names, and merge the hits over them."""
    asked = queries.select("query_id", "query", F.col(shard).alias("cell"))
    stored = vectors.select("id", "vector", F.col(shard).alias("cell"))
    return topk_merge(_search_cells(asked, stored, _block_search(k), k, query_rows, vector_rows), k)


# --- inverted lists --------------------------------------------------------------


class IvfIndex:
    """Vectors stored by their nearest centroid, with the centroids and optional codebooks beside them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def centroids(self) -> np.ndarray:
        rows = self.spark.read.parquet(f"{self.path}/centroids").orderBy("cell").collect()
        return np.array([r["centroid"] for r in rows], dtype=np.float64)

    def codebooks(self) -> np.ndarray | None:
        """Codebooks as (sub-vector, code, position), or None for an index without codes."""
        rows = self.spark.read.parquet(f"{self.path}/codebooks").orderBy("sub", "code").collect()
        if not rows:
            return None
        flat = np.array([r["centroid"] for r in rows], dtype=np.float64)
        return flat.reshape(1 + max(r["sub"] for r in rows), -1, flat.shape[1])

    def vectors(self) -> DataFrame:
        """The current rows: of an id the highest version counts, of equal versions the last batch; deleted ids are gone."""
        return self.newest().where("NOT deleted").drop("version", "deleted")

    def newest(self) -> DataFrame:
        """The row of the highest version of every id, deletions too.

        Rows of the base whose id no later batch names are read as they are. The others, base rows among them, are
        compared by id alone, and the winners are met again by id, version and batch.
        """
        stored = self.spark.read.parquet(f"{self.path}/vectors")
        if list_folder(self.spark, f"{self.path}/vectors", "batch=") == ["batch=-1"]:
            return stored.drop("batch")
        base, later = stored.where("batch = -1"), stored.where("batch >= 0")
        named = later.select(F.col("id").alias("_id")).distinct()
        touched = F.col("id") == F.col("_id")
        thin = ["id", "version", "batch"]
        marks = later.select(*thin).unionByName(base.select(*thin).join(named, touched, "left_semi"))
        wins = marks.groupBy("id").agg(F.max(F.struct("version", "batch")).alias("_w"))
        wins = wins.select(F.col("id").alias("_id"), F.col("_w.version").alias("_version"), F.col("_w.batch").alias("_batch"))
        won = touched & (F.col("version") == F.col("_version")) & (F.col("batch") == F.col("_batch"))
        newer = stored.join(wins, won).select(*stored.columns)
        return base.join(named, touched, "left_anti").unionByName(newer).drop("batch")


def train_centroids(vectors: DataFrame, cells: int, seed: int = 1) -> DataFrame:
    """Coarse centroids by k-means over all rows: ``cell`` and ``centroid``."""
    model = KMeans(k=cells, seed=seed, maxIter=10).fit(vectors.select(array_to_vector("vector").alias("features")))
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return vectors.sparkSession.createDataFrame(rows, "cell int, centroid array<double>")


def assign_cells(vectors: DataFrame, centroids: np.ndarray, out: str = "cell") -> DataFrame:
    """Add the nearest centroid of each vector; centroids are part of the model and bounded by it."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)
    schema = vectors.withColumn(out, F.lit(0)).schema

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            near = _distances(shared.value, _matrix(rows.column("vector"))).argmin(1) if rows.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(near, pa.int32())], [*rows.schema.names, out])

    return vectors.mapInArrow(assign, schema)


def train_codebooks(vectors: DataFrame, sub_vectors: int, codes: int = CODES, seed: int = 1, rounds: int = 8) -> DataFrame:
    """Codebooks of all sub-vectors by k-means, one job per round: ``sub``, ``code``, ``centroid``."""
    spark = vectors.sparkSession
    dim = _dim(vectors, "vector")
    if dim % sub_vectors:
        raise ValueError(f"{sub_vectors} sub-vectors do not divide {dim} dimensions")
    width = dim // sub_vectors
    scratch = Scratch(spark)
    stored = scratch.store(vectors.select("id", "vector"), "vectors")
    first = stored.orderBy(uniform(f"{seed}|start", "id"), "id").limit(codes).select("vector").toArrow()
    start = _matrix(first["vector"])
    books = start.reshape(len(start), sub_vectors, width).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            current = shared.value
            total_, count_ = np.zeros_like(current), np.zeros(current.shape[:2])
            for rows in batches:
                if not rows.num_rows:
                    continue
                parts = _matrix(rows.column("vector")).reshape(rows.num_rows, len(current), -1)
                for s in range(len(current)):
                    near = _distances(current[s], parts[:, s]).argmin(1)
                    np.add.at(total_[s], near, parts[:, s])
                    count_[s] += np.bincount(near, minlength=current.shape[1])
            sub, code = np.nonzero(count_)
            positions = np.arange(current.shape[2])
            yield pa.RecordBatch.from_pydict({
                "sub": pa.array(np.repeat(sub, len(positions)), pa.int32()),
                "code": pa.array(np.repeat(code, len(positions)), pa.int32()),
                "pos": pa.array(np.tile(positions, len(sub)), pa.int32()),
                "total": pa.array(total_[sub, code].ravel(), pa.float64()),
                "n": pa.array(np.repeat(count_[sub, code], len(positions)), pa.float64()),
            })

        moved = stored.mapInArrow(sums, "sub int, code int, pos int, total double, n double")
        moved = moved.groupBy("sub", "code", "pos").agg((F.sum("total") / F.sum("n")).alias("mean")).toArrow()
        books = books.copy()
        books[_ints(moved["sub"]), _ints(moved["code"]), _ints(moved["pos"])] = moved["mean"].to_numpy()
    scratch.drop()
    rows = [(s, c, [float(x) for x in books[s, c]]) for s in range(sub_vectors) for c in range(books.shape[1])]
    return spark.createDataFrame(rows, "sub int, code int, centroid array<double>")


def pq_encode(vectors: DataFrame, codebooks: np.ndarray, out: str = "codes") -> DataFrame:
    """Add the product code of each vector, one number per sub-vector."""
    shared = vectors.sparkSession.sparkContext.broadcast(codebooks)
    schema = vectors.withColumn(out, F.lit(None).cast("array<short>")).schema

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for rows in batches:
            parts = _matrix(rows.column("vector")).reshape(rows.num_rows, len(books), books.shape[2])
            codes = np.stack([_distances(books[s], parts[:, s]).argmin(1) for s in range(len(books))], axis=1)
            offsets = pa.array(np.arange(0, codes.size + 1, len(books)), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(codes.ravel(), pa.int16()))
            yield pa.RecordBatch.from_arrays([*rows.columns, lists], [*rows.schema.names, out])

    return vectors.mapInArrow(encode, schema)


def ivf_build(
    vectors: DataFrame, path: str, cells: int = 100, sub_vectors: int | None = None,
    centroids: DataFrame | None = None, codes: int = CODES, seed: int = 1,
) -> IvfIndex:
    """Build an index at ``path``: train or take the centroids, assign all vectors, store them by cell."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("id").cast("long").alias("id"), "vector")
    found = train_centroids(rows, cells, seed) if centroids is None else centroids.select("cell", "centroid")
    found.write.mode("overwrite").parquet(f"{path}/centroids")
    if sub_vectors:
        books = train_codebooks(rows, sub_vectors, codes, seed)
    else:
        books = spark.createDataFrame([], "sub int, code int, centroid array<double>")
    books.write.mode("overwrite").parquet(f"{path}/codebooks")
    index = IvfIndex(spark, path)
    placed = place_vectors(index, rows).withColumns({"version": F.lit(LEAST_VERSION), "deleted": F.lit(False), "batch": F.lit(-1)})
    gather_cells(placed).write.mode("overwrite").partitionBy("batch", "cell").parquet(f"{path}/vectors")
    return index


def gather_cells(placed: DataFrame) -> DataFrame:
    """Bring the rows of a cell together before a write by cell; adaptive execution cuts a crowded cell in even tasks
    and gives small ones a task together."""
    return placed.hint("rebalance", "cell")


def place_vectors(index: IvfIndex, rows: DataFrame) -> DataFrame:
    """Rows with their cell and, where the index has codebooks, their code."""
    placed = assign_cells(rows, index.centroids())
    books = index.codebooks()
    return placed if books is None else pq_encode(placed, books)


def probe_cells(queries: DataFrame, centroids: np.ndarray, nprobe: int) -> DataFrame:
    """The ``nprobe`` nearest cells of every query, one row each."""
    shared = queries.sparkSession.sparkContext.broadcast(centroids)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if not rows.num_rows:
                continue
            gaps = _distances(shared.value, _matrix(rows.column("query")))
            near = np.argsort(gaps, axis=1, kind="stable")[:, :nprobe]
            source = np.repeat(np.arange(rows.num_rows), near.shape[1])
            taken = rows.take(pa.array(source))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(near.ravel(), pa.int32())], ["query_id", "query", "cell"])

    rows = queries.select(F.col("query_id").cast("long").alias("query_id"), F.col("query").cast("array<double>").alias("query"))
    return rows.mapInArrow(probe, "query_id long, query array<double>, cell int")


def ivf_search(
    queries: DataFrame, index: IvfIndex, k: int, nprobe: int = 1, refine: int | None = None,
    query_rows: int = QUERY_ROWS, vector_rows: int = VECTOR_ROWS,
) -> DataFrame:
    """Search the nearest ``nprobe`` cells of every query.

    Only the probed cells are read. With ``refine`` the product codes are searched for
    ``refine * k`` candidates, whose exact distances then decide.
    """
    spark = queries.sparkSession
    centroids = index.centroids()
    probes = Scratch(spark).store(probe_cells(queries, centroids, min(nprobe, len(centroids))), "probes")
    cells = [r["cell"] for r in probes.select("cell").distinct().collect()]  # at most one per centroid
    stored = index.vectors().where(F.col("cell").isin(cells))
    if refine is None:
        hits = _search_cells(probes, stored.select("id", "vector", "cell"), _block_search(k), k, query_rows, vector_rows)
        return topk_merge(hits, k)

    books = spark.sparkContext.broadcast(index.codebooks())
    wanted = refine * k

    def by_code(left: pa.Table, right: pa.Table) -> pa.Table:
        tables, ids = books.value, _ints(left["id"])
        codes = _matrix(left["codes"]).astype(np.int64)
        query_ids, targets = _ints(right["query_id"]), _matrix(right["query"])
        found = []
        size = _step(len(ids), QUERY_STEP // 4)
        for start in range(0, len(targets), size):
            step = slice(start, start + size)
            rough = np.zeros((len(targets[step]), len(ids)))
            for s in range(len(tables)):
                part = targets[step, s * tables.shape[2] : (s + 1) * tables.shape[2]]
                rough += _distances(tables[s], part)[:, codes[:, s]]
            if rough.shape[1] > wanted:  # only what may be among the best is sorted
                kth = np.partition(rough, wanted - 1, axis=1)[:, wanted - 1]
                row, near = np.nonzero(rough <= kth[:, None])
            else:
                row, near = np.nonzero(np.ones(rough.shape, bool))
            found.append(_keep_best(query_ids[step][row], ids[near], rough[row, near], wanted))
        return pa.table(_hits(*(np.concatenate(part) for part in zip(*found))))

    rough = _search_cells(probes, stored.select("id", "codes", "cell"), by_code, wanted, query_rows, vector_rows)
    chosen = topk_merge(rough, wanted).select("query_id", "id")
    exact = chosen.join(stored.select("id", "vector"), "id").join(queries.select("query_id", "query"), "query_id")
    terms = F.zip_with("vector", "query", lambda a, b: F.pow(a.cast("double") - b.cast("double"), F.lit(2.0)))
    distance = F.aggregate(terms, F.lit(0.0), lambda t, x: t + x)
    return topk_merge(exact.select("query_id", "id", distance.alias("distance")), k)


def _search_cells(probes: DataFrame, stored: DataFrame, fn, k: int, query_rows: int, vector_rows: int) -> DataFrame:
    """Hits of all probes: probes within the broadcast limit go to the stored cells, which then stay
    where they are; more probes meet the cells as a grid of blocks."""
    few = _small(probes, ["query_id", "query", "cell"], 8 * _dim(probes, "query") + 24)
    if few is None:
        return block_cogroup(stored, probes, ["cell"], fn, HIT_SCHEMA, ["id"], ["query_id"], vector_rows, query_rows)
    shared = probes.sparkSession.sparkContext.broadcast(few)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = _ints(shared.value["cell"])
        best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        for rows in batches:
            have = rows.column("cell").to_numpy(zero_copy_only=False)
            for cell in np.unique(have):
                asked = shared.value.filter(pa.array(cells == cell))
                held = pa.Table.from_batches([rows]).filter(pa.array(have == cell))
                if asked.num_rows:
                    hits = fn(held, asked)
                    found = _ints(hits["query_id"]), _ints(hits["id"]), hits["distance"].to_numpy()
                    best = _keep_best(*(np.concatenate(pair) for pair in zip(best, found)), k)
        yield pa.RecordBatch.from_pydict(_hits(*best))

    return stored.mapInArrow(scan, HIT_SCHEMA)


def search_to_table(queries: DataFrame, index: IvfIndex, k: int, path: str, nprobe: int = 1, batch: int = QUERY_ROWS) -> DataFrame:
    """Search any number of queries in blocks of ``batch`` rows and write the hits; returns the written table."""
    hits = ivf_search(queries, index, k, nprobe, query_rows=batch)
    hits.write.mode("overwrite").parquet(path)
    return queries.sparkSession.read.schema(hits.schema).parquet(path)
