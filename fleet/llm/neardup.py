"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its word shingles. Equal sets are one vertex, so exact copies are never compared. Every vertex
has ``TOKENS`` minwise tokens. A tree sends a vertex from a node to a child for each token position that a hash of the
node chooses, with chance 1 / (threshold * TOKENS); the child is named by the node, the position and the token. Pairs
above the threshold then stay together somewhere in a tree with a chance that does not fall with the size of the table,
and independent trees repeat the trial. A node of at most ``SMALL`` vertices is compared exhaustively, a larger one
branches on; what still is large after ``DEPTH`` levels is compared exhaustively on the full sets, in a grid of blocks.
Such nodes come in numbers from one group of similar documents, so they are joined by their most frequent label first,
and only rows outside that label meet the others.

Only the links that components need are looked for. First every vertex of a node meets the node's first vertex (a
star). Vertices that these links connect need not meet one another, and nodes in which nothing else is left are
dropped. So a group of near copies costs some stars, however large. Sketches of one bit per token sort out pairs that
are far from the threshold (a pair at it is lost with a chance below one in a million); all others are confirmed on the
full sets.

With ``TREES`` = 16 a pair exactly at the threshold meets with a chance of 1 - 10^-7 if its nodes are small at the
first level, and above 0.999 three levels down; pairs above the threshold meet more often.

Null and empty texts have no shingle and stay alone. Rows with equal texts are in one component; its id is the smallest
``doc_id``. Null ids count as none: their rows link others and have a component, but name one only among themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from fleet.llm.common import giving_back, map_rows, take_worker
from fleet.llm.components import smallest_reachable
from fleet.llm.shingles import mix, shingle_set
from fleet.operators.keys import block_cogroup, join_on
from fleet.scratch import Scratch

TOKENS = 128
TREES = 16
SMALL = 64
DEPTH = 3
GRID_ROWS = 500
#: Vertices whose texts are fetched by a broadcast of their ids; more are fetched by a shuffled join.
BROADCAST_IDS = 1_000_000
_CHUNK = 2_048

_SEEDS = np.random.default_rng(6).integers(0, 1 << 63, (2, TOKENS), dtype=np.uint64)
_SEEDS[1] = _SEEDS[1] * np.uint64(2) + np.uint64(1)
_POSITIONS = mix(np.arange(1, TOKENS + 1, dtype=np.uint64))


def _chosen(nodes: np.ndarray, threshold: float) -> np.ndarray:
    """Which token positions each node branches on (nodes x TOKENS)."""
    return mix(nodes[:, None] ^ _POSITIONS) < np.uint64(int(2.0**64 / (threshold * TOKENS)))


def _roots(threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Root and position of every branch at the first level."""
    roots = mix(np.arange(1_000, 1_000 + TREES, dtype=np.uint64))
    tree, position = np.nonzero(_chosen(roots, threshold))
    return roots[tree], position


def _child(nodes: np.ndarray, positions: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return mix(mix(nodes + _POSITIONS[positions]) ^ tokens)


def minwise(shingles: np.ndarray) -> np.ndarray:
    """The minwise tokens of a set."""
    out = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), _CHUNK):
        part = shingles[at : at + _CHUNK, None] ^ _SEEDS[0]
        part *= _SEEDS[1]
        np.minimum(out, part.min(axis=0), out=out)
    return mix(out)


_PROFILE = pa.schema([
    ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("vertex", pa.binary()), ("s0", pa.int64()), ("s1", pa.int64()),
    ("tokens", pa.binary()), ("nodes", pa.list_(pa.int64())),
])


def profiles(docs: DataFrame, width: int, threshold: float) -> DataFrame:
    """Set size, vertex, one-bit sketch, tokens (32 bits each) and first-level nodes of every document."""
    roots, positions = _roots(threshold)

    def profile(rows: dict[str, list]) -> dict[str, list]:
        take_worker("neardup")
        out: dict[str, list] = {f.name: [] for f in _PROFILE}
        for doc_id, text in zip(rows["doc_id"], rows["text"]):
            shingles = shingle_set(text, width)
            values = (doc_id, len(shingles), None, None, None, None, None)
            if len(shingles):
                tokens = minwise(shingles)
                bits = np.packbits((tokens >> np.uint64(63)).astype(np.uint8)).view(np.int64)
                nodes = _child(roots, positions, tokens[positions]).view(np.int64).tolist()
                values = (doc_id, len(shingles), xxhash.xxh3_128_digest(shingles.tobytes()), int(bits[0]), int(bits[1]), (tokens >> np.uint64(32)).astype("<u4").tobytes(), nodes)
            for column, value in zip(out.values(), values):
                column.append(value)
        return out

    return map_rows(docs.select("doc_id", "text"), profile, _PROFILE, "doc_id long, n_shingles long, vertex binary, s0 long, s1 long, tokens binary, nodes array<long>")


def _far_bits(threshold: float) -> int:
    """Sketches of a pair at the threshold differ in (1 - threshold) / 2 of the bits; five standard deviations more."""
    share = (1 - threshold) / 2
    return int(TOKENS * share + 5 * (TOKENS * share * (1 - share)) ** 0.5)


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64))


class Join:
    """One run: the tables it stores and the thresholds it shares."""

    def __init__(self, docs: DataFrame, width: int, percent: int):
        self.docs, self.width, self.percent = docs.select("doc_id", "text"), width, percent
        self.threshold, self.scratch = percent / 100, Scratch(docs.sparkSession)
        self.far = _far_bits(self.threshold)

    def run(self) -> DataFrame:
        profile = self.scratch.store(profiles(self.docs, self.width, self.threshold), "profiles")
        classes = profile.where("vertex IS NOT NULL").groupBy("vertex").agg(F.min("doc_id").alias("first_id"))
        self.classes = self.scratch.store(classes, "classes")
        self.vertices = self.scratch.store(
            profile.where("vertex IS NOT NULL").select("vertex", F.col("n_shingles").alias("n"), "s0", "s1", "tokens", "nodes").dropDuplicates(["vertex"]), "vertices",
        )
        profile = self._only(profile.select("doc_id", "n_shingles", "vertex"), "rows", "profiles")
        placed = self._crowded(self.vertices.select("vertex", "n", "s0", "s1", F.explode("nodes").alias("node")), "1")
        reached = smallest_reachable(self._confirm(self.scratch.store(self._stars(placed), "stars"), "stars"))
        self.labels = self.scratch.store(reached.select(F.col("node").alias("vertex"), F.col("component").alias("label")), "labels")
        links = self.labels.select(F.col("label").alias("a"), F.col("vertex").alias("b"))
        pairs, confirmed = self._below(placed)
        levels = [f"{name}-{level}" for name in ("level", "mixed", "pairs") for level in range(1, DEPTH + 1)]
        pairs = self._only(pairs, "pairs", "vertices", *levels)
        links = links.unionByName(self._confirm(pairs, "pairs"))
        if confirmed is not None:
            links = links.unionByName(confirmed)
        # Components of texts, named afterwards, so that texts without an id link others too.
        components = self.scratch.store(smallest_reachable(links).select(F.col("node").alias("vertex"), "component"), "components")
        members = components.unionByName(components.select(F.col("component").alias("vertex"), "component").distinct())
        named = members.join(self.classes, "vertex").groupBy("component").agg(F.min("first_id").alias("component_id"))
        reached = members.join(named, "component").select("vertex", "component_id")
        found = self.classes.join(reached, "vertex", "left").select("vertex", F.coalesce("component_id", "first_id").alias("component_id"))
        rows = join_on(profile.select("doc_id", "n_shingles", "vertex"), found, ["vertex"], "left")
        component = F.when(F.col("vertex").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))

    def _only(self, df: DataFrame, name: str, *done: str) -> DataFrame:
        """Store a table and delete those that were needed for it and no more, so that they do not add up on disk."""
        stored = self.scratch.store(df, name)
        for other in done:
            self.scratch.drop(other)
        return stored

    def _crowded(self, rows: DataFrame, level: str) -> DataFrame:
        """Rows of nodes with more than one vertex, with the node's size."""
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        return self.scratch.store(rows.join(sizes, "node"), f"level-{level}")

    def _stars(self, placed: DataFrame) -> DataFrame:
        """Each vertex with the first vertex of its nodes, where sketches and set sizes allow a link."""
        first = placed.groupBy("node").agg(F.min(F.struct("vertex", "n", "s0", "s1")).alias("p"))
        far = F.bit_count(F.col("s0").bitwiseXOR(F.col("p.s0"))) + F.bit_count(F.col("s1").bitwiseXOR(F.col("p.s1")))
        sizes = F.least("n", "p.n") * 100 >= F.greatest("n", "p.n") * self.percent
        met = placed.join(first, "node").where((F.col("vertex") != F.col("p.vertex")) & sizes & (far <= self.far))
        return met.select(F.col("p.vertex").alias("a"), F.col("vertex").alias("b")).distinct()

    def _labelled(self, placed: DataFrame) -> DataFrame:
        """Rows with their label, of nodes in which there is more than one label."""
        labelled = placed.join(self.labels, "vertex", "left").withColumn("label", F.coalesce("label", "vertex"))
        mixed = labelled.groupBy("node").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("node")
        return labelled.join(mixed, "node")

    def _below(self, placed: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """Pairs of different labels from small nodes of all levels, and links from what is large in the end."""
        found, confirmed = None, None
        for level in range(1, DEPTH + 1):
            rows = self.scratch.store(self._labelled(placed), f"mixed-{level}")
            pairs = self._exhaustive(rows.where(F.col("size") <= SMALL))
            large = rows.where(F.col("size") > SMALL)
            more = not large.isEmpty()
            if level == DEPTH and more:
                confirmed = self._grid(large)
            pairs = self.scratch.store(pairs, f"pairs-{level}")
            found = pairs if found is None else found.unionByName(pairs)
            if not more:
                break
            if level < DEPTH:
                placed = self._crowded(self._branch(large), str(level + 1))
        return found.distinct(), confirmed

    def _branch(self, large: DataFrame) -> DataFrame:
        threshold = self.threshold
        schema = pa.schema([("vertex", pa.binary()), ("n", pa.int64()), ("s0", pa.int64()), ("s1", pa.int64()), ("node", pa.int64())])

        def children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, _CHUNK // 8):
                    part = batch.slice(at, _CHUNK // 8)
                    held = part.column("nodes")
                    nodes = held.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                    owner = np.repeat(np.arange(part.num_rows), held.value_lengths().to_numpy(zero_copy_only=False))
                    tokens = np.frombuffer(b"".join(part.column("tokens").to_pylist()), "<u4").reshape(part.num_rows, TOKENS)
                    row, position = np.nonzero(_chosen(nodes, threshold))
                    own = owner[row]
                    below = _child(nodes[row], position, tokens[own, position].astype(np.uint64)).view(np.int64)
                    kept = part.select(["vertex", "n", "s0", "s1"]).take(pa.array(own))
                    yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(below)], schema=schema)

        nodes = large.groupBy("vertex").agg(F.collect_list("node").alias("nodes"))  # a bounded number: trees branch little
        rows = nodes.join(self.vertices.select("vertex", "n", "s0", "s1", "tokens"), "vertex")
        return rows.mapInArrow(giving_back(children), "vertex binary, n long, s0 long, s1 long, node long")

    def _exhaustive(self, small: DataFrame) -> DataFrame:
        """All pairs of different labels in small nodes, where sketches and set sizes allow a link."""
        close = self._close()
        schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = None
            for batch in _with_end(batches):
                rows = held if batch is None else batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
                if rows is None or not rows.num_rows:
                    continue
                node = rows.column("node").to_numpy()
                # A node never has more than SMALL rows, so the last one may wait for the next batch.
                stop = len(node) if batch is None else int(np.searchsorted(node, node[-1]))
                held = rows.slice(stop)
                left, right = [], []
                for step in range(1, SMALL):
                    i = np.flatnonzero(node[: max(0, stop - step)] == node[step:stop])
                    if not len(i):
                        break
                    i, j = close(rows, i, rows, i + step)
                    left.append(i), right.append(j)
                i, j = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (left, right))
                a, b = rows.column("vertex").take(pa.array(i)), rows.column("vertex").take(pa.array(j))
                yield pa.RecordBatch.from_arrays([a, b], schema=schema)

        ordered = small.select("node", "vertex", "n", "s0", "s1", "label").repartition("node").sortWithinPartitions("node", "vertex")
        return ordered.mapInArrow(giving_back(compare), "a binary, b binary").distinct()

    def _close(self):
        far, percent = self.far, self.percent

        def close(x, i: np.ndarray, y, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Of index pairs into two tables, those that may be links between different labels."""
            column = lambda t, name: t.column(name).to_numpy()
            n, m = column(x, "n")[i], column(y, "n")[j]
            bits = sum(_popcount(column(x, s)[i] ^ column(y, s)[j]).astype(np.int64) for s in ("s0", "s1"))
            ok = (np.minimum(n, m) * 100 >= np.maximum(n, m) * percent) & (bits <= far)
            i, j = i[ok], j[ok]
            a, b = x.column("label").take(pa.array(i)).to_pylist(), y.column("label").take(pa.array(j)).to_pylist()
            ok = np.array([p != q for p, q in zip(a, b)], bool)
            return i[ok], j[ok]

        return close

    def _grid(self, large: DataFrame) -> DataFrame:
        """Links in large nodes: of rows outside a most frequent label with all rows, one for each other label."""
        counts = large.groupBy("node", "label").agg(F.count(F.lit(1)).alias("k"))
        main = counts.groupBy("node").agg(F.max(F.struct("k", "label"))["label"].alias("main"))
        members = self.scratch.store(large.join(main, "node").select("main", "vertex", "label").distinct(), "members")
        full = self._sets(members.select("vertex").distinct(), "members")
        rows = self.scratch.store(members.join(full, "vertex"), "member-rows")
        percent = self.percent

        def compare(left: pa.Table, right: pa.Table) -> pa.Table:
            sets = [np.frombuffer(s, np.uint64) for s in right.column("shingles").to_pylist()]
            sizes = np.array([len(s) for s in sets])
            shingles, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
            order = np.argsort(shingles, kind="stable")
            shingles, owner = shingles[order], owner[order]
            vertices, labels = right.column("vertex").to_pylist(), right.column("label").to_pylist()
            found = set()
            for row in left.select(["vertex", "label", "shingles"]).to_pylist():
                own = np.frombuffer(row["shingles"], np.uint64)
                first = np.searchsorted(shingles, own, "left")
                times = np.searchsorted(shingles, own, "right") - first
                at = np.repeat(first - np.cumsum(times) + times, times) + np.arange(times.sum())
                common = np.bincount(owner[at], minlength=len(sets))
                near = np.flatnonzero(100 * common >= percent * (sizes + len(own) - common))
                partners = {labels[i]: vertices[i] for i in near.tolist() if labels[i] != row["label"]}
                found |= {(min(row["vertex"], v), max(row["vertex"], v)) for v in partners.values()}
            a, b = zip(*sorted(found)) if found else ((), ())
            return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

        rest = rows.where("label <> main")
        again = rows.sparkSession.read.schema(rows.schema).parquet(f"{self.scratch.path}/member-rows")
        links = block_cogroup(rest, again, ["main"], compare, "a binary, b binary", ["vertex"], ["vertex"], GRID_ROWS, GRID_ROWS).distinct()
        return self._only(links, "grid-links", "members", "members-ends", "members-sets", "member-rows")

    def _sets(self, vertices: DataFrame, name: str) -> DataFrame:
        """``vertex, shingles``: the full sets, ascending, from one text of each vertex."""
        width = self.width
        wanted = self.scratch.store(vertices.join(self.classes, "vertex").select(F.col("first_id").alias("doc_id"), "vertex"), f"{name}-ends")
        texts = self.docs.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted, self.docs["doc_id"].eqNullSafe(wanted["doc_id"])).select("vertex", "text")
        schema = pa.schema([("vertex", pa.binary()), ("shingles", pa.binary())])

        def sets(rows: dict[str, list]) -> dict[str, list]:
            found = [shingle_set(text, width).tobytes() for text in rows["text"]]
            own = [(v, s) for v, s in zip(rows["vertex"], found) if xxhash.xxh3_128_digest(s) == v]  # an id may repeat
            return {"vertex": [v for v, _ in own], "shingles": [s for _, s in own]}

        return self.scratch.store(map_rows(texts, sets, schema, "vertex binary, shingles binary").dropDuplicates(["vertex"]), f"{name}-sets")

    def _confirm(self, pairs: DataFrame, name: str) -> DataFrame:
        """Pairs, a stored table, whose full sets reach the threshold."""
        percent = self.percent
        ends = pairs.select(F.col("a").alias("vertex")).unionByName(pairs.select(F.col("b").alias("vertex"))).distinct()
        full = self._sets(ends, name)
        side = lambda v: full.select(F.col("vertex").alias(v), F.col("shingles").alias(f"set_{v}"))
        both = pairs.join(side("b"), "b").join(side("a"), "a")

        def linked(rows: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {"a": [], "b": []}
            for a, b, x, y in zip(rows["a"], rows["b"], rows["set_a"], rows["set_b"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= percent * (len(x) + len(y) - common):
                    out["a"].append(a), out["b"].append(b)
            return out

        schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
        found = map_rows(both.select("a", "b", "set_a", "set_b"), linked, schema, "a binary, b binary")
        return self._only(found, f"{name}-links", f"{name}-sets", f"{name}-ends")


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs (doc_id, text)``.

    Two documents are linked when their shingle sets share at least ``percent`` of their union; components are what
    links reach, and the document with the smallest id of a component is kept.
    """
    return Join(docs, width, percent).run()
