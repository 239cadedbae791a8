"""Tree of shared conversation beginnings, built from z-fast tries.

A sequence of turns is a path; node ``d`` of it stands for its first ``d`` turns and is named by a chained digest of them.
Distinct sequences are range-partitioned in their own order, so that a beginning that very many share is spread over many
parts. Each part holds a z-fast trie: compacted nodes in a hash table under the beginning of the length in their edge that
is divisible by the largest power of two. A batch of sequences first finds its exit nodes by fat binary search and is then
inserted. At the end the edges are expanded to one row per node with sums over the part. Nodes that two neighbouring parts
share are the common beginning of the last sequence of one and the first of the other; what they count twice is taken off
along that path, so all sums over subtrees add up without walking the tree level by level.

Null roles and texts count as empty, turns with equal numbers are ordered by content, rows without a ``conv_id`` take no
part, repeated rows are repeated turns, an empty table has no nodes. The turns of one conversation are one row of 32 bytes
a turn. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from fleet.scratch import Scratch

ROOT = hashlib.md5(b"").digest()
TURNS_PER_PART = 200_000
IDS_PER_CHUNK = 4_096
_TURNS = pa.list_(pa.struct([("digest", pa.binary()), ("n_chars", pa.int64())]))
_SUMS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
_PIECES = pa.schema(
    [("digest", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64())]
    + [(name, pa.int64()) for name in _SUMS]
    + [("part", pa.int32()), ("last", pa.bool_()), ("turns", _TURNS)]
)
_PIECES_KIND = (
    "digest binary, parent binary, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "part int, last boolean, turns array<struct<digest: binary, n_chars: bigint>>"
)


def two_fattest(low: int, high: int) -> int:
    """The number above ``low`` and up to ``high`` that the largest power of two divides."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


def path_of(turns: list[bytes]) -> list[bytes]:
    """Digests of the beginnings of a sequence, the empty one first."""
    path = [ROOT]
    for turn in turns:
        path.append(hashlib.md5(path[-1] + turn).digest())
    return path


class ZFastTrie:
    """A compacted trie of paths with a hash table of its nodes at their two-fattest depths.

    A node is the root, a branching or the end of a sequence. Node 0 is the root.
    """

    def __init__(self):
        self.extent, self.above, self.path, self.chars = [0], [0], [[ROOT]], [[0]]
        self.below: list[dict[bytes, int]] = [{}]
        self.convs, self.least = [0], [None]
        self.handles: dict[bytes, int] = {}

    def locate(self, path: list[bytes], node: int = 0) -> int:
        """The deepest node, at or under ``node``, whose whole beginning the path has."""
        low, high = self.extent[node], len(path) - 1
        while low < high:
            fat = two_fattest(low, high)
            found = self.handles.get(path[fat])
            if found is not None and self._holds(found, path):
                node, low = found, self.extent[found]
            else:
                high = fat - 1
        return node

    def add(self, batch: list[tuple[list[bytes], list[int], int, int]]) -> None:
        """Insert ``(path, characters by depth, conversations that end here, smallest of them)``."""
        starts = [self.locate(path) for path, *_ in batch]
        for (path, chars, convs, least), start in zip(batch, starts):
            node = self._place(path, chars, self.locate(path, start))  # the batch itself may have grown the trie
            self.convs[node] += convs
            self.least[node] = least if self.least[node] is None else min(least, self.least[node])

    def _holds(self, node: int, path: list[bytes]) -> bool:
        at = self.extent[node]
        return at < len(path) and path[at] == self.path[node][at]

    def _place(self, path: list[bytes], chars: list[int], node: int) -> int:
        at, end = self.extent[node], len(path) - 1
        if at == end:
            return node
        child = self.below[node].get(path[at + 1])
        if child is not None:  # the path leaves inside the edge of the child
            other = self.path[child]
            most = min(end, self.extent[child])
            split = bisect_left(range(at + 1, most + 1), True, key=lambda d: path[d] != other[d]) + at
            node = self._split(node, child, split)
            if split == end:
                return node
        return self._new(node, path, chars, end)

    def _new(self, above: int, path: list[bytes], chars: list[int], extent: int) -> int:
        node = len(self.extent)
        for column, value in ((self.extent, extent), (self.above, above), (self.path, path), (self.chars, chars), (self.below, {})):
            column.append(value)
        self.convs.append(0)
        self.least.append(None)
        low = self.extent[above]
        self.below[above][path[low + 1]] = node
        self.handles[path[two_fattest(low, extent)]] = node
        return node

    def _split(self, above: int, child: int, extent: int) -> int:
        path, high = self.path[child], self.extent[child]
        del self.handles[path[two_fattest(self.extent[above], high)]]
        middle = self._new(above, path, self.chars[child], extent)
        self.above[child] = middle
        self.below[middle][path[extent + 1]] = child
        self.handles[path[two_fattest(extent, high)]] = child
        return middle

    def expanded(self) -> Iterator[tuple]:
        """``digest, parent, depth, conv_id`` and the sums of every node, those inside edges too."""
        size = len(self.extent)
        convs, least, leaves, saved = list(self.convs), list(self.least), [0] * size, [0] * size
        for node in sorted(range(size), key=self.extent.__getitem__, reverse=True):
            path, chars, end = self.path[node], self.chars[node], self.extent[node]
            leaves[node] += not self.below[node]
            up = self.above[node]
            total = saved[node]
            for depth in range(end, self.extent[up] if node else -1, -1):
                total += (convs[node] - 1) * chars[depth]
                children = len(self.below[node]) if depth == end else 1
                yield path[depth], path[depth - 1] if depth else None, depth, least[node], convs[node], children, leaves[node], total
            if node:
                convs[up] += convs[node]
                leaves[up] += leaves[node]
                saved[up] += total
                least[up] = min((x for x in (least[up], least[node]) if x is not None), default=None)


def turn_table(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: the turns of every conversation in order, as digest and length in code points."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    thin = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", digest.alias("digest"), F.length(text).cast("long").alias("n_chars")).alias("_turn")
    )
    ordered = F.sort_array(F.collect_list("_turn"))
    return thin.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["digest"].alias("digest"), t["n_chars"].alias("n_chars"))).alias("turns"))


def with_shared_heads(turns: DataFrame, every: int, head: Column, most: int) -> DataFrame:
    """Replace the first ``head`` turns of conversation ``c`` by those of conversation ``c - c % every``, if there is one."""
    bases = turns.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most).alias("_head"))
    joined = turns.withColumn("_base", F.col("conv_id") - F.col("conv_id") % every).withColumn("_h", head).join(bases, "_base", "left")
    own = "slice(turns, _h + 1, size(turns))"
    rebuilt = F.expr(f"CASE WHEN _head IS NULL THEN {own} ELSE concat(slice(_head, 1, _h), {own}) END")
    return joined.select("conv_id", rebuilt.alias("turns"))


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trie of one part: its nodes, and its first and last sequence in the order of all parts."""
    trie, first, last, part = ZFastTrie(), None, None, TaskContext.get().partitionId()
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            turns = [t["digest"] for t in row["turns"]]
            rows.append((path_of(turns), [0, *(t["n_chars"] for t in row["turns"])], row["convs"], row["least"]))
            if first is None or turns < first[0]:
                first = turns, row["turns"]
            if last is None or turns > last[0]:
                last = turns, row["turns"]
        trie.add(rows)
    if first is None:
        return
    empty = (None,) * 8
    held = [(*empty, part, False, first[1]), (*empty, part, True, last[1])]
    for node in trie.expanded():
        held.append((*node, None, None, None))
        if len(held) >= 5_000:
            yield _batch(held)
            held = []
    yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), _PIECES)], schema=_PIECES)


def _counted_twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each border of two parts, what both count along the beginning that its two sequences share."""
    for batch in batches:
        for row in batch.to_pylist():
            left, right = ([t["digest"] for t in row[side]] for side in ("left", "right"))
            common = next((i for i, (a, b) in enumerate(zip(left, right)) if a != b), min(len(left), len(right)))
            path, leaf, chars, held = path_of(left[:common]), len(left) == common, 0, []
            for depth in range(common, -1, -1):
                chars += row["left"][depth - 1]["n_chars"] if depth else 0
                held.append((path[depth], path[depth - 1] if depth else None, depth, None, 0, -int(depth < common), -int(leaf), chars, None, None, None))
            yield _batch(held)


def trie_nodes(sequences: DataFrame) -> DataFrame:
    """``digest, parent, depth, conv_id, n_convs, n_children, n_leaves, saved_tokens, parent_conv_id, ends_sha256`` of all nodes.

    ``sequences``: ``conv_id`` (distinct) and ``turns array<struct<digest binary, n_chars long>>``.
    """
    spark, scratch = sequences.sparkSession, Scratch(sequences.sparkSession)
    end = F.aggregate("turns", F.lit(ROOT), lambda so_far, turn: F.unhex(F.md5(F.concat(so_far, turn["digest"]))))
    named = scratch.store(sequences.select("conv_id", "turns", end.alias("end")), "sequences")
    distinct = named.groupBy("end", "turns").agg(F.count(F.lit(1)).alias("convs"), F.min("conv_id").alias("least"))
    total = named.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    parts = max(-(-total // TURNS_PER_PART), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // 5_000)), 1)
    pieces = scratch.store(distinct.select("turns", "convs", "least").repartitionByRange(parts, "turns").mapInArrow(_grow, _PIECES_KIND), "pieces")

    sides = pieces.where("part IS NOT NULL").select("part", "last", "turns")
    order = sides.where("last").select("part", F.lead("part").over(Window.orderBy("part")).alias("following"))  # one number per part
    lefts = sides.where("last").select("part", F.col("turns").alias("left"))
    rights = sides.where("NOT last").select(F.col("part").alias("following"), F.col("turns").alias("right"))
    borders = order.where("following IS NOT NULL").join(lefts, "part").join(rights, "following").select("left", "right")
    rows = pieces.where("part IS NULL").unionByName(borders.mapInArrow(_counted_twice, _PIECES_KIND))
    sums = [F.sum(c).alias(c) for c in _SUMS]
    nodes = scratch.store(rows.groupBy("digest", "parent", "depth").agg(F.min("conv_id").alias("conv_id"), *sums), "nodes")

    parents = nodes.select(F.col("digest").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    ends = ends_digests(named.select("end", "conv_id")).withColumnRenamed("end", "digest")
    found = nodes.join(ends, "digest", "left").join(parents, "parent", "left")
    return found.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))


def ends_digests(ends: DataFrame) -> DataFrame:
    """``end, ends_sha256``: digest of the comma-joined ids of each end, in ascending order.

    Ids are joined in slices of a range order first, so that an end that very many share is sorted and written out by many
    tasks; only the digest itself, which is sequential, runs through its slices in one.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids = None, []
        for batch in batches:
            out = []
            for end, conv_id in zip(batch["end"].to_pylist(), batch["conv_id"].to_pylist()):
                if ids and (end != now or len(ids) >= IDS_PER_CHUNK):
                    out.append((now, ids[0], ",".join(map(str, ids))))
                    ids = []
                now = end
                ids.append(conv_id)
            if out:
                yield pa.RecordBatch.from_pylist([{"end": e, "at": a, "ids": i} for e, a, i in out], schema=chunk)
        if ids:
            yield pa.RecordBatch.from_pylist([{"end": now, "at": ids[0], "ids": ",".join(map(str, ids))}], schema=chunk)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out = []
            for end, ids in zip(batch["end"].to_pylist(), batch["ids"].to_pylist()):
                if end == now:
                    state.update(b",")
                else:
                    if state:
                        out.append({"end": now, "ends_sha256": state.hexdigest()})
                    now, state = end, hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=found)
        if state:
            yield pa.RecordBatch.from_pylist([{"end": now, "ends_sha256": state.hexdigest()}], schema=found)

    chunk = pa.schema([("end", pa.binary()), ("at", pa.int64()), ("ids", pa.string())])
    found = pa.schema([("end", pa.binary()), ("ends_sha256", pa.string())])
    joined = ends.repartitionByRange("end", "conv_id").sortWithinPartitions("end", "conv_id").mapInArrow(runs, "end binary, at long, ids string")
    return joined.repartition("end").sortWithinPartitions("end", "at").mapInArrow(digests, "end binary, ends_sha256 string")


def node_turns(nodes: DataFrame, sequences: DataFrame) -> DataFrame:
    """The nodes below the root with the digest and length of their last turn, met by smallest member and depth."""
    turns = sequences.select("conv_id", F.posexplode("turns").alias("_at", "turn"))
    thin = turns.select("conv_id", (F.col("_at") + 1).cast("long").alias("depth"), F.col("turn.digest").alias("turn_digest"), F.col("turn.n_chars").alias("turn_chars"))
    return nodes.join(thin, ["conv_id", "depth"])


def nodes_sql(every: int, heads: int) -> str:
    """The same nodes from all prefixes of all rebuilt conversations, in SQL."""
    return f"""
WITH crc_bytes AS (SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, k: xor(x >> 1, 3988292384 * (x & 1))) ORDER BY i) AS t FROM range(256) r(i)),
own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS turn, length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c.conv_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c.conv_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
           lambda x, b: xor(x >> 8, t[xor(x & 255, b) + 1])), 4294967295) % {heads} AS h
  FROM (SELECT DISTINCT conv_id FROM own) c, crc_bytes),
rebuilt AS (
  SELECT c.conv_id, o.pos AS place, o.turn, o.chars FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % {every} AND o.pos <= c.h
  UNION ALL
  SELECT c.conv_id, o.pos + {heads}, o.turn, o.chars FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h),
steps AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth, chars,
         string_agg(turn, '/') OVER (PARTITION BY conv_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS path FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
lengths AS (SELECT conv_id, max(depth) AS n FROM steps GROUP BY conv_id),
nodes AS (SELECT path, depth, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs FROM steps GROUP BY path, depth),
ends AS (SELECT s.path, sha256(string_agg(CAST(s.conv_id AS VARCHAR), ',' ORDER BY s.conv_id)) AS sha FROM steps s JOIN lengths l ON s.conv_id = l.conv_id AND s.depth = l.n GROUP BY s.path),
parents AS (SELECT n.path, n.depth, p.path AS parent, p.conv_id AS parent_conv_id
            FROM nodes n JOIN steps s ON s.conv_id = n.conv_id AND s.depth = n.depth - 1 JOIN nodes p ON p.path = s.path),
childless AS (SELECT n.path, n.depth, n.conv_id, n.chars, n.n_convs, coalesce(k.children, 0) AS children
              FROM nodes n LEFT JOIN (SELECT parent, count(*) AS children FROM parents GROUP BY parent) k ON n.path = k.parent),
under AS (SELECT s.path AS top, d.path, d.chars, d.n_convs, d.children FROM childless d JOIN steps s ON s.conv_id = d.conv_id AND s.depth <= d.depth),
sums AS (SELECT top, sum(CASE WHEN children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * chars) AS saved FROM under GROUP BY top)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs, CAST(n.children AS BIGINT) AS n_children,
       CAST(u.n_leaves AS BIGINT) AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, coalesce(e.sha, sha256('')) AS ends_sha256
FROM childless n JOIN sums u ON u.top = n.path LEFT JOIN parents p ON p.path = n.path LEFT JOIN ends e ON e.path = n.path
"""
