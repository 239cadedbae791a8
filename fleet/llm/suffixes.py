"""Removal of repeated passages by a logarithmic family of sparse suffix arrays.

A byte is repeated when a string of ``SPAN`` bytes that covers it also starts earlier: in a document with a smaller id,
or further ahead in the same one. Suffixes are taken at anchors: the place in each window of ``SPAN`` bytes where a hash
of ``DEPTH`` bytes is least. Equal windows have their anchor at the same place, so no repeated string is missed, and
about one suffix in 35 remains. A suffix array holds suffixes in the order of their first bytes, then of a fingerprint
of their first ``DEPTH`` bytes, and with each the fingerprint of its reach: all windows that have this anchor.

Batches of documents get a suffix array each. The arrays are cut by fingerprint into parts, and each part keeps a family
of levels: a new batch's suffixes are merge-scanned against every level for suffixes with an equal beginning, then they
become a level, and levels of equal size are merged, so that n batches make about log2 n levels. What meets is settled:

* a suffix whose whole reach occurs earlier is removed with its reach;
* a suffix that meets only different reaches may still share a window with one. A window lies at least ``HALF`` bytes
  to one side of its anchor, so suffixes go on whose beginning together with the bytes before it, or with more bytes
  after it, is met a second time. Their reaches are cut in stretches of up to ``STRETCH`` windows, by the distance to
  the anchor, which are settled in the same way by the bytes that all windows of a stretch share. What still meets only
  in part goes on as single windows, of which all but the first are removed.

A beginning that very many documents share is settled within each batch first; a batch then sends on one suffix per
beginning, and different reaches are spread by their own fingerprints. So no part grows with the frequency of a passage.
Sizes of parts follow from the size of the input.

Fingerprints are 64 bits on top of another 64, so equal ones are taken for equal strings. Null texts are empty; null ids
come first; rows with equal id and equal text are one document; rows with equal id and different text are told apart,
and of their strings the one that starts further ahead is the earlier.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from fleet.llm.common import give_back, giving_back, map_rows, take_worker
from fleet.llm.shingles import mix
from fleet.scratch import Scratch

SPAN = 100
DEPTH = 32
WINDOW = SPAN - DEPTH + 1
#: Bytes whose suffixes are found at once, and suffixes of a batch: together they bound a worker's memory.
SEGMENT = 1 << 18
BATCH_SUFFIXES = 300_000
PART_BYTES = 12_000_000
#: Spans and suffixes of documents meet their texts by a broadcast up to this size, by a shuffled join beyond it.
BROADCAST_BYTES = 96_000_000
NO_KEY = -(1 << 63)

SUFFIX = np.dtype([("key", "<u8"), ("reach", "<u8"), ("doc", "<i8"), ("pos", "<u4"), ("text", "<u2"), ("lead", "u1"), ("more", "u1"), ("before", "<u4"), ("after", "<u4")])
SPANS = np.dtype([("doc", "<i8"), ("text", "<u2"), ("start", "<u4"), ("length", "<u4")])
WINDOWS = np.dtype([("key", "<u8"), ("reach", "<u8"), ("doc", "<i8"), ("pos", "<u4"), ("text", "<u2")])
STAND_IN = 0x80  # in ``lead``: speaks for several reaches with this beginning
_FINGERPRINT = np.uint64((1 << 40) - 1)
_POSITION = np.uint64((1 << 22) - 1)

#: A window has its anchor with this many bytes more before or after it.
HALF = (SPAN - DEPTH) // 2
STRETCH = 17
ASKED, KNOWN, REMOVED, SINGLE, FINE, HALVES = range(6)  # kinds of parts
IS_STRETCH = (1 << 32) - 1  # in ``before``

_rng = np.random.default_rng(9)
_BYTES = _rng.integers(0, 1 << 63, (3, 256), dtype=np.uint64)
_BASES = [int(b) | 5 for b in _rng.integers(1 << 60, 1 << 62, 3)]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS = [_powers(b, SEGMENT + 2 * SPAN) for b in _BASES[1:2]]
_INVERSES = [_powers(pow(b, -1, 1 << 64), SEGMENT + 2 * SPAN) for b in _BASES[1:2]]
_SHORT = [(_powers(b, 2 * SPAN), _powers(pow(b, -1, 1 << 64), 2 * SPAN)) for b in _BASES[1:3]]


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a new run of equal values begins."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def suffixes(docs: list[tuple[int, int, int, bytes]]) -> np.ndarray:
    """Anchored suffixes of segments ``(doc, text, offset, bytes)`` that hold SEGMENT bytes together, or one does."""
    data = np.frombuffer(b"".join(d[3] for d in docs), np.uint8)
    sizes = np.array([len(d[3]) for d in docs], np.int64)
    ends = np.cumsum(sizes)
    n = len(data)
    if n < SPAN:
        return np.empty(0, SUFFIX)
    h, length, power = _BYTES[0][data], 1, _BASES[0]
    while length < DEPTH:  # hashes of twice as many bytes from those of as many
        h = h[:-length] * np.uint64(power) + h[length:]
        length, power = length * 2, power * power % (1 << 64)
    h = mix(h)
    least = (h & ~_POSITION) | np.arange(len(h), dtype=np.uint64)
    step = 1
    while step * 2 <= WINDOW:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    least = np.minimum(least[: len(least) - (WINDOW - step)], least[WINDOW - step :])
    # Windows inside a segment; a run of them with one anchor is a suffix with its reach.
    owner = np.repeat(np.arange(len(docs)), sizes)
    inside = np.flatnonzero(np.arange(len(least)) + SPAN <= ends[owner[: len(least)]])
    if not len(inside):
        return np.empty(0, SUFFIX)
    anchor, own = (least[inside] & _POSITION).astype(np.int64), owner[inside]
    first = np.flatnonzero(_starts(anchor, own))
    last = np.append(first[1:], len(inside)) - 1
    begin, stop, anchor, own = inside[first], inside[last] + SPAN, anchor[first], own[first]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTES[1][data] * _POWERS[0][:n], dtype=np.uint64)])
    reach = mix((sums[stop] - sums[begin]) * _INVERSES[0][begin] + ((stop - begin) * 256 + anchor - begin).astype(np.uint64))
    out = np.empty(len(first), SUFFIX)
    opening = (data[anchor].astype(np.uint64) << np.uint64(56)) | (data[anchor + 1].astype(np.uint64) << np.uint64(48)) | (data[anchor + 2].astype(np.uint64) << np.uint64(40))
    out["key"] = opening | (mix(h[anchor]) & _FINGERPRINT)
    out["reach"] = reach
    out["doc"] = np.array([d[0] for d in docs], np.int64)[own]
    out["text"] = np.array([d[1] for d in docs], np.uint16)[own]
    out["pos"] = anchor - (ends - sizes)[own] + np.array([d[2] for d in docs], np.int64)[own]
    out["lead"], out["more"] = anchor - begin, stop - begin - SPAN
    first, last = (ends - sizes)[own], ends[own]
    for name, a, b in (("before", anchor - HALF, anchor + DEPTH), ("after", anchor, anchor + DEPTH + HALF)):
        whole = (a >= first) & (b <= last)
        a, b = np.where(whole, a, 0), np.where(whole, b, 0)
        out[name] = np.where(whole, (mix((sums[b] - sums[a]) * _INVERSES[0][a]) >> np.uint64(33)) + np.uint64(1), 0)
    return out


def spans_of(found: np.ndarray) -> np.ndarray:
    """The reaches of suffixes, or single windows, as spans."""
    out = np.empty(len(found), SPANS)
    out["doc"], out["text"] = found["doc"], found["text"]
    if "lead" in found.dtype.names:
        out["start"], out["length"] = found["pos"] - found["lead"], SPAN + found["more"].astype(np.uint32)
    else:
        out["start"], out["length"] = found["pos"], SPAN
    return out


def settle(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The earliest of those with equal key and reach, sorted by key and reach, and the spans of all later ones."""
    found = found[np.lexsort((found["pos"], found["doc"], found["reach"], found["key"]))]
    new = _starts(found["key"], found["reach"])
    of = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (found["doc"] != found["doc"][of]) | (found["pos"] != found["pos"][of])
    return found[new], spans_of(found[later])


class Family:
    """Levels of suffix arrays with, for every suffix, whether another with an equal beginning was met."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, array: np.ndarray) -> None:
        """Merge-scan a batch's array, sorted by key and with distinct keys, against the levels and take it in."""
        met = np.zeros(len(array), bool)
        for level, seen in self.levels:
            left = np.searchsorted(level["key"], array["key"], "left")
            right = np.searchsorted(level["key"], array["key"], "right")
            hit = right > left
            met |= hit
            change = np.zeros(len(level) + 1, np.int64)
            np.add.at(change, left[hit], 1)
            np.add.at(change, right[hit], -1)
            seen |= np.cumsum(change)[:-1] > 0
        self.levels.append((array, met))
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= 2 * len(self.levels[-1][0]):
            (a, x), (b, y) = self.levels[-2:]
            both, met = np.concatenate([a, b]), np.concatenate([x, y])
            order = np.argsort(both["key"], kind="stable")
            self.levels[-2:] = [(both[order], met[order])]

    def met(self) -> np.ndarray:
        return np.concatenate([level[seen] for level, seen in self.levels]) if self.levels else np.empty(0, SUFFIX)


_PART = pa.schema([("kind", pa.int32()), ("part", pa.int64()), ("data", pa.binary())])
_PART_SQL = "kind int, part long, data binary"


def _deal(kind: int, found: np.ndarray, by: np.ndarray, parts: int) -> Iterator[tuple[int, int, bytes]]:
    """Cut an array into parts by a hash, keeping the order within."""
    if len(found):
        part = (mix(by.astype(np.int64).view(np.uint64) if by.dtype.kind == "i" else by) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        found, part = found[order], part[order]
        cuts = np.flatnonzero(_starts(part))
        for a, b in zip(cuts, np.append(cuts[1:], len(found))):
            yield kind, int(part[a]), found[a:b].tobytes()


def _table(rows: Iterator[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PART)], schema=_PART)


def _batch_parts(found: np.ndarray, parts: int) -> pa.RecordBatch:
    """A batch's suffix array in parts, and what the batch settles by itself."""
    head, removed = settle(found)
    new = _starts(head["key"])
    group = np.cumsum(new) - 1
    several = np.bincount(group, minlength=1)[group] > 1 if len(head) else np.zeros(0, bool)
    asked = head[new].copy()
    asked["lead"][several[new]] |= STAND_IN
    return _table([
        *_deal(ASKED, asked, asked["key"] & _FINGERPRINT, parts), *_deal(KNOWN, head[several], head["reach"][several], parts),
        *_deal(REMOVED, removed, removed["doc"], parts),
    ])


def _halves(head: np.ndarray, parts: int) -> Iterator[tuple[int, int, bytes]]:
    """Suffixes by their beginning with the bytes on one side: those met here go on, one per beginning asks elsewhere."""
    stretches = head[head["before"] == IS_STRETCH]
    yield from _deal(SINGLE, stretches, stretches["doc"], parts)
    head = head[head["before"] != IS_STRETCH]
    for side, name in enumerate(("before", "after")):
        found = head[head[name] > 0]
        found["key"] = mix(found["key"] ^ mix(found[name].astype(np.uint64) * np.uint64(2) + np.uint64(side)))
        found = found[np.argsort(found["key"], kind="stable")]
        if not len(found):
            continue
        new = _starts(found["key"])
        group = np.cumsum(new) - 1
        several = np.bincount(group)[group] > 1
        asked = found[new].copy()
        asked["lead"][several[new]] |= STAND_IN
        yield from _deal(HALVES, asked, asked["key"], parts)
        yield from _deal(SINGLE, found[several], found["doc"][several], parts)


def _settle_part(kind: int, data: list[bytes], parts: int) -> pa.RecordBatch:
    arrays = [np.frombuffer(d, WINDOWS if kind == FINE else SUFFIX) for d in data]
    if kind in (KNOWN, FINE):
        head, removed = settle(np.concatenate(arrays))
        halves = _halves(head, parts) if kind == KNOWN else []
        return _table([*halves, *_deal(REMOVED, removed, removed["doc"], parts)])
    family = Family()
    for array in arrays:
        family.add(array)
    met = family.met()
    if kind == HALVES:
        met = met[met["lead"] < STAND_IN]
        return _table(_deal(SINGLE, met, met["doc"], parts))
    met = met[np.argsort(met["key"], kind="stable")]
    group = np.cumsum(_starts(met["key"])) - 1
    low, high = (np.full(group[-1] + 1 if len(met) else 0, v, np.uint64) for v in (np.iinfo(np.uint64).max, 0))
    np.minimum.at(low, group, met["reach"])
    np.maximum.at(high, group, met["reach"])
    stand_in = met["lead"] >= STAND_IN
    several = (low != high) | (np.bincount(group[stand_in], minlength=len(low)) > 0)
    own = ~stand_in
    mixed, removed_mixed = settle(met[own & several[group]])
    _, removed = settle(met[own & ~several[group]])
    removed = np.concatenate([removed, removed_mixed])
    return _table([*_deal(KNOWN, mixed, mixed["reach"], parts), *_deal(REMOVED, removed, removed["doc"], parts)])


def _text_mark(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) & 0xFFFF


class Removal:
    """One run over ``(doc_id, text)``."""

    def __init__(self, docs: DataFrame):
        self.docs = docs.select(F.coalesce("doc_id", F.lit(NO_KEY)).alias("doc_id"), "text")
        self.scratch = Scratch(docs.sparkSession)
        size = self.docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.parts = max(4, int(size * 2 / (WINDOW + 1) * SUFFIX.itemsize / PART_BYTES))

    def _each_part(self, rows: DataFrame, settled: int) -> DataFrame:
        """Settle the parts of one kind; the others pass."""
        parts = self.parts

        def run(table: pa.Table) -> pa.Table:
            kind, part = table.column("kind")[0].as_py(), table.column("part")[0].as_py()
            if kind != settled:
                return table.select(["kind", "part", "data"])
            settled_part = pa.Table.from_batches([_settle_part(kind, table.column("data").to_pylist(), parts)])
            give_back()
            return settled_part

        return rows.groupBy("kind", "part").applyInArrow(run, _PART_SQL)

    def _batches(self) -> DataFrame:
        parts = self.parts

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            take_worker("suffixes")
            found, total, waiting, held = [], 0, [], 0
            for batch in batches:
                for at in range(0, batch.num_rows, 64):
                    rows = batch.slice(at, 64).to_pydict()
                    for doc, text in zip(rows["doc_id"], rows["text"]):
                        data = (text or "").encode("utf-8", "surrogatepass")
                        mark = _text_mark(data)
                        for offset in range(0, max(1, len(data) - SPAN + 1), SEGMENT):
                            piece = data[offset : offset + SEGMENT + SPAN - 1]
                            if waiting and held + len(piece) > SEGMENT:
                                found.append(suffixes(waiting))
                                total, waiting, held = total + len(found[-1]), [], 0
                            waiting.append((doc, mark, offset, piece))
                            held += len(piece)
                    if total >= BATCH_SUFFIXES:
                        yield _batch_parts(np.concatenate(found), parts)
                        found, total = [], 0
            if waiting:
                found.append(suffixes(waiting))
            if found:
                yield _batch_parts(np.concatenate(found), parts)

        return self.docs.mapInArrow(giving_back(build), _PART_SQL)

    def _with_text(self, rows: DataFrame, how: str) -> DataFrame:
        """Texts with a document's ``data``."""
        size = rows.agg(F.sum(F.octet_length("data") + 24)).first()[0] or 0
        small = F.broadcast(rows) if size <= BROADCAST_BYTES else rows
        return self.docs.join(small, "doc_id", how)

    def _refined(self, single: DataFrame, refine, parts_of) -> DataFrame:
        """Parts of what ``refine(text, suffixes)`` makes of the suffixes of each document."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found, total = [], 0
            for batch in batches:
                for at in range(0, batch.num_rows, 64):
                    for row in batch.slice(at, 64).to_pylist():
                        data = (row["text"] or "").encode("utf-8", "surrogatepass")
                        suffix = np.frombuffer(row["data"], SUFFIX)
                        suffix = suffix[suffix["text"] == _text_mark(data)]
                        for k in range(0, len(suffix), 4096):
                            found.append(refine(data, suffix[k : k + 4096]))
                            total += len(found[-1])
                    if total >= BATCH_SUFFIXES:
                        yield parts_of(np.concatenate(found))
                        found, total = [], 0
            if found:
                yield parts_of(np.concatenate(found))

        return self._with_text(single, "inner").mapInArrow(giving_back(run), _PART_SQL)

    def _stretches(self, single: DataFrame) -> DataFrame:
        parts = self.parts
        return self._refined(single, stretches, lambda found: _batch_parts(found, parts))

    def _windows(self, single: DataFrame) -> DataFrame:
        parts = self.parts

        def settled(found: np.ndarray) -> pa.RecordBatch:
            head, removed = settle(found)
            return _table([*_deal(FINE, head, head["reach"], parts), *_deal(REMOVED, removed, removed["doc"], parts)])

        return self._refined(single, window_hashes, settled)

    def _by_document(self, rows: DataFrame, kind: int) -> DataFrame:
        """``doc_id, data``: the suffixes or merged spans of each document, from parts dealt by document."""

        def gather(table: pa.Table) -> pa.Table:
            dtype = SUFFIX if kind == SINGLE else SPANS
            found = np.concatenate([np.frombuffer(d, dtype) for d in table.column("data").to_pylist()])
            if kind == REMOVED:
                found = merge_spans(found)
            else:
                # Those met on both sides come once; a cut between segments leaves two parts of a reach, with leads of their own.
                found = found[np.lexsort((found["lead"], found["pos"], found["text"], found["doc"]))]
                found = found[_starts(found["doc"], found["text"], found["pos"], found["lead"])]
            cuts = np.flatnonzero(_starts(found["doc"]))
            data = [found[a:b].tobytes() for a, b in zip(cuts, np.append(cuts[1:], len(found)))]
            return pa.table({"doc_id": pa.array(found["doc"][cuts], pa.int64()), "data": pa.array(data, pa.binary())})

        return rows.where(F.col("kind") == kind).groupBy("part").applyInArrow(gather, "doc_id long, data binary")

    def spans(self) -> DataFrame:
        """``doc_id, data``: merged spans to remove (``SPANS``) of every document that has any."""
        store = self.scratch.store
        settled = store(self._each_part(self._batches(), ASKED), "settled")
        known = store(self._each_part(settled.where(F.col("kind") == KNOWN), KNOWN), "known")
        halves = store(self._each_part(known.where(F.col("kind") == HALVES), HALVES), "halves")
        single = store(self._by_document(known.unionByName(halves), SINGLE), "single")
        near = store(self._each_part(self._stretches(single), ASKED), "stretches")
        nearer = store(self._each_part(near.where(F.col("kind") == KNOWN), KNOWN), "stretches-known")
        last = store(self._by_document(nearer, SINGLE), "stretches-single")
        fine = store(self._each_part(self._windows(last), FINE), "fine")
        removed = settled.unionByName(known).unionByName(near).unionByName(nearer).unionByName(fine).where(F.col("kind") == REMOVED)
        return store(self._by_document(removed, REMOVED), "spans")


def _sums(data: bytes, suffix: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """First bytes of reaches, and for two fingerprints the running sums over each reach with the inverse powers."""
    width = 2 * SPAN - DEPTH + 1
    padded = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(width, np.uint8)])
    begin = suffix["pos"].astype(np.int64) - suffix["lead"]
    cells, out = padded[begin[:, None] + np.arange(width)], []
    for table, (powers, inverses) in zip(_BYTES[1:], _SHORT):
        sums = np.zeros((len(suffix), width + 1), np.uint64)
        np.cumsum(table[cells] * powers[:width], axis=1, dtype=np.uint64, out=sums[:, 1:])
        out.append((sums, inverses))
    return begin, out


def stretches(data: bytes, suffix: np.ndarray) -> np.ndarray:
    """Runs of windows of reaches in one text whose distances to the anchor lie in the same block of ``STRETCH``.

    The key is of the bytes that every window of such a block has, whatever part of the block a reach has.
    """
    begin, ((keys, key_powers), (reaches, reach_powers)) = _sums(data, suffix)
    lead, more, rows, out = suffix["lead"].astype(np.int64), suffix["more"].astype(np.int64), np.arange(len(suffix)), []
    for block in range(-(-WINDOW // STRETCH)):
        far, near = np.minimum(lead, STRETCH * (block + 1) - 1), np.maximum(lead - more, STRETCH * block)
        at = rows[far >= near]
        far, near, core = far[at], near[at], lead[at] - STRETCH * block
        first, stop = lead[at] - far, lead[at] - near + SPAN
        part = np.zeros(len(at), SUFFIX)
        part["key"] = mix((keys[at, core + SPAN - STRETCH + 1] - keys[at, core]) * key_powers[core] + np.uint64(block))
        part["reach"] = mix((reaches[at, stop] - reaches[at, first]) * reach_powers[first] + ((stop - first) * 256 + far).astype(np.uint64))
        part["doc"], part["text"], part["pos"] = suffix["doc"][at], suffix["text"][at], begin[at] + first
        part["more"], part["before"] = far - near, IS_STRETCH
        out.append(part)
    return np.concatenate(out)


def window_hashes(data: bytes, suffix: np.ndarray) -> np.ndarray:
    """Every window of the reaches of suffixes in one text."""
    begin, sums = _sums(data, suffix)
    keys = [mix((total[:, SPAN : SPAN + WINDOW] - total[:, :WINDOW]) * inverses[:WINDOW]) for total, inverses in sums]
    row, step = np.nonzero(np.arange(WINDOW) <= suffix["more"][:, None])
    out = np.empty(len(row), WINDOWS)
    out["key"], out["reach"] = keys[0][row, step], keys[1][row, step]
    out["doc"], out["text"], out["pos"] = suffix["doc"][row], suffix["text"][row], begin[row] + step
    return out


def merge_spans(found: np.ndarray) -> np.ndarray:
    """Maximal runs of covered bytes, by document and text."""
    found = found[np.lexsort((found["start"], found["text"], found["doc"]))]
    if not len(found):
        return found
    new = _starts(found["doc"], found["text"])
    group = np.cumsum(new) - 1
    # Ends grow within a document only, so each document gets a range of its own.
    ends = found["start"].astype(np.int64) + found["length"]
    reach = np.maximum.accumulate(ends + group * (1 << 33)) - group * (1 << 33)
    new[1:] |= found["start"][1:] > reach[:-1]
    cuts = np.flatnonzero(new)
    out = found[cuts].copy()
    out["length"] = reach[np.append(cuts[1:], len(found)) - 1] - out["start"]
    return out


def cut(text: str | None, data: bytes | None) -> tuple[bytes, bytes, int]:
    """A text's bytes, what stays of them, and the number of spans removed."""
    whole = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return whole, whole, 0
    spans = np.frombuffer(data, SPANS)
    spans = spans[spans["text"] == _text_mark(whole)]
    kept, at = [], 0
    for start, length in zip(spans["start"].tolist(), spans["length"].tolist()):
        kept.append(whole[at:start])
        at = start + length
    return whole, b"".join([*kept, whole[at:]]), len(spans)


def removal_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs (doc_id, text)``."""
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    schema = pa.schema([*((n, pa.int64()) for n in names[:-1]), ("kept_sha256", pa.string())])

    def report(rows: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {n: [] for n in names}
        for doc_id, text, data in zip(rows["doc_id"], rows["text"], rows["data"]):
            whole, kept, n = cut(text, data)
            values = (None if doc_id == NO_KEY else doc_id, len(whole), len(whole) - len(kept), n, hashlib.sha256(kept).hexdigest())
            for name, value in zip(names, values):
                out[name].append(value)
        return out

    run = Removal(docs)
    joined = run._with_text(run.spans(), "left").select("doc_id", "text", "data")
    return map_rows(joined, report, schema, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with its texts less the repeated bytes; ``doc_id`` and ``text`` are required, other columns stay.

    Where a span begins or ends within a character, what is left of the character goes too. A null text stays null.
    """
    run = Removal(docs)
    marked = run.spans().withColumnsRenamed({"doc_id": "_fl_doc", "data": "_fl_spans"})
    size = marked.agg(F.sum(F.octet_length("_fl_spans") + 24)).first()[0] or 0
    small = F.broadcast(marked) if size <= BROADCAST_BYTES else marked
    joined = docs.join(small, F.coalesce(docs["doc_id"], F.lit(NO_KEY)) == small["_fl_doc"], "left").drop("_fl_doc")

    @F.pandas_udf("string")
    def keep(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else cut(t, s)[1].decode("utf-8", "ignore") for t, s in zip(texts, spans)], dtype=object)

    # As a fixed result it is computed once, not again in every filter on it, which would take a worker each.
    text = F.when(F.col("_fl_spans").isNull(), F.col("text")).otherwise(keep.asNondeterministic()("text", "_fl_spans"))
    return joined.withColumn("text", text).select(*docs.columns)
