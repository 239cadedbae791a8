"""Sharding, mixing, records and packing against brute force and exact round trips."""

import zlib
from collections import Counter, defaultdict
from fractions import Fraction
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from fleet.llm import mixing, packing, queries, records, sharding
from fleet.llm.bpe import Encoder

PATH = public_tokenizers.path(queries.BPE)


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source").collect()


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 5000), st.integers(0, 9))
def test_permutation_is_a_bijection(n, seed):
    p = sharding.Permutation(n, seed)
    there = p(np.arange(n))
    assert sorted(there.tolist()) == list(range(n))
    assert (p(there, inverse=True) == np.arange(n)).all()


def check_shards(spark, folder):
    rows = queries.QUERIES["op1_feistel_shards"](spark, folder).collect()
    docs = documents(spark, folder)
    want = Counter((d.doc_id, len((d.text or "").encode()) + 8, zlib.crc32((d.text or "").encode())) for d in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < 24
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    counts = [len(slots[k]) for k in range(24)]
    assert not rows or max(counts) - min(counts) <= 1
    place = {i: int(p) for i, p in enumerate(sharding.Permutation(len(rows), queries.SEED)(np.arange(len(rows))))} if rows else {}
    ordered = sorted(rows, key=lambda r: (r.doc_id, r.text_crc32, r["size"]))
    assert sorted((place[i] % 24, place[i] // 24) for i in place) == sorted((r.shard, r.slot) for r in ordered)
    for i, r in enumerate(ordered):
        assert i > 0 and ordered[i - 1].doc_id == r.doc_id or i + 1 < len(rows) and ordered[i + 1].doc_id == r.doc_id or sharding.row_number_at(r.shard, r.slot, 24, len(rows), queries.SEED) == i


def check_mix(spark, folder):
    rows = queries.QUERIES["op2_budget_mix"](spark, folder).collect()
    docs = documents(spark, folder)
    size = lambda t: len(re.findall(mixing.WORD, t or ""))
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((d.doc_id, size(d.text)) for d in docs)
    totals = Counter()
    for d in docs:
        totals[d.source] += size(d.text)
    names = sorted(totals, key=lambda s: (s is None, s or ""))
    target = {s: Fraction(0) for s in names}
    left, open_, weight = Fraction(3, 2) * sum(totals.values()), set(names), {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    while left and open_:  # share, stop the full ones, share the excess again
        w = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / w
        left = sum(max(target[s] - 2 * totals[s], 0) for s in open_)
        for s in list(open_):
            if target[s] >= 2 * totals[s]:
                target[s] = Fraction(2 * totals[s])
                open_.remove(s)
    source = {d.doc_id: d.source for d in docs}
    taken = Counter()
    for r in rows:
        s = source[r.doc_id]
        assert r.source_size == totals[s] and abs(r.target - float(target[s])) <= 1e-9 * max(1, float(target[s]))
        assert r.taken in (0, r["size"], 2 * r["size"])
        taken[s] += r.taken
    return {s: (taken[s], float(target[s])) for s in names}


def check_records(spark, folder, plain):
    rows = queries.QUERIES["op3_framed_records"](spark, folder).collect()
    want, at = Counter(), 0
    for d in sorted(documents(spark, folder), key=lambda d: d.doc_id):
        ids = [*plain(d.text), 2]
        want[d.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        at += len(ids)
    assert Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == want


def check_packing(spark, folder, plain):
    rows = queries.QUERIES["op8_sum_of_squares_packing"](spark, folder).collect()
    docs = documents(spark, folder)
    want = Counter()
    for d in docs:
        ids = np.array([*plain(d.text), 0], "<u4")
        for start in range(0, len(ids), 1024):
            piece = ids[start : start + 1024]
            want[d.doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    windows = defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    return sum(r.length for r in rows) / max(1, 1024 * len(windows))


def test_awkward_rows(spark, awkward, as_folder, plain):
    folder = as_folder(awkward)
    check_shards(spark, folder)
    check_mix(spark, folder)
    check_records(spark, folder, plain)
    check_packing(spark, folder, plain)


def test_empty_table(spark, empty, as_folder, plain):
    folder = as_folder(empty)
    check_shards(spark, folder)
    check_mix(spark, folder)
    check_records(spark, folder, plain)
    check_packing(spark, folder, plain)


def test_given_table(spark, folder, plain):
    check_shards(spark, folder)
    for taken, target in check_mix(spark, folder).values():
        assert target - 0.02 * target - 1 <= taken <= target + 1  # ten documents a source
    check_records(spark, folder, plain)
    check_packing(spark, folder, plain)


def test_shuffled_read_and_damage(spark, awkward, plain):
    where, manifest = records.write_records(awkward, PATH, 2)
    files = manifest.collect()
    got = {}
    for f in files:
        _, index = records.read_index(where, f.file)
        order = np.random.default_rng(1).permutation(len(index)).tolist()
        got |= {key: ids.tolist() for key, ids in records.read_at(where, f.file, order)}
    want = {r.doc_id: [*plain(r.text), 2] for r in awkward.collect()}
    assert got == want
    record = bytearray(records.frame(7, b"abcd"))
    assert records.unframe(bytes(record)) == (7, b"abcd")
    for at in (0, 9, 13, len(record) - 1):
        broken = bytearray(record)
        broken[at] ^= 1
        with pytest.raises((ValueError, Exception)):
            records.unframe(bytes(broken))


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 6), min_size=1, max_size=8), st.floats(0, 1))
def test_knapsack_is_optimal_for_small_gaps(counts, share):
    lengths = np.array(sorted(counts))
    n = np.array([counts[x] for x in lengths.tolist()])
    budget = int(share * int((lengths * n).sum()))
    sums = {0}
    for size, many in counts.items():
        sums = {s + k * size for s in sums for k in range(many + 1)}
    took = mixing._knapsack(lengths, n, budget)
    assert (took <= n).all() and (lengths * took).sum() == max(s for s in sums if s <= budget)
    fitted = mixing.fit_counts(lengths, n, budget, gap=64)
    assert (fitted <= n).all() and (fitted >= 0).all() and (lengths * fitted).sum() <= budget


def test_sum_of_squares_against_plain_search():
    sizes = np.random.default_rng(3).integers(1, 17, 400)
    numbers, offsets = packing.sum_of_squares(sizes, 16)
    levels: dict[int, int] = {}
    for size, number, offset in zip(sizes.tolist(), numbers.tolist(), offsets.tolist()):
        counts = Counter(v for v in levels.values() if v < 16)
        cost = lambda h: sum(v * v for v in (counts + Counter({h + size: 1} if h + size < 16 else {}) - Counter({h: 1} if h else {})).values())
        options = [h for h in {0, *counts} if h + size <= 16]
        assert levels.get(number, 0) == offset and cost(offset) == min(map(cost, options))
        levels[number] = offset + size


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab Zé\n\t'12.,! 漢", max_size=60))
def test_pieces_give_the_ids_of_the_whole_text(text):
    global ENCODER
    ENCODER = globals().get("ENCODER") or Encoder(PATH)
    want = ENCODER.library.encode(text, add_special_tokens=False).ids
    assert ENCODER.ids(ENCODER.encode([text])[0]).tolist() == want


def test_repeated_pieces_are_spread_over_blocks(spark):
    """A third of the rows are one document without an id, so one hash; no block gets them all, and none is lost."""
    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    rows = [(None, 0, 300, 7, 300)] * 400 + [(i, 0, 100 + i % 600, i, 100 + i % 600) for i in range(800)]
    packed = packing.pack(spark.createDataFrame(rows, kind).repartition(4), 1024, block=100).collect()
    assert Counter(tuple(r)[:5] for r in packed) == Counter(rows)
    blocks = Counter(r.sequence_id >> 32 for r in packed if r.doc_id is None)
    assert len(blocks) == 12 and max(blocks.values()) < 100
    windows = defaultdict(list)
    for r in packed:
        windows[r.sequence_id].append((r.offset, r.length))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
