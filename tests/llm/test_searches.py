"""Prefix tree, spelling variants and top products against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleet.llm import prefix_trie, queries, spelling, topk
from made_texts import sentence

# Prefix tree


def brute_nodes(rows):
    """Rows of the contract, from all prefixes of all rebuilt conversations."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        role, text = role or "", text or ""
        key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, key, (role, text)))
    own = {c: [t[3] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 6, c - int(np.fmod(c, 100))
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = defaultdict(set)
    for path in members:
        if path:
            kids[path[:-1]].add(path)
    out = []
    for path, ids in members.items():
        under = [p for p in members if p[: len(path)] == path]
        ends = sorted(c for c in ids if built[c] == path)
        out.append((
            min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids), len(kids[path]), sum(not kids[p] for p in under),
            sum((len(members[p]) - 1) * len(p[-1][1]) for p in under if p), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return Counter(out)


def run_nodes(spark, rows, tmp_path):
    df = spark.createDataFrame([(*r, "x", 1, b"y") for r in rows], "conv_id long, turn long, role string, text string, digest string, depth int, part binary")
    df.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    return Counter(map(tuple, queries.QUERIES["op11_zfast_prefix_trie"](spark, str(tmp_path)).collect()))


AWKWARD_TURNS = [
    (0, 0, "user", "a"), (0, 1, None, "b"), (0, 2, "user", None), (1, None, "user", "first"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, None, "b"),
    (2, 5, "user", ""), (None, 0, "user", "a"), (100, 0, None, None), (101, 0, "user", "é漢"), (102, 0, "x", "z"), (103, 3, "user", sentence(1, 5000)),
    (250, 0, "user", "a"), (251, 0, "user", "a"), (251, 1, "user", "a"), (-5, 0, "user", "a"), (-105, 0, "user", "a"),
] + [(7, i, "user", f"turn {i % 3}") for i in range(600)] + [(c, i, "user", "hot" if i < 3 else f"{c} {i}") for c in range(300, 420) for i in range(c % 9)]


@pytest.mark.parametrize("part", [200_000, 40])
def test_nodes_of_awkward_turns(spark, tmp_path, monkeypatch, part):
    # With 40 turns a part, beginnings that many sequences share cross many borders.
    monkeypatch.setattr(prefix_trie, "TURNS_PER_PART", part)
    monkeypatch.setattr(prefix_trie, "IDS_PER_CHUNK", 3)
    rows = [r for r in AWKWARD_TURNS if r[0] != 7] + [r for r in AWKWARD_TURNS if r[0] == 7][:40]
    assert run_nodes(spark, rows, tmp_path) == brute_nodes(rows)


def test_nodes_of_equal_and_turnless_conversations(spark, tmp_path):
    copies = [(c, i, "user", f"same {i}") for c in range(1000, 1400) for i in range(3)]
    assert run_nodes(spark, copies, tmp_path) == brute_nodes(copies)


def test_nodes_of_nothing(spark, tmp_path):
    assert run_nodes(spark, [], tmp_path) == Counter()


def test_fat_search_finds_what_a_walk_finds():
    rng = random.Random(4)
    trie, paths = prefix_trie.ZFastTrie(), []
    for _ in range(40):
        batch = []
        for _ in range(25):
            turns = [bytes([rng.choice(b"ab")]) for _ in range(rng.randrange(0, 40))]
            batch.append((prefix_trie.path_of(turns), [0] + [1] * len(turns), 1, len(paths) + len(batch)))
        trie.add(batch)
        paths += [b[0] for b in batch]
    for path in paths:
        node = 0
        while trie.extent[node] < len(path) - 1:  # walk edge by edge
            child = trie.below[node].get(path[trie.extent[node] + 1])
            if child is None or not trie._holds(child, path):
                break
            node = child
        assert trie.locate(path) == node and trie.extent[node] == len(path) - 1
    for node in range(1, len(trie.extent)):
        assert trie.handles[trie.path[node][prefix_trie.two_fattest(trie.extent[trie.above[node]], trie.extent[node])]] == node
    found = {row[0]: (row[4], row[5]) for row in trie.expanded()}
    want = Counter(p for path in paths for p in path)
    assert {k: v[0] for k, v in found.items()} == want
    assert sum(v[1] for v in found.values()) == len(want) - 1


def test_node_turns(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "bb"), (2, 0, "user", "a")]
    turns = prefix_trie.turn_table(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = prefix_trie.node_turns(prefix_trie.trie_nodes(turns), turns).select("conv_id", "depth", "turn_chars").collect()
    assert sorted(map(tuple, got)) == [(1, 1, 1), (1, 2, 2)]


# Spelling variants


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            word = run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]
            n[word] += len(word) >= 7
    return {w: c for w, c in n.items() if c >= 2}


def brute_groups(n):
    out, form = [], {}
    for w in n:
        around = [x for x in n if abs(len(x) - len(w)) <= 1 and near(x, w)]
        best = min(around, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
        out.append((w, len(around)))
    def root(w):
        return w if form[w] is None else root(form[w])
    return Counter((w, form[w], root(w), n[w], k, n[form[w]] if form[w] else None) for w, k in out)


def run_groups(df, as_folder, spark):
    return Counter(map(tuple, queries.QUERIES["op12_kd_spelling_variants"](spark, as_folder(df)).collect()))


def test_words_of_awkward_texts(spark, awkward, as_folder):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert run_groups(awkward, as_folder, spark) == brute_groups(brute_words(rows))


def test_words_of_an_empty_table(spark, empty, as_folder):
    assert run_groups(empty, as_folder, spark) == Counter()


@pytest.fixture(scope="module")
def variants():
    """Chains of forms, anagrams, letters beyond ASCII, and words of a thousand letters."""
    rng = random.Random(8)
    n = Counter()
    for seed in range(60):
        word = "".join(rng.choice("abcdeé×ÿ") for _ in range(rng.randrange(7, 13)))
        n[word] += 5000
        for _ in range(12):
            at, letter = rng.randrange(len(word)), rng.choice("abcdeé×ÿ")
            n[word[:at] + letter + word[at + rng.randrange(2) :]] += rng.choice([2, 40, 300])
            n[word[:at] + word[at + 1 :]] += 3
    for _ in range(150):  # one vector, many words
        n["".join(rng.sample("aabbccdd", 8))] += rng.choice([2, 25])
    for end in ("", "a", "b", "ab"):
        n["x" * 1000 + end] += 2
        n["y" + "x" * 999 + end] += 50
    return {w: c for w, c in n.items() if len(w) >= 7}


@pytest.mark.parametrize("leaf, block", [(20_000, 40_000), (40, 15)])
def test_groups(spark, variants, monkeypatch, leaf, block):
    for name, value in (("LEAF", leaf), ("BLOCK", block), ("QUERIES", block), ("FEW", 6), ("LONG_BLOCK", 2)):
        monkeypatch.setattr(spelling, name, value)
    df = spark.createDataFrame(list(variants.items()), "word string, n long").repartition(4)
    got = Counter(map(tuple, spelling.variant_groups(df).collect()))
    assert got == brute_groups(variants)
    assert max(Counter(r[2] for r in got).values()) > 5


# Top products


def brute_top(rows, every, k):
    whole = [(i, v, [int(np.floor(256 * x)) for x in e]) for i, (v, e) in enumerate(rows) if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    out = []
    for i, q, a in whole:
        if q is not None and q % every == 0:
            scores = sorted(((-sum(x * y for x, y in zip(a, b)), v is None, v or 0, v) for j, v, b in whole if j != i), key=lambda s: s[:3])
            out += [(q, r + 1, v, -s) for r, (s, _, _, v) in enumerate(scores[:k])]
    return Counter(out)


def vectors(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dim))
    x = centres[rng.integers(0, 8, n)] + 0.05 * rng.normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1)[:, None] * np.exp(rng.normal(size=(n, 1)) * 0.7)


def run_top(spark, rows, every=50, k=5, parts=4):
    kind = "vec_id long, embedding array<double>, length int, _row string, bucket int"
    df = spark.createDataFrame([(v, e, 1, "x", 7) for v, e in rows], kind).repartition(parts)
    return Counter(map(tuple, topk.top_products(df, F.col("vec_id") % every == 0, k).collect()))


@pytest.mark.parametrize("bucket, queries_at_once", [(8_192, 20_000), (64, 7)])
def test_top_products(spark, monkeypatch, bucket, queries_at_once):
    monkeypatch.setattr(topk, "BUCKET", bucket)
    monkeypatch.setattr(topk, "QUERY_ROWS", queries_at_once)
    rows = [(i, x.tolist()) for i, x in enumerate(vectors(900, 24, 1))]
    rows += [(1000 + i, rows[50][1]) for i in range(200)]  # one vector very often, found by many queries
    assert run_top(spark, rows, 10) == brute_top(rows, 10, 5)


def test_top_products_of_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, None), (50, [1.0, None]), (100, [nan, 1.0]), (150, [inf, 0.0]), (200, []), (250, [1.0]), (300, [1.0, 2.0]), (300, [1.0, 2.0]),
            (None, [1.0, 2.0]), (1, [-1.0, -2.0]), (2, [0.0, 0.0]), (350, [0.0, 0.0]), (400, [-0.001, 3.5])]
    assert run_top(spark, rows) == brute_top(rows, 50, 5)
    assert run_top(spark, []) == Counter()
    assert run_top(spark, [(50, [1.0, 2.0])]) == Counter()


def test_both_prunings_are_used(monkeypatch):
    used = Counter()
    for name in ("by_coordinates", "by_length"):
        def counted(self, *args, fn=getattr(topk.Bucket, name), name=name):
            found = fn(self, *args)
            used[name] += found is not None and (not isinstance(found, int) or found < len(self.ids))
            return found
        monkeypatch.setattr(topk.Bucket, name, counted)
    for stretch in (0, 1):  # vectors of equal length, then of very different ones
        x = vectors(600, 24, 2)
        x = np.floor(4096 * x / np.linalg.norm(x, axis=1)[:, None] * np.exp(stretch * np.random.default_rng(3).normal(size=(600, 1))))
        bucket = topk.Bucket(x, np.arange(600), np.arange(600))
        scores = x @ x.T
        np.fill_diagonal(scores, -np.inf)
        floors = np.sort(scores, axis=1)[:, -5]
        for i, where, found in bucket.search(x, np.arange(600), floors, 5):
            assert sorted(found.tolist()) == np.sort(scores[i])[-5:].tolist()
    assert used["by_coordinates"] > 50 and used["by_length"] > 50


def test_products_beyond_doubles_are_exact():
    a = np.array([[float(topk._LIMIT)] * 9, [3.0] * 9])
    assert topk.products(a, a)[0, 0] == 9 * topk._LIMIT**2
