"""Near-duplicate components against all pairs."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from fleet.llm import neardup, queries
from made_texts import sentence


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, width):
    w = words(text)
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, width=4, percent=80):
    """doc_id, set size and component by all pairs that share a shingle."""
    sets = [shingles(t, width) for _, t in rows]
    having = defaultdict(set)
    for i, s in enumerate(sets):
        for x in s:
            having[x].add(i)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        for j, common in Counter(j for x in s for j in having[x] if j > i).items():
            if 100 * common >= percent * (len(s) + len(sets[j]) - common):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)].append(doc_id)
    return Counter((d, len(s), min(least[find(i)])) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def run(spark, folder):
    rows = queries.QUERIES["op6_chosen_path_near_duplicates"](spark, folder).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows)


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_given_table(spark):
    folder = "/root/testdata/sf0.01"
    assert run(spark, folder) == brute(texts(spark.read.parquet(f"{folder}/documents.parquet")))


def test_awkward_rows(spark, awkward, as_folder):
    # Rows without a word are components of their own, also when their id repeats.
    assert run(spark, as_folder(awkward)) == brute(texts(awkward))


def test_empty_table(spark, empty, as_folder):
    assert run(spark, as_folder(empty)) == Counter()


@pytest.fixture(scope="module")
def crowded(spark):
    """Near copies in a chain, a group of near copies, and many texts that share a long passage."""
    rows, base = [], sentence(100, 120).split()
    for i in range(150):  # neighbours are near, the ends are not
        w = list(base)
        for k in range(i):
            w[(k * 7) % len(w)] = f"c{k}"
        rows.append((1000 + i, " ".join(w)))
    for i in range(200):
        w = sentence(200, 150).split()
        w[i % 150] = f"n{i}"
        rows.append((3000 + (i * 37) % 200, " ".join(w)))
    passage = sentence(300, 60)
    rows += [(5000 + i, f"{sentence(400 + i, 40)} {passage} {sentence(800 + i, 30)}") for i in range(150)]
    return rows


@pytest.mark.parametrize("small, depth", [(64, 4), (8, 2), (4, 1)])
def test_crowded_nodes(spark, crowded, monkeypatch, small, depth):
    monkeypatch.setattr(neardup, "SMALL", small)
    monkeypatch.setattr(neardup, "DEPTH", depth)
    monkeypatch.setattr(neardup, "GRID_ROWS", 50)
    df = spark.createDataFrame(crowded, "doc_id long, text string").repartition(4)
    got = neardup.near_duplicates(df, 4, 80).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(crowded)


def test_tokens_estimate_similarity():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 63, 800, dtype=np.uint64)
    b = np.concatenate([a[:600], rng.integers(0, 1 << 63, 200, dtype=np.uint64)])
    same = (neardup.minwise(np.unique(a)) == neardup.minwise(np.unique(b))).mean()
    assert abs(same - 0.6) < 0.15


def test_rows_without_id_link_others(spark):
    first = sentence(20, 100).split()
    middle = first[:20] + sentence(21, 7).split() + first[27:]
    last = middle[:60] + sentence(22, 7).split() + middle[67:]
    alone = sentence(23, 50)
    rows = [(1, " ".join(first)), (None, " ".join(middle)), (2, " ".join(last)), (None, alone), (None, alone + " more"), (3, None), (None, None)]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 80).collect()
    linked = sorted((r.doc_id or 0, r.component_id, r.kept) for r in found if r.n_shingles == 97)
    assert linked == [(0, 1, False), (1, 1, True), (2, 1, False)]
    assert [(r.doc_id, r.component_id) for r in found if r.n_shingles in (47, 48)] == [(None, None)] * 2
    assert sorted((r.doc_id or 0, r.component_id) for r in found if not r.n_shingles and r.doc_id) == [(3, 3)]
