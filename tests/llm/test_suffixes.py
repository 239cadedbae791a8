"""Removal of repeated bytes against a set of all strings seen earlier."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from fleet.llm import queries, suffixes
from made_texts import sentence


def brute(rows):
    """Rows with equal id and text are one document; strings are compared by (id, start)."""
    first = {}
    texts = {(d, (t or "").encode()) for d, t in rows}
    for doc_id, data in texts:
        for at in range(len(data) - 99):
            key, place = data[at : at + 100], (suffixes.NO_KEY if doc_id is None else doc_id, at)
            first[key] = min(first.get(key, place), place)
    out = Counter()
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for at in range(len(data) - 99):
            if first[data[at : at + 100]] < (suffixes.NO_KEY if doc_id is None else doc_id, at):
                gone[at : at + 100] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[doc_id, len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def run(df):
    return Counter(tuple(r) for r in suffixes.removal_report(df).collect())


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_given_table(spark, folder):
    got = Counter(tuple(r) for r in queries.QUERIES["op9_suffix_array_removal"](spark, folder).collect())
    assert got == brute(texts(spark.read.parquet(f"{folder}/documents.parquet")))


def test_awkward_rows(spark, awkward):
    assert run(awkward) == brute(texts(awkward))


def test_empty_table(spark, empty):
    assert run(empty) == Counter()


def test_null_and_repeated_ids(spark):
    a, b = sentence(1, 60), sentence(2, 60)
    rows = [(None, a), (5, a + b), (5, b + " x " + a), (5, b + " x " + a), (7, b), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(df) == brute(rows)


@pytest.mark.parametrize("segment, batch, part", [(1 << 20, 600_000, 12_000_000), (700, 60, 2_000)])
def test_shared_passages(spark, monkeypatch, segment, batch, part):
    """Frequent passages, edited copies, repeats within texts, and texts of several segments."""
    monkeypatch.setattr(suffixes, "SEGMENT", segment)
    monkeypatch.setattr(suffixes, "BATCH_SUFFIXES", batch)
    monkeypatch.setattr(suffixes, "PART_BYTES", part)
    passage, rows = sentence(50, 30), []
    for i in range(60):
        rows.append((i * 3 % 61, f"{sentence(60 + i, 20)} {passage} {sentence(200 + i, 25)}"))
    for i in range(30):
        w = sentence(99, 80).split()
        w[(i * 11) % 80] = f"é{i}"
        rows.append((100 + i, " ".join(w)))
    rows += [(200, "ab" * 900), (201, "abc" * 300 + sentence(7, 30) + "abc" * 300), (202, passage * 12), (203, "z" * 99), (204, "z" * 101)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert run(df) == brute(rows)


def test_passages_beside_cuts(spark, monkeypatch):
    """Passages of one to three windows' length that begin at, end at or lie beside a cut between segments."""
    monkeypatch.setattr(suffixes, "SEGMENT", 700)
    rng, rows = np.random.default_rng(5), []
    noise = lambda n: "".join(chr(c) for c in rng.integers(97, 123, n))
    for i, length in enumerate((100, 101, 117, 134, 150, 168, 170)):
        for before in (True, False):
            long, passages = list(noise(700 * 11)), []
            for k, begin in enumerate((0, 1, -1, 17, -17, 68, -68, -length, 1 - length, -1 - length)):
                passages.append(noise(length))
                long[700 * (k + 1) + begin : 700 * (k + 1) + begin + length] = passages[-1]
            others = " - ".join(passages)
            own = 1000 + 10 * i + before
            rows += [(own, "".join(long)), (own + 500 if before else own - 500, others)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert run(df) == brute(rows)


def test_text_form_keeps_columns_and_whole_characters(spark):
    passage = "ü" + sentence(4, 12).replace("a", "ü") + "ü"
    rows = [(1, "a" + passage, "x", 0), (2, None, "y", 1), (3, "bb" + passage + "ö", "z", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, data string, part int")
    got = {r.doc_id: r for r in suffixes.without_repeats(df).collect()}
    assert got[1].text == "a" + passage and got[2].text is None and got[3].text == "bbö" and got[3].data == "z"


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=6), min_size=1, max_size=6))
def test_family_meets_every_equal_beginning(batches):
    family, count = suffixes.Family(), Counter()
    for keys in batches:
        array = np.zeros(len(set(keys)), suffixes.SUFFIX)
        array["key"] = sorted(set(keys))
        count.update(set(keys))
        family.add(array)
    assert Counter(family.met()["key"].tolist()) == Counter({k: n for k, n in count.items() if n > 1})
    assert len(family.levels) <= 2 + np.log2(1 + sum(count.values()))
