"""Language profiles, chunk fingerprints, licence scans, and the pipeline."""

import hashlib
import re
import tempfile
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from compare import compare
from fleet.llm import chunks, langid, licenses, queries
from made_texts import sentence
import test_neardup
import test_suffixes


def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


# --- language ---------------------------------------------------------------------


def plain_bundle(text, seed):
    """The definition: bind rotated letter vectors, bundle over the text."""
    clean = re.sub("(.)", lambda m: m[0] if m[0].isalpha() else " ", text.lower(), flags=re.S)
    clean = " " + re.sub(" +", " ", clean).strip() + " "
    out = np.zeros(langid.DIMENSIONS)
    for i in range(len(clean) - 2):
        a, b, c = (langid._letter_vector(ord(x), seed).astype(float) for x in clean[i : i + 3])
        out += np.roll(a, 2) * np.roll(b, 1) * c
    return out


@pytest.mark.parametrize("text", ["Hello,  World", "été", "a", "x1y 2", "Ein Satz.\nNoch einer!"])
def test_bundles_follow_the_definition(text):
    names, counts, has = langid.gram_counts(["z", text, None, "12"])
    got = langid.GramVectors(3).bundle(counts, names)
    assert has.tolist() == [True, True, False, False]
    assert np.allclose(got[1], plain_bundle(text, 3)) and not got[2:].any()
    names, counts, _ = langid.gram_counts([text])  # the same whatever stands beside it
    assert np.allclose(langid.GramVectors(3).bundle(counts, names)[0], got[1])


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op5_hyperdimensional_language"](spark, folder)
    found = {r.doc_id: r for r in rows.collect()}
    docs = documents(spark, folder).collect()
    assert len(found) == len(docs)
    held = [d for d in docs if zlib.crc32(str(d.doc_id).encode()) % 3 == 1]
    assert all(found[d.doc_id].held_out == (d in held) for d in docs) and held
    assert np.mean([found[d.doc_id].lang_pred == d.lang for d in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in found.values())


def test_language_of_awkward_rows(spark, awkward, empty, as_folder):
    found = {r.doc_id: r for r in queries.QUERIES["op5_hyperdimensional_language"](spark, as_folder(awkward)).collect()}
    for doc_id in (0, 1, 2):
        assert (found[doc_id].lang_pred, found[doc_id].score) == ("und", 0.0)
    assert found[8].lang_pred in ("en", "fr", "de", "es")
    assert queries.QUERIES["op5_hyperdimensional_language"](spark, as_folder(empty)).collect() == []
    unlabelled = spark.createDataFrame([(1, "some text")], "doc_id long, text string").selectExpr("*", "cast(null as string) lang")
    assert langid.train_prototypes(unlabelled, 1) == {}
    assert langid.identify(unlabelled, {}, 1).first().lang_pred == "und"


# --- fingerprints -----------------------------------------------------------------


def plain_chunks(data):
    ends, begin = [], 0
    while begin < len(data):
        h, end = 0, None
        for i in range(max(0, begin - 31), len(data)):
            h = ((h << 1) + int(chunks.GEAR[data[i]])) & 0xFFFFFFFF
            size = i - begin + 1
            if size < chunks.LEAST:
                continue
            mask = int(chunks.RARE) if size < chunks.NORMAL else int(chunks.OFTEN)
            if not h & mask or size == chunks.LARGEST:
                end = i + 1
                break
        begin = end or len(data)
        ends.append(begin)
    return ends


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(max_size=900), max_size=4))
def test_chunks_follow_the_definition(data):
    assert chunks.chunk_ends(data) == [plain_chunks(d) for d in data]


def check_fingerprints(spark, folder):
    rows = queries.QUERIES["op10_chunk_fingerprints"](spark, folder).collect()
    docs = sorted(((d.doc_id, d.text or "") for d in documents(spark, folder).collect()), key=lambda d: (-d[0], d[1]))
    want = Counter()
    for (doc_id, text), (_, following) in zip(docs, docs[1:] + docs[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, other, after = (chunks.fingerprints([t.encode()])[0] for t in (text, edited, following))
        share = lambda b: float(not len(b)) if not len(own) else sum(int(x["length"]) for x in own if x["digest"] in set(b["digest"].tolist())) / sum(int(x["length"]) for x in own)
        want[doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), chunks.as_text(own), chunks.as_text(other), share(other), share(after)] += 1
    assert Counter(tuple(r) for r in rows) == want
    return rows


def test_fingerprints(spark, folder, awkward, empty, as_folder):
    rows = check_fingerprints(spark, folder)
    long = [r for r in rows if r.n_chars > 400]
    assert np.mean([r.near_edited for r in long]) > 0.4 and np.mean([r.near_next for r in long]) < 0.1
    check_fingerprints(spark, as_folder(awkward))
    assert check_fingerprints(spark, as_folder(empty)) == []
    one = as_folder(spark.createDataFrame([(7, sentence(1, 50))], "doc_id long, text string").selectExpr("*", "'en' lang", "'a' source"))
    assert check_fingerprints(spark, one)[0].near_next == 1.0


def test_insertions_keep_chunks():
    text = sentence(5, 2000).encode()
    a, b = chunks.fingerprints([text, text[:5000] + b"inserted words here " + text[5000:]])
    assert chunks.likeness(a, b) > 0.95
    assert (chunks.from_text(chunks.as_text(a)) == a).all()


# --- licences ---------------------------------------------------------------------


def test_licences_of_awkward_rows(spark, awkward, empty, as_folder):
    for df in (awkward.dropDuplicates(["doc_id"]), empty):  # the SQL form tells rows apart by their id
        folder = as_folder(df)
        assert compare(spark, folder, queries.QUERIES["op7_license_scan"], queries.SQL["op7_license_scan"]).replace("no rows", "") == ""


def test_licence_inheritance(spark):
    rows = [
        (1, "a/LICENSE", "Licensed under the Apache License, Version 2.0"), (2, "a/b/c.txt", "plain words of a file"), (3, "a/b/COPYING", "All rights reserved."),
        (4, "a/b/d/e.txt", "more plain words"), (5, "x.txt", "nothing here"), (6, "a/f.txt", "text\nReleased under the MIT License.\nmore\nwords and words and words"), (7, None, None),
    ]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert [found[i].effective for i in range(1, 8)] == ["Apache-2.0", "all-rights-reserved", "all-rights-reserved", "all-rights-reserved", None, "MIT", None]
    assert found[4].inherited_from == "a/b" and not found[6].is_licence_file


MIT = """MIT License

Copyright (c) 2020 Jane Roe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
INSTALLED = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "BSD": "BSD-3-Clause"}


def test_whole_licence_files_license_their_directories(spark, as_folder):
    """Files of a system's licence folder, where there is one, and notices of different versions."""
    texts = {"MIT": MIT, "BSD-2-Clause": "Copyright 2001 Jane Roe\n" + licenses.TEXTS[2][2], "ISC": licenses.TEXTS[1][2]}
    folder = Path("/usr/share/common-licenses")
    texts |= {name: (folder / file).read_text() for file, name in INSTALLED.items() if (folder / file).exists()}
    lines = {
        "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.", "GPL-3.0": "Licensed under the GNU General Public License,\n version 3 of it",
        None: "under the GNU General Public License of some version", "Apache-2.0": "// SPDX-License-Identifier: Apache-2.0", "LGPL-3.0": "# SPDX-License-Identifier: LGPL-3.0-or-later",
    }
    rows = [(2 * i, text, "x", name) for i, (name, text) in enumerate(texts.items())]
    rows += [(2 * i + 1, sentence(i, 80), "x", name) for i, name in enumerate(texts)]
    rows += [(100 + i, f"{sentence(i, 60)}\n{line}\n{sentence(i + 50, 60)}", "y", "lines") for i, line in enumerate(lines.values())]
    rows += [(200, MIT + sentence(70, 900), "z", "lines"), (201, sentence(71, 30), "z", "lines")]
    where = as_folder(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    found = {r.doc_id: r for r in queries.QUERIES["op7_license_scan"](spark, where).collect()}
    for i, name in enumerate(texts):
        assert (found[2 * i].licence, found[2 * i].is_licence_file) == (name, True)
        assert (found[2 * i + 1].licence, found[2 * i + 1].effective, found[2 * i + 1].inherited_from) == (None, name, f"{name}/x")
    assert [found[100 + i].licence for i in range(len(lines))] == list(lines) and not any(found[100 + i].is_licence_file for i in range(len(lines)))
    assert (found[200].licence, found[200].is_licence_file, found[201].effective) == ("MIT", False, None)
    assert compare(spark, where, queries.QUERIES["op7_license_scan"], queries.SQL["op7_license_scan"]) == ""


def test_licences_of_repeated_rows_and_clashing_names(spark):
    rows = [(1, "a/LICENSE", MIT, "x"), (1, "a/LICENSE", MIT, "x"), (None, "a/b.txt", "words", "y")]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string, licence string").selectExpr("*", "1 score", "2 _dir", "3 _lines", "4 effective")
    found = [(r.licence, r.is_licence_file, r.effective) for r in licenses.scan(df).orderBy("path").collect()]
    assert found == [("MIT", True, "MIT")] * 2 + [(None, False, "MIT")]


# --- pipeline ---------------------------------------------------------------------


def stages(spark, df):
    """Outputs of all stages, each written and read again."""
    root, out = tempfile.mkdtemp(), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, df, "").write.parquet(f"{root}/{i}")
        df = spark.read.parquet(f"{root}/{i}")
        out.append(df)
    return out


FOREIGN = [
    "De gemeente heeft vorige week besloten dat de oude brug over de rivier wordt vervangen omdat het onderhoud te duur is geworden. Bewoners van de wijk zijn bezorgd over het verkeer tijdens de bouw, maar de wethouder zegt dat er voldoende omleidingen zullen zijn en dat de werkzaamheden binnen een jaar klaar moeten zijn.",
    "Il consiglio comunale ha deciso la settimana scorsa di sostituire il vecchio ponte sul fiume, e la manutenzione è diventata troppo costosa. Gli abitanti del quartiere sono preoccupati per il traffico durante i lavori, ma il sindaco dice che ci saranno deviazioni sufficienti e che i lavori finiranno entro un anno.",
    "Rada miasta zdecydowała w zeszłym tygodniu o wymianie starego mostu na rzece, ponieważ jego utrzymanie stało się zbyt kosztowne. Mieszkańcy dzielnicy martwią się o ruch podczas budowy, ale burmistrz mówi, że będzie wystarczająco dużo objazdów i że prace powinny zakończyć się w ciągu roku.",
]


def test_language_stage_drops_foreign_and_mislabelled_texts(spark):
    clean = documents(spark, "/root/testdata/sf0.01").select("doc_id", "text", "lang")
    of = {lang: [r.text for r in clean.where(F.col("lang") == lang).orderBy("doc_id").collect() if 600 < len(r.text) < 3000][:3] for lang in ("de", "en", "es", "fr")}
    bad = [(t, lang) for t in FOREIGN for lang in ("en", "de", None)] + [(FOREIGN[2][:80], None), (FOREIGN[2][:40], "en")]
    bad += [(t, wrong) for lang, texts in of.items() for wrong in of if wrong != lang for t in texts]
    rows = [(-1 - i, *b) for i, b in enumerate(bad)] + [(None, t, None) for texts in of.values() for t in texts]
    docs = clean.unionByName(spark.createDataFrame(rows, clean.schema)).repartition(5)
    got = Counter(r.doc_id for r in corpus_pipeline.identify_language(spark, docs, "").collect())
    want = Counter(r.doc_id for r in clean.collect() if any(c.isalpha() for c in r.text or ""))
    assert got == want + Counter({None: sum(map(len, of.values()))})


@pytest.mark.parametrize("kind", ["given", "awkward", "empty"])
def test_pipeline_stage_by_stage(spark, folder, awkward, empty, as_folder, kind):
    source = {"given": folder, "awkward": as_folder(awkward), "empty": as_folder(empty)}[kind]
    docs = documents(spark, source)
    named, near, cut, mixed, packed = stages(spark, docs)
    rows = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    for df in (named, near, cut, mixed):
        assert df.columns == docs.columns
    before = Counter(rows(docs))
    assert Counter(rows(named)) == Counter({k: n for k, n in before.items() if k[1] and any(c.isalpha() for c in k[1])})
    kept = {d for d, _, c in test_neardup.brute(rows(named), 5, 80) if d == c}
    assert Counter(d for d, _ in rows(near)) == Counter(kept)
    lengths = {d: (n - gone) for d, n, gone, _, _ in test_suffixes.brute(rows(near))}
    for r in cut.collect():
        assert 0 <= lengths[r.doc_id] - len(r.text.encode()) <= 6 and r.n_chars == len(r.text)
    assert {r.doc_id for r in cut.collect()} >= {d for d, n in lengths.items() if n > 120}
    taken = Counter(d for d, _ in rows(mixed))
    assert set(taken) <= {d for d, _ in rows(cut)} and all(n <= 2 for n in taken.values())
    pieces = packed.collect()
    total = Counter()
    for p in pieces:
        total[p.doc_id] += p.length
    tokens = {p.doc_id: p.doc_tokens for p in pieces}
    assert total == Counter({d: n * tokens[d] for d, n in taken.items()})
    if kind == "given":
        assert len(kept) > 100 and len(taken) > 100
        got = corpus_pipeline.run(spark, source)
        assert sorted(map(str, got.collect())) == sorted(map(str, pieces))
