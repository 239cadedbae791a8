"""Rows whose ids are null or repeated, through the stages that choose among documents."""

from collections import Counter

import corpus_pipeline
from fleet.llm import common, langid
from made_texts import sentence

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], KIND).repartition(3)


def rows_of():
    """A third of the rows without an id, a third under one id, and near copies across both."""
    rows = [(i, sentence(i + 1, 60), "a") for i in range(30)]
    rows += [(None, sentence(100 + i, 60), "b") for i in range(30)] + [(5, sentence(200 + i, 60), "a") for i in range(30)]
    rows += [(None, sentence(3, 59) + " changed", "a"), (None, sentence(203, 59) + " changed", "b"), (5, sentence(110, 60), "a")]
    return rows + [(None, sentence(120, 60), "b")] * 3 + [(7, sentence(8, 60), "a")] * 2


def test_ids_become_unique(spark):
    named = common.unique_ids(docs_of(spark, rows_of())).collect()
    assert len({r.doc_id for r in named}) == len(named) == len(rows_of()) and None not in {r.doc_id for r in named}
    assert all(r.doc_id == r[common.GIVEN_ID] for r in named if r[common.GIVEN_ID] in range(8, 30))
    back = common.given_ids(common.unique_ids(docs_of(spark, rows_of())), ["doc_id", "text"]).collect()
    assert Counter(map(tuple, back)) == Counter((i, t) for i, t, _ in rows_of())
    assert common.unique_ids(docs_of(spark, [])).collect() == []
    same = common.unique_ids(docs_of(spark, [(None, "a", "x"), (None, "b", "x")]))
    assert sorted(r.doc_id for r in same.collect()) == [0, 1]


def test_near_copies_without_ids_go(spark):
    rows = rows_of()
    got = Counter(r.text for r in corpus_pipeline.drop_near_duplicates(spark, docs_of(spark, rows), "").collect())
    gone = {sentence(3, 59) + " changed"}  # its near copy has a smaller id
    near = {sentence(203, 60), sentence(203, 59) + " changed"}  # one of two
    assert got == Counter({t for _, t, _ in rows} - gone - near) + Counter(got.keys() & near) and len(got.keys() & near) == 1
    again = Counter(r.text for r in corpus_pipeline.drop_near_duplicates(spark, docs_of(spark, rows[::-1]), "").collect())
    assert again == got


def test_mix_counts_rows_without_ids_one_by_one(spark):
    rows = rows_of()
    mixed = corpus_pipeline.mix_sources(spark, docs_of(spark, rows), "").collect()
    words = Counter()
    for r in mixed:
        words[r.source] += len(r.text.split())
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    total = sum(sizes.values()) * 1.5
    target = {"a": min(total * 0.75, 2 * sizes["a"])}
    target["b"] = min(total - target["a"], 2 * sizes["b"])
    assert all(abs(words[s] - target[s]) <= 60 for s in target)


def test_verdicts_keep_rows_whole(spark):
    rows = [(i, sentence(i, 40), "a") for i in range(40)] + [(50, "", "a"), (51, "12 34", "a")]
    docs = docs_of(spark, rows)
    prototypes = langid.train_prototypes(docs, 1)
    kept = langid.in_known_language(docs, prototypes, langid.usual_likeness(docs, prototypes, 1), 1)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(40))
