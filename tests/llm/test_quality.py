"""The language model against the textbook formulas, and the base counts against plain loops."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from fleet.llm import quality, queries

N = quality.ORDER


def textbook(texts):
    """Probability of the last character of an n-gram by interpolated modified Kneser-Ney."""
    counts = [Counter() for _ in range(N + 1)]
    for text in texts:
        padded = quality.START * (N - 1) + text
        counts[N].update(padded[i : i + N] for i in range(len(padded) - N + 1) if text)
    for n in range(N - 1, 0, -1):
        for gram in counts[n + 1]:
            counts[n][gram[1:]] += 1
    discount = [None]
    for n in range(1, N + 1):
        n1, n2, n3, n4 = (max(1, sum(v == k for v in counts[n].values())) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        discount.append([0] + [min(max(d, 0), k) for k, d in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3))])
    after = [defaultdict(list) for _ in range(N + 1)]
    for n in range(1, N + 1):
        for gram, v in counts[n].items():
            after[n][gram[:-1]].append(v)

    def p(gram):
        n = len(gram)
        if not n:
            return 1 / (len(counts[1]) + 1)
        values = after[n].get(gram[:-1])
        if not values:
            return p(gram[1:])
        d = discount[n]
        c = counts[n][gram]
        weight = sum(d[min(v, 3)] for v in values) / sum(values)
        return max(c - d[min(c, 3)], 0) / sum(values) + weight * p(gram[1:])

    return p


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, seen, again = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(covered)


def check(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang").collect()
    rows = queries.QUERIES["op4_kneser_ney_quality"](spark, folder).collect()
    by_lang = defaultdict(list)
    for d in docs:
        by_lang[d.lang or ""].append(d.text or "")
    models = {lang: textbook(texts) for lang, texts in by_lang.items()}
    want = []
    for d in docs:
        counts = base(d.text)
        surprise = None
        if d.text:
            padded = quality.START * (N - 1) + d.text
            surprise = -sum(math.log(models[d.lang or ""](padded[i : i + N])) for i in range(len(d.text))) / len(d.text)
        want.append((d.doc_id, d.lang or "", counts, counts[0] < 10 or 100 * counts[4] > 20 * counts[0], surprise, len(d.text or "")))
    key = lambda x: (x[0], x[1])
    got = sorted(((r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words), r.base_failed, r.surprise, r.kept) for r in rows), key=key)
    want = sorted(want, key=lambda x: (x[0], x[2]))
    assert len(got) == len(want)
    bins = lambda values: sorted(round(v * 1000) for v in values)
    middle = lambda values: bins(values)[(len(values) - 1) // 2] / 1000
    bands = {}
    for lang in by_lang:
        used = [(w[4], w[5]) for w in want if w[1] == lang and not w[3] and w[4] is not None]
        if used:
            m = middle([s for s, _ in used])
            bands[lang] = m, middle([abs(s - m) for s, _ in used]), middle([abs(s - m) * math.sqrt(n) for s, n in used])
    for g, w in zip(got, want):
        assert g[:3] == (w[0], w[2], w[3])
        assert (g[3] is None) == (w[4] is None) and (w[4] is None or abs(g[3] - w[4]) < 1e-4)
        if w[3] or w[1] not in bands or w[4] is None:
            assert not g[4]
        else:
            m, deviation, scaled = bands[w[1]]
            z = abs(w[4] - m) / max(quality.LEAST_DEVIATION, deviation, scaled / math.sqrt(w[5]))
            assert abs(z - quality.WIDTH) < 0.3 or g[4] == (z <= quality.WIDTH)


def test_given_table(spark, folder):
    check(spark, folder)


def test_awkward_rows_and_small_shards(spark, awkward, as_folder, monkeypatch):
    monkeypatch.setattr(quality, "SHARD_ENTRIES", 300)
    check(spark, as_folder(awkward))


def test_empty_table(spark, empty, as_folder):
    assert queries.QUERIES["op4_kneser_ney_quality"](spark, as_folder(empty)).collect() == []


def test_unseen_grams_back_off(spark):
    texts = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog"] * 2
    df = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    model = quality.Model.store(quality.kneser_ney(quality.count_grams(df)))
    p = textbook(texts)
    for gram in ("the", "zat", "thz", "xyz", "\x02\x02q", "at "):
        got = model.log_probability("en", quality._packed(quality._codes(gram), N))[0]
        assert got == pytest.approx(math.log(p(gram)), abs=1e-4)
    characters = sorted(set("".join(texts)))
    for context in ("th", "zz", "a "):  # with one unseen character, probabilities add up to one
        grams = np.concatenate([quality._packed(quality._codes(context + c), N) for c in [*characters, "~"]])
        assert np.exp(model.log_probability("en", grams)).sum() == pytest.approx(1, abs=0.02)
