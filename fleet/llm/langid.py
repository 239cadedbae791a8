"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram's vector binds its letters' vectors, each rotated by its place,
by multiplication; a text's vector bundles those of its n-grams by addition. A language's prototype is the bundle of
its training texts. A text gets the language whose prototype has the largest cosine with its own vector, and that
cosine, at least 0, as its score.

Letters are lower-cased; every run of other characters is one space, which has a vector too. Letter vectors come from
the seed and the code point, so nothing but the prototypes, one vector per language, is kept as the model. A text that
is null or has no letter gets ``und`` with score 0. Without training rows every text does.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from fleet.llm.common import give_back, giving_back, take_worker

DIMENSIONS = 1024
ORDER = 3
NONE = "und"
_ROWS = 64
_CHARS = 1 << 18
_GRAMS_KEPT = 32_768
_BLOCK = 2_048
_SPACE = 32


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@functools.lru_cache(maxsize=20_000)
def _letter_vector(code: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, code]).integers(0, 2, DIMENSIONS, dtype=np.int8) * np.int8(2) - np.int8(1)


def gram_vector(gram: int, seed: int) -> np.ndarray:
    """Product of the letters' vectors, each rotated once for every letter after it."""
    out = np.ones(DIMENSIONS, np.int8)
    for place in range(ORDER):
        out *= np.roll(_letter_vector((gram >> (21 * place)) & 0x1FFFFF, seed), place)
    return out


class GramVectors:
    """Vectors of n-grams seen lately, as float32 rows."""

    def __init__(self, seed: int):
        self.seed, self.known, self.rows = seed, {}, np.empty((_GRAMS_KEPT, DIMENSIONS), np.int8)

    def _of(self, grams: np.ndarray) -> np.ndarray:
        if len(self.known) + len(grams) > _GRAMS_KEPT:
            self.known.clear()
        at = np.empty(len(grams), np.int64)
        for i, gram in enumerate(grams.tolist()):
            place = self.known.get(gram)
            if place is None:
                place = self.known[gram] = len(self.known)
                self.rows[place] = gram_vector(gram, self.seed)
            at[i] = place
        return self.rows[at].astype(np.float32)

    def bundle(self, counts: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """Sums of the n-grams' vectors, one per row of counts, over blocks of n-grams."""
        out = np.zeros((len(counts), DIMENSIONS))
        for at in range(0, len(grams), _BLOCK):
            part = slice(at, at + _BLOCK)
            out += counts[:, part] @ self._of(grams[part])
        return out


@functools.lru_cache(maxsize=1)
def _kept_vectors(seed: int) -> GramVectors:
    return GramVectors(seed)


def _vectors(seed: int) -> GramVectors:
    take_worker("langid", _kept_vectors.cache_clear)
    return _kept_vectors(seed)


def gram_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of some texts, their counts (texts x n-grams), and whether each text has a letter."""
    # Every text begins with a space and ends with that of the next; an empty one closes the last.
    codes = [np.frombuffer((" " + (t or "").lower()).encode("utf-32-le", "surrogatepass"), np.uint32) for t in [*texts, None]]
    doc = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
    c = np.concatenate(codes).astype(np.int64)
    letter = _letters()[c]
    c[~letter] = _SPACE
    first = np.empty(len(doc), bool)  # of a text
    first[:1], first[1:] = True, doc[1:] != doc[:-1]
    keep = letter | first
    keep[1:] |= letter[:-1] & ~first[1:]
    has = np.bincount(doc[letter], minlength=len(codes)) > 0
    c, doc, first = c[keep], doc[keep], first[keep]
    if len(c) < ORDER:
        return np.empty(0, np.int64), np.zeros((len(texts), 0), np.float32), has[:-1]
    grams = (c[:-2] << 42) | (c[1:-1] << 21) | c[2:]
    inside = (doc[:-2] == doc[1:-1]) & ((doc[2:] == doc[:-2]) | first[2:] & (c[1:-1] != _SPACE)) & has[doc[:-2]]
    names, index = np.unique(grams[inside], return_inverse=True)
    counts = np.bincount(doc[:-2][inside] * len(names) + index, minlength=len(texts) * len(names))
    return names, counts.reshape(len(texts), len(names)).astype(np.float32), has[:-1]


def _slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows with few characters, or one row, since counts are a dense table."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).tolist()
        first, total = 0, 0
        for i, size in enumerate(sizes):
            if i > first and (i - first == _ROWS or total + size > _CHARS):
                yield batch.slice(first, i - first)
                first, total = i, 0
            total += size
        if first < len(sizes):
            yield batch.slice(first)


def train_prototypes(df: DataFrame, seed: int) -> dict[str, np.ndarray]:
    """Prototype of each language from ``(text, lang)``; one vector per language reaches the driver."""
    schema = pa.schema([("lang", pa.string()), ("bundle", pa.list_(pa.float64()))])

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for rows in _slices(batches, "text"):
            names, counts, _ = gram_counts(rows.column("text").to_pylist())
            langs = rows.column("lang").to_pylist()
            present = sorted(set(langs))
            member = np.array([[lang == p for lang in langs] for p in present], np.float32)
            for lang, total in zip(present, _vectors(seed).bundle(member @ counts, names)):
                sums[lang] = sums.get(lang, 0) + total
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], schema.field(1).type)], schema=schema)

    partial = df.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang").mapInArrow(giving_back(bundle), "lang string, bundle array<double>")
    # The sums are whole numbers, so their order does not matter.
    cells = partial.select("lang", F.posexplode("bundle").alias("at", "v")).groupBy("lang", "at").agg(F.sum("v").alias("v"))
    rows = cells.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "v"))).alias("cells")).collect()
    found = {r.lang: np.array([c.v for c in r.cells]) for r in rows}
    return {lang: found[lang] / np.linalg.norm(found[lang]) for lang in sorted(found) if np.any(found[lang])}


def identify(df: DataFrame, prototypes: dict[str, np.ndarray], seed: int, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every row; columns of these names are replaced."""
    df = df.drop("lang_pred", "score")
    langs = [*prototypes, NONE]
    matrix = np.array(list(prototypes.values())).reshape(len(prototypes), DIMENSIONS).T

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _slices(batches, text):
            names, counts, has = gram_counts(rows.column(text).to_pylist())
            vectors = _vectors(seed).bundle(counts, names)
            cosines = vectors @ matrix / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
            cosines = np.column_stack([cosines, np.full(len(cosines), -2.0)])
            best = np.where(has, cosines.argmax(axis=1), len(langs) - 1)
            value = np.where(best == len(langs) - 1, 0.0, np.clip(cosines[np.arange(len(best)), best], 0, 1))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array([langs[b] for b in best], pa.string()), pa.array(value, pa.float64())],
                names=[*rows.schema.names, "lang_pred", "score"],
            )

    kind = ", ".join(f"`{name}` {t}" for name, t in df.dtypes)
    return df.mapInArrow(giving_back(score), f"{kind}, lang_pred string, score double")


#: How far from the usual, in deviations: for a text that is most like its own language, and for one more like another.
FAR, FAR_AND_OTHER = 9.0, 4.0
#: Documents from which the usual of a length class is taken; a class with fewer is widened by its neighbours.
LEAST_DOCS, LEAST_DEVIATION = 20, 0.25
#: A lead of another language's cosine below three deviations of chance says nothing.
LEAD = 3 / DIMENSIONS**0.5
_CLASSES, _STEP = 32, 0.05


def _unlikeness(cosine: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Log of the squared tangent times the number of distinct n-grams, which changes little with a text's length."""
    c = np.clip(cosine, 0.01, 0.9999)
    return np.log(1 / c**2 - 1) + np.log(np.maximum(grams, 1))


def _likeness(texts: list[str | None], langs: list[str | None], prototypes: dict[str, np.ndarray], seed: int):
    """Best language and label as numbers (-1: none), unlikeness to both, lead of the best, length classes, and whether there is a letter."""
    names, counts, has = gram_counts(texts)
    vectors = _vectors(seed).bundle(counts, names)
    matrix = np.array(list(prototypes.values())).reshape(len(prototypes), DIMENSIONS).T
    cosines = vectors @ matrix / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    grams = (counts > 0).sum(axis=1)
    number = {lang: i for i, lang in enumerate(prototypes)}
    best, own = cosines.argmax(axis=1), np.array([number.get(lang, -1) for lang in langs], np.int64)
    rows = np.arange(len(texts))
    unlike = lambda which: _unlikeness(cosines[rows, which], grams)
    classes = np.minimum(np.log2(np.maximum(grams, 1)).astype(np.int64), _CLASSES - 1)
    return best, own, unlike(best), unlike(own), cosines[rows, best] - cosines[rows, own], classes, has


def usual_likeness(df: DataFrame, prototypes: dict[str, np.ndarray], seed: int) -> dict[str, np.ndarray]:
    """Median and deviation of the unlikeness of each language's own documents to it, by class of length.

    Texts are counted in bins, so a few hundred numbers per language reach the driver. A language of fewer than
    ``LEAST_DOCS`` documents has no usual likeness.
    """
    schema = pa.schema([("lang", pa.string()), ("class", pa.int64()), ("bin", pa.int64())])

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _slices(batches, "text"):
            langs = rows.column("lang").to_pylist()
            _, own, _, unlike, _, classes, has = _likeness(rows.column("text").to_pylist(), langs, prototypes, seed)
            at = np.flatnonzero(has & (own >= 0))
            columns = [[langs[i] for i in at], classes[at], np.floor(unlike[at] / _STEP).astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    found = df.select("text", "lang").mapInArrow(giving_back(bins), "lang string, class long, bin long")
    cells: dict[str, list] = {}
    for r in found.groupBy("lang", "class", "bin").agg(F.count(F.lit(1)).alias("n")).collect():
        cells.setdefault(r.lang, []).append((r["class"], (r.bin + 0.5) * _STEP, r.n))
    out = {}
    for lang, rows in cells.items():
        level, value, n = (np.array(c) for c in zip(*rows))
        if n.sum() >= LEAST_DOCS:
            out[lang] = np.array([_centre(level, value, n, c) for c in range(_CLASSES)])
    return out


def _centre(level: np.ndarray, value: np.ndarray, n: np.ndarray, wanted: int) -> tuple[float, float]:
    for width in range(_CLASSES):
        near = abs(level - wanted) <= width
        if n[near].sum() >= LEAST_DOCS:
            break
    median = _weighted_median(value[near], n[near])
    return median, max(LEAST_DEVIATION, 1.4826 * _weighted_median(abs(value[near] - median), n[near]))


def _weighted_median(value: np.ndarray, n: np.ndarray) -> float:
    order = np.argsort(value, kind="stable")
    return float(value[order][np.searchsorted(np.cumsum(n[order]), math.ceil(n.sum() / 2))])


def in_known_language(df: DataFrame, prototypes: dict[str, np.ndarray], usual: dict[str, np.ndarray], seed: int) -> DataFrame:
    """Rows of ``df (text, lang)`` that are as like their language as documents of their length usually are.

    The language is the label, or the most similar one if there is no label. A text that is more like another language
    than its label has the narrower bound. Without a usual likeness of that language a letter is enough.
    """
    names = list(prototypes)
    none = np.full((_CLASSES, 2), np.inf)
    table = np.array([usual.get(lang, none) for lang in names]).reshape(len(names), _CLASSES, 2)

    @F.arrow_udf("boolean")
    def fits(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, labels in batches:
            found = []
            for rows in _slices([pa.RecordBatch.from_arrays([texts, labels], names=["text", "lang"])], "text"):
                langs = rows.column("lang").to_pylist()
                best, own, to_best, to_own, lead, classes, has = _likeness(rows.column("text").to_pylist(), langs, prototypes, seed)
                labelled = own >= 0
                of = np.where(labelled, own, best)
                middle, deviation = table[of, classes].T
                far = np.where(labelled & (lead > LEAD), FAR_AND_OTHER, FAR)
                found.append(has & (np.where(labelled, to_own, to_best) <= middle + far * deviation))
            yield pa.array(np.concatenate(found) if found else [], pa.bool_())
        give_back()

    return df.where(fits("text", "lang"))  # only verdicts come back; the rows stay where they are
