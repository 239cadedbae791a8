"""Quality by perplexity under a character n-gram model with modified Kneser-Ney smoothing, one model per language.

The n-grams of all texts are counted: each task adds up its own, Spark adds up the tasks'. Lower orders count distinct
left neighbours. Discounts for counts of one, two, and three or more come from the numbers of n-grams with counts 1 to
4, and every order is interpolated with the next lower. The model, log-probabilities and back-off weights of all orders,
is stored as arrays sorted by 64-bit hashes in files of a shared folder, cut by hash so that a task holds a few of them
at a time, whatever the size of the model.

A text's score is its mean negative log-probability per character. Each language has a band around its median: a text
is rejected below or above ``WIDTH`` times the usual deviation, where the usual deviation is the larger of the median
deviation of texts and the one to expect at the text's length. Texts that fail the base rules do not shape the bands.

A null language is one more language. Null and empty texts have no words and fail the base rules; every row is scored
by itself, so repeated rows get equal results; an empty table gives an empty one.
"""

from __future__ import annotations

import functools
import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from fleet.llm.common import read_file, shared_folder, write_file
from fleet.llm.shingles import mix, windows, word_hashes
from fleet.scratch import Scratch

ORDER = 3
WIDTH = 4.5
LEAST_DEVIATION = 0.005
START = "\x02"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SHARD_ENTRIES = 500_000
SHARDS_HELD = 8
_ROWS, _CHARS = 64, 1 << 20
_HELD_GRAMS = 400_000
_STEP = 1_000.0  # bins of scores per unit when medians are taken

PROBABILITY, BACK_OFF = 1, 2


def _salt(lang: str, kind: int, order: int) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(f"{kind}|{order}|{lang}".encode("utf-8", "surrogatepass")))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _packed(codes: np.ndarray, order: int) -> np.ndarray:
    """Every run of ``order`` code points as one number."""
    n = max(0, len(codes) - order + 1)
    out = np.zeros(n, np.uint64)
    for place in range(order):
        out = (out << np.uint64(21)) | codes[place : n + place]
    return out


def _text_of(gram: int) -> str:
    return "".join(chr((gram >> (21 * k)) & 0x1FFFFF) for k in reversed(range(ORDER)))


def _grams(text: str | None) -> np.ndarray:
    return _packed(_codes(START * (ORDER - 1) + text), ORDER) if text else np.empty(0, np.uint64)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    first, total = 0, 0
    for i, text in enumerate(batch.column("text")):
        size = len(text.as_py() or "")
        if i > first and (i - first == _ROWS or total + size > _CHARS):
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += size
    if first < batch.num_rows:
        yield batch.slice(first)


def count_grams(docs: DataFrame) -> DataFrame:
    """``lang, gram, n`` over all texts of ``(text, lang)``."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[int, int]] = {}

        def out() -> pa.RecordBatch:
            rows = [(lang, _text_of(g), n) for lang, grams in held.items() for g, n in grams.items()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else ((), (), ()), schema)], schema=schema)

        for batch in batches:
            for part in _slices(batch):
                by: dict[str, list[np.ndarray]] = {}
                for text, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist()):
                    by.setdefault(lang or "", []).append(_grams(text))
                for lang, grams in by.items():
                    names, counts = np.unique(np.concatenate(grams), return_counts=True)
                    sums = held.setdefault(lang, {})
                    for g, n in zip(names.tolist(), counts.tolist()):
                        sums[g] = sums.get(g, 0) + n
                if sum(map(len, held.values())) > _HELD_GRAMS:
                    yield out()
        yield out()

    return docs.select("text", "lang").mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame) -> DataFrame:
    """``lang, d1, d2, d3``: discounts of counts of one, two, and three or more."""
    of = [F.greatest(F.sum((F.col("n") == k).cast("double")), F.lit(1.0)).alias(f"n{k}") for k in (1, 2, 3, 4)]
    y = "n1 / (n1 + 2 * n2)"
    clipped = lambda k, d: f"greatest(0.0, least({k}.0, {d})) AS d{k}"
    return counts.groupBy("lang").agg(*of).selectExpr(
        "lang", clipped(1, f"1 - 2 * {y} * n2 / n1"), clipped(2, f"2 - 3 * {y} * n3 / n2"), clipped(3, f"3 - 4 * {y} * n4 / n3"),
    )


def kneser_ney(counts: DataFrame) -> DataFrame:
    """``lang, kind, ord, gram, value``: log-probabilities of all orders and log back-off weights of contexts."""
    scratch = Scratch(counts.sparkSession)
    levels = [scratch.store(counts, f"counts-{ORDER}")]
    for order in range(ORDER - 1, 0, -1):  # how many different characters stand before it
        shorter = levels[0].groupBy("lang", F.expr(f"substring(gram, 2, {order})").alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        levels.insert(0, scratch.store(shorter, f"counts-{order}"))
    uniform = levels[0].groupBy("lang").agg((1.0 / (F.count(F.lit(1)) + 1)).alias("lower"))
    out, below = [], None
    for order, level in enumerate(levels, 1):
        seen = level.join(_discounts(level), "lang").withColumn("context", F.expr(f"substring(gram, 1, {order - 1})"))
        discount = F.expr("CASE n WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END")
        contexts = seen.groupBy("lang", "context").agg(F.sum("n").alias("total"), (F.sum(discount) / F.sum("n")).alias("weight"))
        rows = seen.join(contexts, ["lang", "context"])
        if below is None:
            rows = rows.join(uniform, "lang")
        else:
            shorter = below.select("lang", F.col("gram").alias("_short"), F.col("p").alias("lower"))
            rows = rows.withColumn("_short", F.expr(f"substring(gram, 2, {order - 1})")).join(shorter, ["lang", "_short"])
        p = F.greatest(F.col("n") - discount, F.lit(0.0)) / F.col("total") + F.col("weight") * F.col("lower")
        below = scratch.store(rows.select("lang", "gram", p.alias("p")), f"p-{order}")
        entry = lambda kind, gram, value: (F.col("lang"), F.lit(kind).alias("kind"), F.lit(order).alias("ord"), gram.alias("gram"), F.log(value).alias("value"))
        out += [below.where("p > 0").select(*entry(PROBABILITY, F.col("gram"), F.col("p"))), contexts.where("weight > 0").select(*entry(BACK_OFF, F.col("context"), F.col("weight")))]
    out.append(uniform.select("lang", F.lit(PROBABILITY).alias("kind"), F.lit(0).alias("ord"), F.lit("").alias("gram"), F.log("lower").alias("value")))
    return functools.reduce(DataFrame.unionByName, out)


class Model:
    """The stored arrays, read shard by shard."""

    def __init__(self, folder: str, shards: int):
        self.folder, self.shards = folder, shards

    @staticmethod
    def store(entries: DataFrame) -> Model:
        """Write ``kneser_ney`` entries as sorted hash arrays."""
        spark = entries.sparkSession
        folder = shared_folder(spark, "model")
        entries = Scratch(spark).store(entries, "entries")
        shards = max(1, -(-entries.count() // SHARD_ENTRIES))
        hashed = pa.schema([("shard", pa.int64()), ("hash", pa.int64()), ("value", pa.float64())])

        def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = batch.to_pydict()
                keys = np.array([_entry_hash(*r) for r in zip(rows["lang"], rows["kind"], rows["ord"], rows["gram"])], np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array((keys % np.uint64(shards)).astype(np.int64)), pa.array(keys.view(np.int64)), batch.column("value")], schema=hashed)

        def write(table: pa.Table) -> pa.Table:
            keys = table.column("hash").to_numpy().view(np.uint64)
            order = np.argsort(keys)
            parts = io.BytesIO()
            np.savez(parts, keys=keys[order], values=table.column("value").to_numpy()[order].astype(np.float32))
            shard = table.column("shard")[0].as_py()
            write_file(folder, f"shard-{shard:06d}.npz", [parts.getvalue()])
            return pa.table({"shard": pa.array([shard], pa.int64())})

        written = entries.mapInArrow(hash_rows, "shard long, hash long, value double").groupBy("shard").applyInArrow(write, "shard long")
        Scratch(spark).store(written, "written")
        return Model(folder, shards)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values of hashes; nan where there is none."""
        out = np.full(len(keys), np.nan)
        shard = (keys % np.uint64(self.shards)).astype(np.int64)
        for s in np.unique(shard):
            known, values = _shard(self.folder, int(s))
            mine = np.flatnonzero(shard == s)
            if len(known):
                at = np.minimum(np.searchsorted(known, keys[mine]), len(known) - 1)
                hit = known[at] == keys[mine]
                out[mine[hit]] = values[at[hit]]
        return out

    def log_probability(self, lang: str, grams: np.ndarray) -> np.ndarray:
        """Log-probability of the last character of each packed n-gram given those before it."""
        out, back, left = np.full(len(grams), np.nan), np.zeros(len(grams)), np.arange(len(grams))
        for order in range(ORDER, -1, -1):
            mask = np.uint64((1 << (21 * order)) - 1)
            value = self.get(mix((grams[left] & mask) ^ _salt(lang, PROBABILITY, order)))
            found = ~np.isnan(value)
            out[left[found]] = back[left[found]] + value[found]
            left = left[~found]
            if not len(left) or not order:
                break
            context = self.get(mix(((grams[left] & mask) >> np.uint64(21)) ^ _salt(lang, BACK_OFF, order)))
            back[left] += np.nan_to_num(context)
        return np.where(np.isnan(out), math.log(1e-6), out)  # a language without a model


def _entry_hash(lang: str, kind: int, order: int, gram: str) -> int:
    length = order if kind == PROBABILITY else order - 1
    packed = _packed(_codes(gram), length)[:1] if length else np.zeros(1, np.uint64)
    return int(mix(packed ^ _salt(lang, kind, order))[0])


@functools.lru_cache(maxsize=SHARDS_HELD)
def _shard(folder: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    try:
        data = np.load(io.BytesIO(read_file(folder, f"shard-{number:06d}.npz")))
    except FileNotFoundError:  # no hash fell into it
        return np.empty(0, np.uint64), np.empty(0, np.float32)
    return data["keys"], data["values"]


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, characters in words, symbols, repeated lines, and words in repeated windows of five words."""
    text = text or ""
    words = word_hashes(text, lower=False)
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    runs = windows(words, 5)
    covered = np.zeros(len(words) + 1, np.int64)
    if len(runs):
        _, index, counts = np.unique(runs, return_inverse=True, return_counts=True)
        twice = np.flatnonzero(counts[index] > 1)
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + 5, -1)
    return (
        len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
        int((np.cumsum(covered)[:-1] > 0).sum()),
    )


_SCORED = [("doc_id", pa.int64()), ("lang", pa.string()), *((n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars")), ("surprise", pa.float64())]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Base counts and mean surprise per character of every row of ``(doc_id, text, lang)``."""
    schema = pa.schema(_SCORED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                rows = part.to_pydict()
                langs = [lang or "" for lang in rows["lang"]]
                surprise = np.full(len(langs), np.nan)
                for lang in set(langs):
                    mine = [i for i, x in enumerate(langs) if x == lang and rows["text"][i]]
                    if mine:
                        grams = [_grams(rows["text"][i]) for i in mine]
                        names, index = np.unique(np.concatenate(grams), return_inverse=True)
                        sizes = np.array([len(g) for g in grams])
                        sums = np.add.reduceat(model.log_probability(lang, names)[index], np.concatenate([[0], np.cumsum(sizes)[:-1]]))
                        surprise[mine] = -sums / sizes
                counts = zip(*(base_counts(t) for t in rows["text"]))
                columns = [rows["doc_id"], langs, *counts, [len(t or "") for t in rows["text"]], surprise]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type, from_pandas=True) for c, f in zip(columns, schema)], schema=schema)

    kind = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_chars long, surprise double"
    return docs.select("doc_id", "text", "lang").mapInArrow(run, kind)


def _median(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Median per language, to the nearest bin, from counts per bin."""
    bins = rows.groupBy("lang", F.round(value * _STEP).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    up_to = F.sum("n").over(Window.partitionBy("lang").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    whole = F.sum("n").over(Window.partitionBy("lang"))
    return bins.select("lang", "bin", (2 * up_to >= whole).alias("half")).where("half").groupBy("lang").agg((F.min("bin") / _STEP).alias(name))


def bands(scored: DataFrame) -> DataFrame:
    """``lang, middle, deviation, scaled``: median surprise, its median deviation, and that times the root of the length."""
    usable = scored.where(~F.col("base_failed") & F.col("surprise").isNotNull())
    middle = _median(usable, F.col("surprise"), "middle")
    away = usable.join(middle, "lang").withColumn("away", F.abs(F.col("surprise") - F.col("middle")))
    return middle.join(_median(away, F.col("away"), "deviation"), "lang").join(_median(away, F.col("away") * F.sqrt("n_chars"), "scaled"), "lang")


def judge(docs: DataFrame) -> DataFrame:
    """Base counts, ``base_failed``, ``surprise``, ``perplexity`` and ``kept`` for every row of ``(doc_id, text, lang)``."""
    model = Model.store(kneser_ney(count_grams(docs)))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    scored = Scratch(docs.sparkSession).store(score(docs, model).withColumn("base_failed", failed), "scored")
    judged = scored.join(bands(scored), "lang", "left")
    usual = F.greatest(F.lit(LEAST_DEVIATION), "deviation", F.col("scaled") / F.sqrt("n_chars"))
    inside = F.abs(F.col("surprise") - F.col("middle")) <= WIDTH * usual
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"), "surprise", F.exp("surprise").alias("perplexity"),
    )
