"""Groups of spelling variants: words one edit apart, found by range searches in k-d trees over letter counts.

A word is the vector of its letter counts. Replacing a letter raises one count and lowers another, inserting one raises
one; so near words lie within L1 distance two, and a box whose nearest corner needs more than one count up (or, at equal
length, down) holds none. For each length the words are dealt to the leaves of a k-d tree whose planes come from a bounded
sample of ``SAMPLE`` words; a word searches the tree of its own length and that of the next, and goes as a query to each
leaf that its box test can't rule out. Leaves are met block by block, so a leaf of any size, such as anagrams that no plane
parts, is a grid of tasks. Inside, a tree with tight boxes leads to the few words whose order of letters is compared.
Only counts and the best neighbour of a word leave a task, never lists of pairs.

Texts without a word and null texts give nothing, a null ``doc_id`` counts as an empty one in the draw, words of any length
are whole, an empty table has no words. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from fleet.operators.keys import block_cogroup
from fleet.scratch import Scratch

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
RUN = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT, RATIO, EVERY = 7, 2, 10, 31
#: Words that a leaf of a length's tree should have, words that its planes are drawn from, words compared without planes.
LEAF, SAMPLE, FEW = 20_000, 50_000, 200
#: Longer words meet in smaller blocks.
LONG, BLOCK, QUERIES, LONG_BLOCK = 256, 40_000, 80_000, 100
_CODE = np.full(256, 255, np.uint8)
_CODE[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))
_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def noisy_words(docs: DataFrame) -> DataFrame:
    """``word, n``: runs of letters in lower case, of which a draw by document and run loses one letter, and their counts."""
    low = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    drawn = (
        runs.where(F.length("run") >= LEAST_LENGTH)
        .select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), low.alias("run"))
        .withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run")))
    )
    cut = F.expr(f"CASE WHEN h % {EVERY} = 0 THEN concat(left(run, int(h % length(run))), substring(run, int(h % length(run)) + 2)) ELSE run END")
    counted = drawn.select(cut.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT))


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """Counts of each letter, a row per word of equal length given as Latin-1 bytes."""
    size, length = codes.shape
    cells = _CODE[codes].astype(np.int64) + np.arange(size, dtype=np.int64)[:, None] * len(LETTERS)
    counts = np.bincount(cells.ravel(), minlength=size * len(LETTERS)).reshape(size, len(LETTERS))
    return counts.astype(np.int16 if length < 30_000 else np.int32)


def as_codes(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def reached(counts: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool) -> np.ndarray:
    """Which vectors can reach the box by one count up and, if ``same`` length, one down."""
    up = np.maximum(low - counts, 0).sum(axis=1)
    down = np.maximum(counts - high, 0).sum(axis=1)
    return (up <= 1) & (down <= (1 if same else 0))


def planes(sample: np.ndarray, leaves: int) -> tuple:
    """A tree ``(letter, most, left, right)`` over sample vectors; a leaf is its number."""
    numbers = iter(range(1 << 30))

    def grow(rows: np.ndarray, wanted: int):
        if wanted > 1 and len(rows) > 16:
            letter = int(rows.var(axis=0).argmax())
            at = rows[:, letter]
            values = np.unique(at)[:-1]
            if len(values):
                most = int(min(values, key=lambda v: abs(2 * int((at <= v).sum()) - len(at))))
                under = at <= most
                left = max(1, round(wanted * float(under.mean())))
                return letter, most, grow(rows[under], left), grow(rows[~under], max(1, wanted - left))
        return next(numbers)

    return grow(sample.astype(np.int64), leaves)


def home(tree, counts: np.ndarray) -> np.ndarray:
    """The leaf that each vector lies in."""
    out = np.zeros(len(counts), np.int32)
    todo = [(tree, np.arange(len(counts)))]
    while todo:
        node, rows = todo.pop()
        if not isinstance(node, tuple):
            out[rows] = node
            continue
        under = counts[rows, node[0]] <= node[1]
        todo += [(node[2], rows[under]), (node[3], rows[~under])]
    return out


def visits(tree, counts: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row and leaf of all leaves whose box a near word of the row may lie in."""
    most = np.iinfo(np.int32).max
    todo = [(tree, np.arange(len(counts)), np.zeros(len(LETTERS), np.int64), np.full(len(LETTERS), most, np.int64))]
    rows_of, leaves = [], []
    while todo:
        node, rows, low, high = todo.pop()
        rows = rows[reached(counts[rows], low, high, same)]
        if not len(rows):
            continue
        if not isinstance(node, tuple):
            rows_of.append(rows)
            leaves.append(np.full(len(rows), node, np.int32))
            continue
        letter, cut, left, right = node
        under, over = high.copy(), low.copy()
        under[letter], over[letter] = cut, cut + 1
        todo += [(left, rows, low, under), (right, rows, over, high)]
    none = np.empty(0, np.int32)
    return (np.concatenate(rows_of), np.concatenate(leaves)) if rows_of else (none, none)


def near_pairs(asked: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ``(asked, held)`` row pairs of words, as bytes, one edit apart; held words are as long, or one letter longer."""
    same = asked.shape[1] == held.shape[1]
    q, w = letter_counts(asked), letter_counts(held)
    used = np.flatnonzero(w.any(axis=0) | q.any(axis=0))
    exact = np.float32 if held.shape[1] < 2_000 else np.float64
    q, w = q[:, used].astype(exact), w[:, used].astype(exact)
    # Sums of counts are equal, or one apart: a squared distance of 2, or 1, is one count up and one, or none, down.
    q_size, w_size = (q * q).sum(axis=1), (w * w).sum(axis=1)
    found = []
    todo = [(np.arange(len(q)), np.arange(len(w)))]
    while todo:
        queries, words = todo.pop()
        if not len(queries) or not len(words):
            continue
        low, high = w[words].min(axis=0), w[words].max(axis=0)
        queries = queries[reached(q[queries], low, high, same)]
        spread = high - low
        if len(words) > FEW and spread.any() and len(queries):
            letter = int(w[words].var(axis=0).argmax())
            at = w[words, letter]
            cut = min(int(np.median(at)), high[letter] - 1)
            todo += [(queries, words[at <= cut]), (queries, words[at > cut])]
            continue
        step = max(1, 4_000_000 // max(1, len(words) * held.shape[1] // 8))
        for at in range(0, len(queries), step):
            part = queries[at : at + step]
            apart = q_size[part][:, None] + w_size[words][None, :] - 2 * (q[part] @ w[words].T)
            i, j = np.nonzero(apart == (2 if same else 1))
            if len(i):
                keep = _one_edit(asked[part[i]], held[words[j]])
                found.append((part[i][keep], words[j][keep]))
    none = np.empty(0, np.int64)
    return tuple(np.concatenate(side) for side in zip(*found)) if found else (none, none)


def _one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    if short.shape[1] == long.shape[1]:
        return (short != long).sum(axis=1) == 1
    length = short.shape[1]
    heads = (short != long[:, :length]).argmax(axis=1)  # the first place that differs
    heads = np.where((short == long[:, :length]).all(axis=1), length, heads)
    tails = short == long[:, 1:]
    wrong = np.cumsum(~tails[:, ::-1], axis=1)[:, ::-1]  # differences from each place to the end, one place later
    return np.where(heads == length, 0, np.take_along_axis(wrong, np.minimum(heads, length - 1)[:, None], axis=1)[:, 0]) == 0


def _best(rows: np.ndarray, others: np.ndarray, n: np.ndarray, names: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows with neighbours, how many, and the neighbour of largest count, the first in order of code points among equals."""
    order = np.lexsort((names[others], -n[others], rows))
    rows, others = rows[order], others[order]
    at = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else np.empty(0, np.int64)
    return rows[at], np.bincount(rows, minlength=size)[rows[at]], others[at]


def _search(held: pa.Table, asked: pa.Table) -> pa.Table:
    """Neighbours that the queries of a block have among the words of a leaf, and those words among longer ones' queries."""
    words, counts = held["word"].to_pylist(), held["n"].to_numpy()
    out = {name: [] for name in _FOUND.names}
    if words and asked.num_rows:
        length = len(words[0])
        codes, names = as_codes(words, length), np.argsort(np.argsort(np.array(words)))
        lengths = pc.utf8_length(asked["word"])
        for size in (length, length - 1):
            part = asked.filter(pc.equal(lengths, size))
            queries, n = part["word"].to_pylist(), part["n"].to_numpy()
            if not queries:
                continue
            i, j = near_pairs(as_codes(queries, size), codes)
            sides = [(i, j, counts, words, names, queries)]
            if size < length:
                sides.append((j, i, n, queries, np.argsort(np.argsort(np.array(queries))), words))
            for rows, others, weight, texts, ranks, own in sides:
                for row, near, best in zip(*_best(rows, others, weight, ranks, len(own))):
                    for name, value in zip(_FOUND.names, (own[row], int(near), int(weight[best]), texts[best])):
                        out[name].append(value)
    return pa.table(out, schema=_FOUND)


def neighbours(words: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best``: for words with a near word, how many, and the one of largest ``n``."""
    spark, scratch = words.sparkSession, Scratch(words.sparkSession)
    crowded = words.groupBy(F.length("word").alias("length")).count().where(F.col("count") > LEAF).collect()  # total / LEAF rows at most
    total = sum(r["count"] for r in crowded)
    shares = {r["length"]: min(1.0, SAMPLE / total) for r in crowded}
    sample: dict[int, list[str]] = {}
    if shares:
        keyed = words.withColumn("_length", F.length("word")).sampleBy("_length", shares, 12)
        for (word,) in keyed.select("word").collect():
            sample.setdefault(len(word), []).append(word)
    trees = {r["length"]: planes(letter_counts(as_codes(sample[r["length"]], r["length"])), math.ceil(r["count"] / LEAF)) for r in crowded if sample.get(r["length"])}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.utf8_length(batch["word"]).to_numpy(zero_copy_only=False)
            for length in np.unique(lengths).tolist():
                mine = batch.take(pa.array(np.flatnonzero(lengths == length)))
                for at in range(0, mine.num_rows, max(1, 2_000_000 // length)):
                    part = mine.slice(at, max(1, 2_000_000 // length))
                    counts = letter_counts(as_codes(part["word"].to_pylist(), length))
                    stays = home(trees.get(length, 0), counts)
                    yield _dealt(part, np.arange(len(stays)), length, stays, False)
                    for towards in (length, length + 1):
                        yield _dealt(part, *_swap(visits(trees.get(towards, 0), counts, towards == length), towards), True)

    dealt = scratch.store(words.select("word", "n").mapInArrow(deal, "word string, n long, length int, leaf int, asked boolean"), "dealt")
    found = []
    for some, held_rows, asked_rows in ((f"length <= {LONG}", BLOCK, QUERIES), (f"length > {LONG}", LONG_BLOCK, LONG_BLOCK)):
        again = spark.read.schema(dealt.schema).parquet(f"{scratch.path}/dealt")
        held, asked = dealt.where(some).where("NOT asked").drop("asked"), again.where(some).where("asked").drop("asked")
        if some.startswith("length >") and held.isEmpty():
            continue
        kind = "word string, n_near long, best_n long, best string"
        found.append(block_cogroup(held, asked, ["length", "leaf"], _search, kind, ["word"], ["word"], held_rows, asked_rows))
    rows = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return rows.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_b")).select("word", "n_near", (-F.col("_b.less")).alias("best_n"), "_b.best")


def _swap(found: tuple[np.ndarray, np.ndarray], length: int) -> tuple[np.ndarray, int, np.ndarray]:
    return found[0], length, found[1]


def _dealt(part: pa.RecordBatch, rows: np.ndarray, length: int, leaves: np.ndarray, asked: bool) -> pa.RecordBatch:
    taken = part.take(pa.array(rows, pa.int64()))
    columns = [taken["word"], taken["n"], pa.array(np.full(len(rows), length, np.int32)), pa.array(leaves, pa.int32()), pa.array(np.full(len(rows), asked))]
    return pa.RecordBatch.from_arrays(columns, names=["word", "n", "length", "leaf", "asked"])


def variant_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n``.

    The form of a word is its near word of largest ``n``, if that is ``ratio`` times its own. Counts grow by that ratio
    with every step, so the root is found in as many doublings as the largest count allows.
    """
    scratch = Scratch(words.sparkSession)
    words = scratch.store(words, "words")
    joined = words.join(neighbours(words), "word", "left")
    has = F.col("best_n") >= ratio * F.col("n")
    named = scratch.store(
        joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")),
        "forms",
    )
    steps = named.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    largest = named.agg(F.max("n")).first()[0] or 1
    longest = math.floor(math.log(largest) / math.log(ratio)) + 1
    for round_ in range(max(0, longest - 1).bit_length()):
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        steps = scratch.store(steps.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), f"roots-{round_}")
    return named.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word")).select("word", "form", "root", "n", "n_near", "form_n")


def groups_sql() -> str:
    """The same table from the words with one letter left out, in SQL."""
    return f"""
WITH RECURSIVE crc_bytes AS (SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, k: xor(x >> 1, 3988292384 * (x & 1))) ORDER BY i) AS t FROM range(256) r(i)),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, unnest(regexp_extract_all(text, '{RUN}')) AS run FROM documents),
low AS (SELECT doc, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM runs WHERE length(run) >= {LEAST_LENGTH} GROUP BY ALL),
bytes AS (SELECT run, n, hex(encode(doc || ':' || run)) AS hx FROM low),
hashed AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(hx), 2), lambda i: 16 * (instr('0123456789ABCDEF', hx[i]) - 1) + instr('0123456789ABCDEF', hx[i + 1]) - 1)),
             lambda x, b: xor(x >> 8, t[xor(x & 255, b) + 1])), 4294967295) AS h FROM bytes, crc_bytes),
cut AS (SELECT CASE WHEN h % {EVERY} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n) AS n FROM cut WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
without AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS other, b.n FROM without a JOIN without b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM without a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM without a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS other_n FROM pairs GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= {RATIO} * w.n THEN b.other END AS form, CASE WHEN b.other_n >= {RATIO} * w.n THEN b.other_n END AS form_n
          FROM words w LEFT JOIN best b USING (word)),
chain AS (SELECT word, word AS now, 0 AS steps FROM forms UNION ALL SELECT c.word, f.form, c.steps + 1 FROM chain c JOIN forms f ON c.now = f.word WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(now, steps) AS root FROM chain GROUP BY word)
SELECT word, form, root, CAST(n AS BIGINT) AS n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n FROM forms JOIN roots USING (word)
"""
