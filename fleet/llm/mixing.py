"""Mixing sources to target weights by fitting subset sums to budgets.

Sizes are words of a document. Each source has a budget of words. Its documents are repeated whole as often as they fit
together; the remaining budget is filled by some documents once more. How many of each exact length is decided on the
counts by length alone: the same share of every length, then the longest that still fit, and a bounded-knapsack dynamic
program over lengths closes the gap. Which documents of a length those are is decided by a seeded order.

No task sees the rows of a source: counts by length are pre-aggregated, and the seeded order is cut into slices by the
draw, so that a length shared by very many documents is ranked in many tasks. A null text has size 0; a null source is
a source of its own, last in order; repeated rows count as often as they occur; an empty table gives an empty table.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from fleet.operators.keys import join_on
from fleet.scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
#: The dynamic program works on gaps up to this many words, a table of as many cells; larger gaps are first closed by
#: whole documents.
GAP = 1 << 17
SLICE_ROWS = 1 << 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[int], share: Fraction, limit: int) -> DataFrame:
    """Targets of sources from ``(source, source_size)``: ``share`` of all words by weight, none above ``limit`` sizes.

    The excess of a full source goes to the others by weight. In the end every source has the lesser of its limit and a
    common rate times its weight. The rate is found on the sources ordered by limit / weight, with running sums.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("_weight", F.element_at(cycle, (F.row_number().over(order) - 1) % len(weights) + 1))
    ranked = ranked.withColumn("_cap", (F.col("source_size") * limit).cast("double")).withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    earlier = F.coalesce(F.sum("_cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    later = F.sum("_weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    budget = F.sum("source_size").over(everything) * F.lit(share.numerator) / F.lit(share.denominator)
    rated = ranked.withColumn("_rate", (budget - earlier) / later).withColumn("_at", F.row_number().over(by_ratio))
    first = F.min(F.when(F.col("_rate") <= F.col("_ratio"), F.struct("_at", "_rate"))).over(everything)  # not full
    target = F.least(F.col("_cap"), F.coalesce(first["_rate"] * F.col("_weight"), F.col("_cap")))
    return rated.withColumn("target", target).select("source", "source_size", "target")


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int, gap: int = GAP) -> np.ndarray:
    """How many of each length to take so that the sum comes as near to ``budget`` as it can from below.

    ``lengths`` are distinct and ascending. The same share of each length is taken, less whole documents where the
    gap would stay above ``gap``; the rest is a bounded knapsack over the documents that are left.
    """
    taken = np.zeros(len(lengths), np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return taken
    if budget >= total:
        return counts.copy()
    taken = np.array([int(c) * budget // total for c in counts], np.int64)
    left = budget - int((lengths * taken).sum())
    for i in range(len(lengths) - 1, -1, -1):  # longest first
        size = int(lengths[i])
        if size and left > gap:
            more = min(int(counts[i] - taken[i]), (left - gap + size - 1) // size, left // size)
            taken[i] += more
            left -= more * size
    return taken + _knapsack(lengths, counts - taken, left) if left <= gap else taken


def _knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack: the largest sum up to ``budget``. Counts become chunks of 1, 2, 4, ... of a length."""
    by = np.full(budget + 1, -1, np.int64)  # the chunk by which a sum was first reached
    reached = np.zeros(budget + 1, bool)
    reached[0] = True
    chunks: list[tuple[int, int]] = []
    for i in range(len(lengths) - 1, -1, -1):
        size = int(lengths[i])
        many = min(int(counts[i]), budget // size) if size else 0
        step = 1
        while many > 0 and not reached[budget]:
            n = min(step, many)
            w = n * size
            new = np.flatnonzero(reached[: budget + 1 - w] & ~reached[w:]) + w
            by[new] = len(chunks)
            reached[new] = True
            chunks.append((i, n))
            many, step = many - n, step * 2
    out, at = np.zeros(len(lengths), np.int64), int(np.flatnonzero(reached)[-1])
    while at:
        i, n = chunks[by[at]]
        out[i] += n
        at -= n * int(lengths[i])
    return out


def mix(docs: DataFrame, weights: list[int], share: Fraction, limit: int, seed: int) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs (doc_id, text, source)``."""
    scratch = Scratch(docs.sparkSession)
    sized = scratch.store(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    by_length = scratch.store(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    rows = by_length.agg(F.sum("n")).first()[0] or 0
    sources = by_length.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = scratch.store(source_targets(sources, weights, share, limit), "targets")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        """Rounds of each length: all documents so often, and so many once more."""
        pdf = pdf.sort_values("size", ignore_index=True)
        total, budget = int(pdf["source_size"][0]), round(float(pdf["target"][0]))
        rounds = budget // total if total else 0
        return pdf[["source", "size"]].assign(rounds=rounds, more=fit_counts(pdf["size"].to_numpy(), pdf["n"].to_numpy(), budget - rounds * total))

    plan = join_on(by_length, targets, ["source"]).groupBy("source").applyInPandas(fit, "source string, size long, rounds long, more long")
    plan = join_on(targets, plan, ["source"])

    # The seeded order within a length, in slices of the draw: earlier slices are counted, the slice is ranked.
    bits = max(0, (rows // SLICE_ROWS).bit_length())
    drawn = sized.withColumn("_draw", F.xxhash64(F.lit(seed), "doc_id"))
    drawn = drawn.withColumn("_slice", F.shiftrightunsigned("_draw", 64 - bits) if bits else F.lit(0).cast("long"))
    keys = ["source", "size"]
    slices = drawn.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    slices = join_on(slices.select(*keys, "_slice", F.coalesce(earlier, F.lit(0)).alias("_before")), plan, keys)
    own = Window.partitionBy(*keys, "_slice").orderBy("_draw", "doc_id")
    ranked = drawn.withColumn("_rank", F.row_number().over(own))
    placed = join_on(ranked, slices, [*keys, "_slice"])
    times = F.col("rounds") + F.when(F.col("_before") + F.col("_rank") <= F.col("more"), 1).otherwise(0)
    return placed.select("doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken"), times.alias("times"))
