"""Ordinals, running aggregates and exact ranks over a total order, without a single-task window.

The rows are range-partitioned on the order, every slice is handled on its own,
and the totals of the slices before it are added. Equal order values are told
apart by a tie column, so even a value that a third of the rows share is spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleet.operators.keys import join_on
from fleet.scratch import Scratch

_POSITION_MASK = (1 << 33) - 1
_BEFORE = (Window.unboundedPreceding, -1)
_UP_TO = (Window.unboundedPreceding, Window.currentRow)


def _sorted_slices(df: DataFrame, by: list[str], order: list[str | Column]) -> DataFrame:
    """Write the rows range-partitioned, with their slice ``_slice`` and place in it ``_at``."""
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    placed = (
        tied.repartitionByRange(*by, *order, "_tie")
        .sortWithinPartitions(*by, *order, "_tie")
        .withColumn("_slice", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK)))
        .drop("_tie")
    )
    return Scratch(df.sparkSession).store(placed, "slices")


def global_ordinal(
    df: DataFrame, order: list[str | Column], name: str = "ordinal", by: list[str] | None = None
) -> DataFrame:
    """Dense position from 0 in the given order, over all rows or within ``by``."""
    keys = list(by or [])
    stored = _sorted_slices(df, keys, order)
    runs = stored.groupBy(*keys, "_slice").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_slice").rowsBetween(*_BEFORE))
    shifts = runs.select(*keys, "_slice", (F.coalesce(earlier, F.lit(0)) - F.col("_first")).alias("_shift"))
    placed = join_on(stored, shifts, [*keys, "_slice"])
    return placed.withColumn(name, F.col("_at") + F.col("_shift")).drop("_at", "_slice", "_shift")


_COMBINE = {
    "sum": (F.sum, lambda a, b: a + F.coalesce(b, F.lit(0))),
    "min": (F.min, lambda a, b: F.least(a, b)),
    "max": (F.max, lambda a, b: F.greatest(a, b)),
}


def running(
    df: DataFrame,
    by: list[str],
    order: list[str | Column],
    scans: dict[str, tuple[str, str]],
    overall: dict[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Running aggregates up to the current row, e.g. ``{"best": ("min", "loss")}``.

    ``overall`` adds aggregates of the whole group. Groups of any size are spread over
    many tasks: only one row per slice and group is brought together.
    """
    overall = overall or {}
    stored = _sorted_slices(df, by, order)
    keys = [*by, "_slice"]
    both = {**{f"_t_{n}": v for n, v in scans.items()}, **{f"_o_{n}": v for n, v in overall.items()}}
    totals = stored.groupBy(*keys).agg(*[_COMBINE[f][0](c).alias(n) for n, (f, c) in both.items()])
    group = Window.partitionBy(*by)
    before = group.orderBy("_slice").rowsBetween(*_BEFORE)
    carries = totals.select(
        *keys,
        *[_COMBINE[f][0](f"_t_{n}").over(before).alias(f"_c_{n}") for n, (f, _) in scans.items()],
        *[_COMBINE[f][0](f"_o_{n}").over(group).alias(n) for n, (f, _) in overall.items()],
    )
    local = Window.partitionBy(*keys).orderBy("_at").rowsBetween(*_UP_TO)
    scanned = stored.select("*", *[_COMBINE[f][0](c).over(local).alias(f"_l_{n}") for n, (f, c) in scans.items()])
    return join_on(scanned, carries, keys).select(
        *df.columns,
        *[_COMBINE[f][1](F.col(f"_l_{n}"), F.col(f"_c_{n}")).alias(n) for n, (f, _) in scans.items()],
        *overall,
    )


def value_ranks(df: DataFrame, value: str, by: list[str] | None = None, descending: bool = False) -> DataFrame:
    """Distinct values with ``n`` (rows having it), ``upto`` (rows up to it) and ``total`` (rows of the group)."""
    keys = list(by or [])
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    order = F.col(value).desc() if descending else F.col(value)
    return running(counts, keys, [order], {"upto": ("sum", "n")}, {"total": ("sum", "n")})


def exact_percentiles(df: DataFrame, value: str, probs: list[float], by: list[str] | None = None) -> DataFrame:
    """Percentiles with linear interpolation, exact for groups of any size.

    Values are counted first, then ranked by a distributed running sum; only the
    values at the asked ranks are brought together. Returns the keys and
    ``percentiles array<double>``.
    """
    keys = list(by or [])
    levels = ", ".join(f"{float(p)!r}D" for p in probs)
    places = F.expr(f"transform(array({levels}), (p, i) -> struct(i AS i, p * (total - 1) AS at))")
    inside = lambda rank: f"({rank}(s.at) >= upto - n AND {rank}(s.at) < upto)"
    ranks = value_ranks(df, value, keys).withColumn("_places", places)
    hit = ranks.withColumn("_hits", F.expr(f"filter(_places, s -> {inside('floor')} OR {inside('ceil')})"))
    rows = hit.where(F.size("_hits") > 0).select(*keys, F.col(value).cast("double").alias("_v"), "upto", "n", F.explode("_hits").alias("s"))
    ends = rows.groupBy(*keys, "s").agg(
        *[F.expr(f"max(CASE WHEN {inside(rank)} THEN _v END)").alias(out) for rank, out in (("floor", "_lo"), ("ceil", "_hi"))]
    )
    found = ends.select(*keys, F.struct("s.i", F.expr("_lo + (_hi - _lo) * (s.at - floor(s.at))").alias("v")).alias("_p"))
    return found.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list("_p")), lambda p: p["v"]).alias("percentiles"))


def rank_cut(
    df: DataFrame, metric: str, share: float, by: list[str] | None = None, descending: bool = False
) -> DataFrame:
    """Add ``kept``: whether the percent rank of the row's metric in its group is below ``share``."""
    keys = list(by or [])
    ranks = value_ranks(df, metric, keys, descending)
    less = F.col("upto") - F.col("n")
    inside = ranks.where(less < F.lit(share) * F.greatest(F.col("total") - 1, F.lit(1)))
    edge = F.min(metric) if descending else F.max(metric)
    cuts = inside.groupBy(*keys).agg(edge.alias("_cut"))
    joined = join_on(df, cuts, keys, "left")
    kept = F.col(metric) >= F.col("_cut") if descending else F.col(metric) <= F.col("_cut")
    return joined.withColumn("kept", F.coalesce(kept, F.lit(False))).drop("_cut")
