"""Joins, splits and checks on keys that may be null or hold very many rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

ROWS_PER_BLOCK = 100_000


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which null keys match; the keys of ``left`` are kept.

    No side is forced into a broadcast: adaptive execution broadcasts the side
    whose measured size allows it, and splits skewed partitions otherwise.
    """
    if not keys:
        keys = ["_all"]
        left, right = left.withColumn("_all", F.lit(0)), right.withColumn("_all", F.lit(0))
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = None
    for key in keys:
        term = left[key].eqNullSafe(renamed[f"_r_{key}"])
        condition = term if condition is None else condition & term
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_anti", "left_semi") else joined.drop(*[f"_r_{k}" for k in keys], "_all")


def _block_counts(df: DataFrame, keys: list[str], rows: int, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(rows)).cast("int").alias(out))


def with_blocks(df: DataFrame, keys: list[str], rows: int, spread: list[str]) -> DataFrame:
    """Add ``_blocks``, the number of parts of a row's group, and ``_block``, the part of the row.

    ``spread`` names columns that tell the rows of a group apart. Only groups
    above ``rows`` rows enter the join, and there are at most total / rows of them, so
    they go to the rows, which stay where they are.
    """
    large = _block_counts(df, keys, rows, "_blocks").where(F.col("_blocks") > 1)
    joined = join_on(df, F.broadcast(large), keys, "left")
    blocks = F.coalesce("_blocks", F.lit(1))
    return joined.withColumn("_blocks", blocks).withColumn(
        "_block", F.pmod(F.xxhash64(*spread), F.col("_blocks")).cast("int")
    )


def block_cogroup(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    fn: Callable,
    schema: str,
    left_spread: list[str],
    right_spread: list[str],
    left_rows: int = ROWS_PER_BLOCK,
    right_rows: int = ROWS_PER_BLOCK,
    how: str = "inner",
) -> DataFrame:
    """Run ``fn(left_table, right_table)`` on Arrow tables for all pairs of blocks of every key.

    A key whose sides have m and n blocks becomes an m x n grid of tasks, so that
    every pair of rows meets in exactly one task, no task holds more than about one
    block of each side, and only what ``fn`` returns is emitted. Without keys both sides are one
    group, and ``fn`` also sees blocks that meet an empty one. ``how="left"`` also
    runs left rows without a partner, against an empty right table.
    """
    if keys:
        sizes = _block_counts(left, keys, left_rows, "_lefts")
        sizes = join_on(sizes, _block_counts(right, keys, right_rows, "_rights"), keys, how)
        sizes = sizes.withColumn("_rights", F.coalesce("_rights", F.lit(1)))
        with_sizes = lambda df: join_on(df, sizes, keys)
    else:  # one group: two numbers, no join
        lefts, rights = (max(1, -(-df.count() // rows)) for df, rows in ((left, left_rows), (right, right_rows)))
        with_sizes = lambda df: df.withColumns({"_lefts": F.lit(lefts), "_rights": F.lit(rights)})

    def placed(df: DataFrame, spread: list[str], own: str, other: str, mine: str, theirs: str) -> DataFrame:
        sized = with_sizes(df)
        return (
            sized.withColumn(mine, F.pmod(F.xxhash64(*spread), F.col(own)).cast("int"))
            .withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
            .drop("_lefts", "_rights")
            .repartition(*keys, "_i", "_j")
        )

    a = placed(left, left_spread, "_lefts", "_rights", "_i", "_j")
    b = placed(right, right_spread, "_rights", "_lefts", "_j", "_i")
    cell = [*keys, "_i", "_j"]
    return a.groupBy(*cell).cogroup(b.groupBy(*cell)).applyInArrow(fn, schema)


def key_product(left: DataFrame, right: DataFrame, spread: int | None = None) -> DataFrame:
    """All combinations of two distinct key sets.

    Written as an equi-join: every left key falls in one of ``spread`` buckets (the
    number of shuffle partitions by default) and the right keys are repeated once per
    bucket, so that the work is shared out.
    """
    spread = spread or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lefts = left.distinct()
    lefts = lefts.withColumn("_bucket", F.pmod(F.xxhash64(*left.columns), F.lit(spread)))
    buckets = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long")))
    rights = right.distinct().withColumn("_bucket", buckets)
    return lefts.join(rights, "_bucket").drop("_bucket")


def group_key_check(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Groups in which one of ``columns`` does not have exactly one distinct value.

    Minimum and maximum decide it, so nothing but two values per column is shuffled.
    """
    bounds = [f(F.col(c)).alias(f"_{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]
    varied = [
        F.when(F.coalesce(F.col(f"_lo_{c}") == F.col(f"_hi_{c}"), F.lit(False)), None).otherwise(F.lit(c))
        for c in columns
    ]
    checked = df.groupBy(*keys).agg(*bounds)
    return checked.select(*keys, F.concat_ws(",", *varied).alias("bad_columns")).where("bad_columns <> ''")


def not_yet_written(df: DataFrame, written: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys do not occur in ``written``."""
    return join_on(df, written.select(*keys).distinct(), keys, "left_anti")
