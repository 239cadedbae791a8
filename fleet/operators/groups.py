"""User functions over groups, batches and routed models."""

from __future__ import annotations

import traceback
from collections.abc import Callable, Iterator
from functools import reduce
from operator import or_
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from fleet.operators.keys import ROWS_PER_BLOCK, block_cogroup, with_blocks

ROWS_PER_TASK = 1_000_000


def _with_error(schema: str) -> T.StructType:
    return T.StructType.fromDDL(schema).add("error", T.StringType())


def _guarded(fn: Callable, keys: list[str], columns: list[str], kwargs: dict) -> Callable:
    """Call ``fn(pdf, **kwargs)``; a failure becomes one row with the keys and the message."""

    def call(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        try:
            out = fn(pdf, **kwargs).copy()
            out["error"] = None
        except Exception:
            message = traceback.format_exc(limit=1).strip().splitlines()[-1]
            out = pd.DataFrame({**{k: [v] for k, v in zip(keys, key)}, "error": [message]})
        return out.reindex(columns=columns)

    return call


def _tasks(df: DataFrame, rows: int) -> int:
    """Partitions of a shuffle such that a task gets about ``ROWS_PER_TASK`` rows or fewer."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))


def grouped_fold(
    df: DataFrame,
    keys: list[str],
    partial: Callable[..., pd.DataFrame],
    schema: str,
    merge: list[Column],
    spread: list[str],
    rows_per_block: int = ROWS_PER_BLOCK,
    columns: list[str] | None = None,
    **kwargs,
) -> DataFrame:
    """Grouped map for groups of any size: ``partial`` on blocks of a group, ``merge`` over its results.

    ``partial(pdf, **kwargs)`` returns rows of ``schema`` (which holds the keys) and
    ``merge`` lists the aggregates that combine them. ``spread`` tells the rows of a
    group apart. A failing block does not fail the job: the group gets an ``error``.
    """
    source = df.select(*dict.fromkeys([*keys, *spread, *(columns or df.columns)]))
    blocked = with_blocks(source, keys, rows_per_block, spread).drop("_blocks")
    out_schema = _with_error(schema)
    call = _guarded(lambda pdf, **kw: partial(pdf.drop(columns="_block"), **kw), keys, out_schema.names, kwargs)
    parts = blocked.repartition(_tasks(df, source.count()), *keys, "_block").groupBy(*keys, "_block")
    parts = parts.applyInPandas(lambda key, pdf: call(key[: len(keys)], pdf), out_schema)
    return parts.groupBy(*keys).agg(*merge, F.max("error").alias("error"))


def grouped_map(
    df: DataFrame,
    keys: list[str],
    fn: Callable[..., pd.DataFrame],
    schema: str,
    columns: list[str] | None = None,
    rows_per_call: int = 0,
    **kwargs,
) -> DataFrame:
    """Run ``fn(pdf, **kwargs)`` on whole groups, with an ``error`` column.

    For functions that need all rows of a group at once; a task then holds its largest
    group. Functions that work through the rows take ``grouped_stream``, those that work
    on parts ``grouped_fold``. A function that tells the groups of a frame apart gets
    about ``rows_per_call`` rows of whole groups at once, which spares very many small
    groups a call each; when it fails, the groups of that call run one by one.
    """
    source = df.select(*dict.fromkeys([*keys, *(columns or df.columns)]))
    out_schema = _with_error(schema)
    call = _guarded(fn, keys, out_schema.names, kwargs)
    if not rows_per_call:
        return source.groupBy(*keys).applyInPandas(lambda key, pdf: call(key, pdf), out_schema)
    order, calls = source.columns, max(1, -(-source.count() // rows_per_call))

    def each(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for key, part in pdf.groupby(keys, dropna=False, sort=False):
            yield call(tuple(None if pd.isna(v) else v for v in key), part.reset_index(drop=True))

    def several(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf[order]
        try:
            return fn(rows, **kwargs).assign(error=None).reindex(columns=out_schema.names)
        except Exception:
            return pd.concat(list(each(rows)), ignore_index=True)

    number, null = F.pmod(F.xxhash64(*keys), F.lit(calls)), reduce(or_, [F.col(k).isNull() for k in keys])
    dealt = source.withColumn("_call", F.when(null, -1 - number).otherwise(number))  # a null turns whole numbers of its frame into floats
    return dealt.repartition(_tasks(df, calls * rows_per_call), "_call").groupBy("_call").applyInPandas(several, out_schema)


def grouped_stream(
    df: DataFrame,
    keys: list[str],
    fn: Callable[..., Iterator[pd.DataFrame]],
    schema: str,
    columns: list[str] | None = None,
    merge: list[Column] | None = None,
    rows_per_part: int = ROWS_PER_BLOCK,
    **kwargs,
) -> DataFrame:
    """Run ``fn(frames, **kwargs)`` on the frames of each group one after another, with an ``error`` column.

    A task never holds a whole group in Python. When ``fn`` fails, the group's last row has the message.
    Without ``merge`` the rows of a group are sorted together in one task. With it, groups are dealt in parts of about
    ``rows_per_part`` rows, a stream each, and the aggregates of ``merge`` combine their rows (of ``schema``, which holds
    the keys), so that no task has more than a part of a large group.
    """
    source = df.select(*dict.fromkeys([*keys, *(columns or df.columns)]))
    out_schema = _with_error(schema)
    names, drop = out_schema.names, ["_part"] if merge else []

    def run(key: tuple[Any, ...], frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            for out in fn((pdf.drop(columns=drop) for pdf in frames), **kwargs):
                yield out.assign(error=None).reindex(columns=names)
        except Exception:
            message = traceback.format_exc(limit=1).strip().splitlines()[-1]
            yield pd.DataFrame({**{k: [v] for k, v in zip(keys, key)}, "error": [message]}).reindex(columns=names)

    run.__annotations__ = {"key": tuple[Any, ...], "frames": Iterator[pd.DataFrame], "return": Iterator[pd.DataFrame]}
    if not merge:
        return source.groupBy(*keys).applyInPandas(run, out_schema)
    rows = source.count()
    numbered = source.withColumn("_part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(max(1, -(-rows // rows_per_part)))))
    parts = numbered.repartition(_tasks(df, rows), *keys, "_part").groupBy(*keys, "_part")
    return parts.applyInPandas(run, out_schema).groupBy(*keys).agg(*merge, F.max("error").alias("error"))


def batch_map(
    df: DataFrame,
    build: Callable[..., Callable[[pa.RecordBatch], pa.RecordBatch]],
    schema: str,
    args: tuple = (),
    concurrency: int | None = None,
    batch_size: int | None = None,
) -> DataFrame:
    """Stateful batch map: ``build(*args)`` once per task, then its result once per batch.

    ``concurrency`` is the number of partitions; ``batch_size`` the most rows of a batch.
    """
    source = df.repartition(concurrency) if concurrency else df

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = build(*args)
        for batch in batches:
            step = batch_size or max(batch.num_rows, 1)
            for start in range(0, batch.num_rows, step):
                yield call(batch.slice(start, step))

    return source.mapInArrow(run, schema)


def expand_rows(df: DataFrame, count: Column, out: str = "n") -> DataFrame:
    """Row generator: every row is repeated ``count`` times with a number from 0."""
    numbers = F.sequence(F.lit(0).cast("long"), count.cast("long") - 1)
    return df.where(count > 0).withColumn(out, F.explode(numbers))


def pair_trials(df: DataFrame, trials: list[dict], out: str = "trial_id") -> DataFrame:
    """Every group with every trial of a bounded list, as an expansion of each group row."""
    return df.withColumn(out, F.explode(F.array(*[F.lit(int(t[out])) for t in trials])))


def route_predict(
    rows: DataFrame,
    models: DataFrame,
    group_columns: list[str],
    row_key: str,
    predict: Callable[[str, pd.DataFrame], pd.Series],
    features: list[str],
    rows_per_block: int = ROWS_PER_BLOCK,
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """One prediction per row, by the model of the row's group; null where a group has no model.

    ``models`` has the group columns and a text column ``model``. While the models
    together are below ``broadcast_bytes`` they go to every task and the rows are not
    shuffled; beyond that, blocks of rows meet the one model of their group.
    Returns ``row_key``, the group columns and ``prediction``; sort by the key to
    restore the input order.
    """
    spark = rows.sparkSession
    source = rows.select(*dict.fromkeys([row_key, *group_columns, *features]))
    out = T.StructType([source.schema[row_key], *[source.schema[c] for c in group_columns]])
    out = out.add("prediction", T.DoubleType())
    total = models.agg(F.coalesce(F.sum(F.octet_length("model")), F.lit(0)).alias("b"), F.count("*").alias("n")).first()

    if total["b"] + 64 * total["n"] <= broadcast_bytes:
        table = {tuple(r[c] for c in group_columns): r["model"] for r in models.collect()}
        shared = spark.sparkContext.broadcast(table)

        def by_batch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                pdf["prediction"] = None
                for key, part in pdf.groupby(group_columns, dropna=False, sort=False):
                    model = shared.value.get(tuple(None if pd.isna(v) else v for v in key))
                    if model is not None:
                        pdf.loc[part.index, "prediction"] = predict(model, part[features])
                yield pdf[out.names].astype({"prediction": "float64"})

        return source.mapInPandas(by_batch, out)

    def by_block(left: pa.Table, right: pa.Table) -> pa.Table:
        values = pa.nulls(left.num_rows, pa.float64())
        model = right["model"][0].as_py() if right.num_rows else None
        if model is not None:
            values = pa.array(predict(model, left.select(features).to_pandas()), pa.float64(), from_pandas=True)
        return left.select(out.names[:-1]).append_column("prediction", values)

    pairs = models.select(*group_columns, "model")
    return block_cogroup(
        source, pairs, group_columns, by_block, out, [row_key], ["model"], rows_per_block, rows_per_block, "left"
    )
