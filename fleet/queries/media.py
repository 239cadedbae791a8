"""Arrays, images and tensors."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleet.functions.arrays import array_means
from fleet.operators.tensors import slice_summary, tensor_slices
from fleet.queries.registry import query, table


def _cube(values: str, outer: int, rows: int, columns: int):
    """A flat array column as nested arrays of the given shape."""
    line = lambda start: F.slice(F.col(values), start + 1, columns)
    plane = lambda first: F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), lambda y: line(first + y * columns))
    return F.transform(F.sequence(F.lit(0), F.lit(outer - 1)), lambda z: plane(z * rows * columns))


@query(
    """SELECT label, CAST(i - 1 AS BIGINT) AS pos, round(avg(embedding[i]::DOUBLE), 8) AS mean
       FROM embeddings, range(1, 65) t(i) GROUP BY 1, 2"""
)
def array_mean(spark, folder):
    means = array_means(table(spark, folder, "embeddings"), "embedding", ["label"])
    return means.withColumn("mean", F.round("mean", 8))


@query(
    """WITH c AS (SELECT i, avg(embedding[i]::DOUBLE) AS m FROM embeddings, range(1, 65) t(i) GROUP BY 1)
       SELECT round(quantile_cont(m, 0.01), 8) AS p1, round(quantile_cont(m, 0.99), 8) AS p99 FROM c"""
)
def image_bounds(spark, folder):
    images = table(spark, folder, "embeddings").select(_cube("embedding", 1, 8, 8)[0].alias("image"))
    _, bounds = slice_summary(images, "image")
    low, high = F.col("percentiles")[0], F.col("percentiles")[1]
    return bounds.select(F.round(low, 8).alias("p1"), F.round(high, 8).alias("p99"))


@query(
    """WITH t AS (SELECT embedding AS e, row_number() OVER (ORDER BY vec_id) AS i FROM embeddings),
            b AS (SELECT doc_id, quality, row_number() OVER (ORDER BY doc_id) AS i FROM labels)
       SELECT doc_id, quality, CAST(n // 16 AS INTEGER) AS image_slice, CAST((n // 4) % 4 AS INTEGER) AS y, CAST(n % 4 AS INTEGER) AS x,
              round(CAST(CAST(e[n + 1]::DOUBLE / 300 AS FLOAT) AS DOUBLE), 9) AS v
       FROM b FULL JOIN t ON b.i = t.i LEFT JOIN range(0, 64) r(n) ON e IS NOT NULL"""
)
def trial_slices(spark, folder):
    trials = table(spark, folder, "embeddings").select("vec_id", _cube("embedding", 4, 4, 4).alias("betas"))
    behaviour = table(spark, folder, "labels").select("doc_id", "quality")
    slices = tensor_slices(trials, "betas", ["vec_id"], behaviour, ["doc_id"])
    lines = slices.select("doc_id", "quality", F.col("IMAGE_SLICE").alias("image_slice"), F.posexplode_outer("IMAGE").alias("y", "line"))
    cells = lines.select("doc_id", "quality", "image_slice", "y", F.posexplode_outer("line").alias("x", "v"))
    return cells.withColumn("v", F.round(F.col("v").cast("double"), 9))
