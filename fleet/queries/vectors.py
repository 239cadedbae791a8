"""Vector search."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleet.functions.arrays import mean_vectors, squared_l2
from fleet.plans.vector import (
    fan_out, ivf_build, ivf_search, knn_exact, route_to_shard, search_shards, search_to_table, shard_vectors,
)
from fleet.queries.registry import query, table
from fleet.scratch import Scratch

_L2 = "list_sum(list_transform(range(1, 65), lambda i: (v.embedding[i]::DOUBLE - q.query[i]) ** 2))"
_MEANS = """means AS (SELECT label, list(m ORDER BY i) AS query FROM
            (SELECT label, i, avg(embedding[i]::DOUBLE) AS m FROM embeddings, range(1, 65) t(i) GROUP BY 1, 2) GROUP BY 1)"""
_ALL = "queries AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS query FROM embeddings)"
_TOP = """SELECT query_id, id, round(distance, 6) AS distance,
                 row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM hits
          QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, id) <= 10"""


_NEAR = """near AS (SELECT q.query_id, q.query, m.label AS cell,
                     row_number() OVER (PARTITION BY q.query_id ORDER BY
                       list_sum(list_transform(range(1, 65), lambda i: (m.query[i] - q.query[i]) ** 2)), m.label) AS place
                   FROM queries q, means m)"""


def _vectors(spark, folder):
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


def _means(spark, folder):
    found = mean_vectors(table(spark, folder, "embeddings"), "embedding", ["label"], "query")
    return found.select(F.col("label").cast("long").alias("query_id"), "query")


def _queries(spark, folder):
    rows = table(spark, folder, "embeddings")
    return rows.select(F.col("vec_id").alias("query_id"), F.col("embedding").cast("array<double>").alias("query"))


def _label_cells(spark, folder):
    found = mean_vectors(table(spark, folder, "embeddings"), "embedding", ["label"], "centroid")
    return found.select(F.col("label").cast("int").alias("cell"), "centroid")


def _rounded(hits):
    return hits.select("query_id", "id", F.round("distance", 6).alias("distance"), "rank")


_EXACT_SQL = f"""WITH {_MEANS}, hits AS (SELECT q.label::BIGINT AS query_id, v.vec_id AS id, {_L2} AS distance
                 FROM means q, embeddings v) {_TOP}"""


@query(_EXACT_SQL)
def knn_class_means(spark, folder):
    """The nearest vectors of every class mean."""
    return _rounded(knn_exact(_means(spark, folder), _vectors(spark, folder), 10))


@query(_EXACT_SQL)
def shard_merge(spark, folder):
    """Search every shard on its own and merge the hits of all of them."""
    shards = shard_vectors(_vectors(spark, folder), 128)
    count = shards.agg(F.max("shard") + 1).first()[0]
    return _rounded(search_shards(fan_out(_means(spark, folder), count), shards, 10))


@query(
    f"""WITH {_MEANS}, {_ALL}, {_NEAR},
        cells AS (SELECT v.embedding, v.vec_id, n.cell FROM embeddings v JOIN near n ON n.query_id = v.vec_id AND n.place = 1),
        hits AS (SELECT q.query_id, v.vec_id AS id, {_L2} AS distance FROM near q JOIN cells v ON q.cell = v.cell WHERE q.place <= 3)
        {_TOP}"""
)
def batched_search(spark, folder):
    """All vectors as queries, the three nearest cells of each searched, in batches to a table."""
    target = Scratch(spark).path
    index = ivf_build(_vectors(spark, folder), f"{target}/index", centroids=_label_cells(spark, folder))
    return _rounded(search_to_table(_queries(spark, folder), index, 10, f"{target}/hits", nprobe=3))


@query(
    f"""WITH {_MEANS}, {_ALL}, {_NEAR},
        cells AS (SELECT v.embedding, v.vec_id, n.cell FROM embeddings v JOIN near n ON n.query_id = v.vec_id AND n.place = 1),
        hits AS (SELECT q.query_id, v.vec_id AS id, {_L2} AS distance FROM near q JOIN cells v ON q.cell = v.cell WHERE q.place <= 2)
        {_TOP}"""
)
def ivf_two_cells(spark, folder):
    """All vectors as queries, the two nearest cells of each searched."""
    index = ivf_build(_vectors(spark, folder), f"{Scratch(spark).path}/index", centroids=_label_cells(spark, folder))
    return _rounded(ivf_search(_queries(spark, folder), index, 10, nprobe=2))


@query()
def ivf_trained(spark, folder):
    """Trained cells, four of them probed."""
    index = ivf_build(_vectors(spark, folder), f"{Scratch(spark).path}/index", cells=11)
    return _rounded(ivf_search(_means(spark, folder), index, 10, nprobe=4))


@query(_EXACT_SQL)
def ivf_all_cells(spark, folder):
    """Trained cells, all of them probed: the exact result."""
    index = ivf_build(_vectors(spark, folder), f"{Scratch(spark).path}/index", cells=11)
    return _rounded(ivf_search(_means(spark, folder), index, 10, nprobe=11))


@query()
def pq_refined(spark, folder):
    """Trained cells and product codes, candidates ranked again by exact distance."""
    index = ivf_build(_vectors(spark, folder), f"{Scratch(spark).path}/index", cells=11, sub_vectors=8)
    return _rounded(ivf_search(_means(spark, folder), index, 10, nprobe=11, refine=5))


@query(
    f"""WITH shards AS (SELECT vec_id, embedding, (row_number() OVER (ORDER BY vec_id) - 1) // 128 AS shard FROM embeddings),
        users AS (SELECT DISTINCT user_id FROM events),
        queries AS (SELECT user_id AS query_id, embedding::DOUBLE[] AS query,
                           user_id % (SELECT max(shard) + 1 FROM shards) AS shard FROM users JOIN embeddings ON vec_id = user_id),
        hits AS (SELECT q.query_id, v.vec_id AS id, {_L2} AS distance FROM queries q JOIN shards v ON q.shard = v.shard) {_TOP}"""
)
def route_shard(spark, folder):
    """Every user's query goes to one shard only."""
    shards = shard_vectors(_vectors(spark, folder), 128)
    count = shards.agg(F.max("shard") + 1).first()[0]
    users = table(spark, folder, "events").select("user_id").distinct()
    queries = users.join(_queries(spark, folder), F.col("user_id") == F.col("query_id"))
    routed = queries.withColumn("shard", route_to_shard(F.col("user_id"), count)).drop("user_id")
    return _rounded(search_shards(routed, shards, 10))


@query(
    """WITH m AS (SELECT label, i, avg(embedding[i]::DOUBLE) AS c FROM embeddings, range(1, 65) t(i) GROUP BY 1, 2)
       SELECT vec_id, round(sum((embedding[i]::DOUBLE - c) ** 2), 8) AS distance
       FROM embeddings e JOIN m ON e.label = m.label GROUP BY vec_id"""
)
def distance_to_mean(spark, folder):
    rows = table(spark, folder, "embeddings")
    means = mean_vectors(rows, "embedding", ["label"])
    joined = rows.join(means, "label")
    return joined.select("vec_id", F.round(squared_l2(F.col("embedding"), F.col("mean")), 8).alias("distance"))
