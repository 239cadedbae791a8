import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import fleet.plans.vector as module
from fleet.plans.vector import (
    fan_out, ivf_build, ivf_search, knn_exact, route_to_shard, search_shards, search_to_table, shard_vectors,
)
from fleet.sources.sinks import write_shards
from fleet.streaming.index_sync import compact_index, sync_index


@pytest.fixture(scope="module")
def data(spark):
    """Clustered vectors of which a third are copies of one vector; ids are sparse."""
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (600, 8)) + rng.integers(0, 5, (600, 1)) * 6
    x[400:] = x[3]
    ids = np.arange(600) * 7 + 5
    q = x[rng.integers(0, 600, 40)] + rng.normal(0, 0.3, (40, 8))
    vectors = spark.createDataFrame(pd.DataFrame({"id": ids, "vector": list(x.tolist())})).repartition(6).persist()
    queries = spark.createDataFrame(pd.DataFrame({"query_id": range(40), "query": list(q.tolist())}))
    gaps = ((q[:, None] - x) ** 2).sum(2)
    truth = {i: [int(ids[j]) for j in np.lexsort((ids, gaps[i]))[:10]] for i in range(40)}
    return vectors, queries, truth


def _lists(hits):
    rows = hits.orderBy("query_id", "rank").collect()
    out = {}
    for r in rows:
        out.setdefault(r["query_id"], []).append(r["id"])
    return out


@pytest.mark.parametrize("limit", [32 << 20, 1])
def test_exact_equals_brute_force(data, monkeypatch, limit):
    vectors, queries, truth = data
    monkeypatch.setattr(module, "BROADCAST_BYTES", limit)
    assert _lists(knn_exact(queries, vectors, 10, query_rows=16, vector_rows=90)) == truth


def test_shards_keep_all_rows_and_merge_to_the_global_best(spark, data, tmp_path):
    vectors, queries, truth = data
    shards = shard_vectors(vectors, 150)
    assert [r["count"] for r in shards.groupBy("shard").count().orderBy("shard").collect()] == [150] * 4
    assert _lists(search_shards(fan_out(queries, 4), shards, 10)) == truth
    path = str(tmp_path / "shards")
    write_shards(shards.where("shard < 2"), path)
    write_shards(shards, path)
    write_shards(shards, path)
    assert spark.read.parquet(path).count() == 600


def test_routing_searches_one_shard_only(data):
    vectors, queries, _ = data
    shards = shard_vectors(vectors, 150)
    routed = queries.withColumn("shard", route_to_shard(F.col("query_id"), 4))
    hits = search_shards(routed, shards, 5).join(shards.select("id", "shard"), "id")
    assert hits.where("shard <> query_id % 4").count() == 0 and hits.count() == 200


@pytest.mark.parametrize("limit", [32 << 20, 1])
def test_all_cells_equal_exact_and_fewer_recall_most(data, tmp_path, monkeypatch, limit):
    vectors, queries, truth = data
    monkeypatch.setattr(module, "BROADCAST_BYTES", limit)
    index = ivf_build(vectors, str(tmp_path / "index"), cells=6)
    assert index.vectors().count() == 600
    assert _lists(ivf_search(queries, index, 10, nprobe=6, query_rows=16, vector_rows=90)) == truth
    few = _lists(ivf_search(queries, index, 10, nprobe=2))
    assert np.mean([len(set(few[i]) & set(truth[i])) / 10 for i in truth]) > 0.8


def test_codes_recall_and_refinement(spark, data, tmp_path):
    vectors, queries, truth = data
    index = ivf_build(vectors, str(tmp_path / "index"), cells=4, sub_vectors=4, codes=32)
    assert index.codebooks().shape == (4, 32, 2)
    found = _lists(ivf_search(queries, index, 10, nprobe=4, refine=30))
    assert np.mean([len(set(found[i]) & set(truth[i])) / 10 for i in truth]) > 0.7
    every = _lists(ivf_search(queries, index, 10, nprobe=4, refine=60))
    assert every == truth
    with pytest.raises(ValueError):
        ivf_build(vectors, str(tmp_path / "bad"), cells=2, sub_vectors=3)


def test_batched_search_writes_all_hits(data, tmp_path):
    vectors, queries, truth = data
    index = ivf_build(vectors, str(tmp_path / "index"), cells=3)
    assert _lists(search_to_table(queries, index, 10, str(tmp_path / "hits"), nprobe=3)) == truth


def test_synced_index_equals_a_new_build(spark, data, tmp_path):
    vectors, queries, _ = data
    index = ivf_build(vectors.where("id < 2000"), str(tmp_path / "index"), cells=4)
    source, checkpoint = str(tmp_path / "changes"), str(tmp_path / "checkpoint")
    moved = vectors.where("id < 700").withColumn("vector", F.transform("vector", lambda v: v + 1))
    first = vectors.where("id >= 2000").withColumn("version", F.lit(1))
    first.unionByName(moved.withColumn("version", F.lit(1))).write.parquet(source)

    def run():
        changes = spark.readStream.schema(first.schema).parquet(source)
        sync_index(changes, index, checkpoint).awaitTermination()

    run()
    stale = moved.withColumn("vector", F.transform("vector", lambda v: v - 50)).withColumn("version", F.lit(2))
    final = moved.withColumn("vector", F.transform("vector", lambda v: v + 1)).withColumn("version", F.lit(3))
    stale.unionByName(final).write.mode("append").parquet(source)
    run()
    run()
    want = vectors.where("id >= 700").unionByName(final.drop("version"))
    assert index.vectors().count() == 600
    truth = _lists(knn_exact(queries, want, 10))
    assert _lists(ivf_search(queries, index, 10, nprobe=4)) == truth
    packed = compact_index(index, str(tmp_path / "packed"))
    assert packed.vectors().count() == 600 and _lists(ivf_search(queries, packed, 10, nprobe=4)) == truth


def test_late_batches_lose_and_deletions_hold(spark, data, tmp_path):
    vectors, queries, _ = data
    index = ivf_build(vectors.where("id < 2000"), str(tmp_path / "index"), cells=4, sub_vectors=2, codes=16)
    moved = lambda by, version: vectors.withColumns({"vector": F.transform("vector", lambda v: v + by), "version": F.lit(version)})
    gone = vectors.where("id % 7 = 0").select("id", F.lit(None).cast(vectors.schema["vector"].dataType).alias("vector"), F.lit(6).alias("version"))
    batches = [moved(1.0, 5), gone, moved(90.0, 2), moved(70.0, 5).where("id < 0"), gone.withColumn("version", F.lit(1)).where("id >= 0"), moved(3.0, 8).where("id % 14 = 0")]
    source, checkpoint = str(tmp_path / "changes"), str(tmp_path / "checkpoint")
    for batch in batches:
        batch.write.mode("append").parquet(source)
        changes = spark.readStream.schema(batch.schema).parquet(source)
        sync_index(changes, index, checkpoint).awaitTermination()
    want = moved(1.0, 5).where("id % 7 <> 0").unionByName(moved(3.0, 8).where("id % 14 = 0")).drop("version")
    truth = _lists(knn_exact(queries, want, 10))
    assert index.vectors().count() == want.count()
    assert _lists(ivf_search(queries, index, 10, nprobe=4)) == truth
    packed = compact_index(index, str(tmp_path / "packed"))
    late, again = str(tmp_path / "late"), str(tmp_path / "again")
    moved(50.0, 4).write.parquet(late)  # older than all that was folded in, deletions too
    sync_index(spark.readStream.schema(moved(50.0, 4).schema).parquet(late), packed, again).awaitTermination()
    assert packed.vectors().count() == want.count() and _lists(ivf_search(queries, packed, 10, nprobe=4)) == truth


def test_crowded_cell_and_shard_are_written_by_even_tasks(spark, tmp_path):
    from fleet.sources.sinks import write_shards

    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128k")
    try:
        rows = spark.range(40_000, numPartitions=8).select("id", F.transform(F.sequence(F.lit(0), F.lit(7)), lambda j: F.when(F.col("id") % 2 == 0, F.lit(0.0)).otherwise((F.xxhash64("id", j) % 1000) / 1000.0).cast("float")).alias("vector"))
        centroids = spark.createDataFrame([(0, [0.0] * 8), (1, [0.5] * 8), (2, [-0.5] * 8)], "cell int, centroid array<double>")
        index = ivf_build(rows, str(tmp_path / "index"), centroids=centroids)
        assert len(list((tmp_path / "index" / "vectors" / "batch=-1" / "cell=0").glob("*.parquet"))) > 1
        assert index.vectors().count() == 40_000
        write_shards(rows.withColumn("shard", F.when(F.col("id") < 30_000, 0).otherwise(F.col("id") % 5)), str(tmp_path / "shards"))
        assert len(list((tmp_path / "shards" / "shard=0").glob("*.parquet"))) > 1
        assert spark.read.parquet(str(tmp_path / "shards")).count() == 40_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)


def test_a_block_is_searched_in_bounded_memory():
    import tracemalloc

    draws = np.random.default_rng(1)
    vectors, queries = draws.normal(size=(20_000, 16)), draws.normal(size=(600, 16))
    tracemalloc.start()
    found = module._nearest(np.arange(600), queries, np.arange(20_000), vectors, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48 << 20
    for q in (0, 599):
        gaps = ((vectors - queries[q]) ** 2).sum(1)
        assert list(found[1][found[0] == q]) == list(np.argsort(gaps, kind="stable")[:5])
