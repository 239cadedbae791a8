"""Keeping a vector index in step with a stream of versioned rows keyed by id."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from fleet.operators.history import latest_per_name
from fleet.plans.vector import IvfIndex, gather_cells, place_vectors

#: The cell of deletions, which no query probes.
NO_CELL = -1


def sync_index(
    changes: DataFrame, index: IvfIndex, checkpoint: str, version: str = "version", deleted: str | None = None
) -> StreamingQuery:
    """Take all new rows of ``changes`` (``id``, ``vector`` and a rising ``version``) into the index and stop.

    A row with a null vector, or with the mark ``deleted``, takes its id out of the index. A batch is assigned to the
    stored cells and written as its own folder, named by the number of the batch, so a repeated batch replaces itself.
    The stored rows are not rewritten: readers take the row of the highest version of an id, so a batch that arrives late
    changes nothing, and ``compact_index`` folds the batches in. One checkpoint serves one index.
    """
    gone = F.col("vector").isNull() | (F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False))

    def take(batch: DataFrame, number: int) -> None:
        rows = batch.select(F.col("id").cast("long").alias("id"), "vector", F.col(version).cast("long").alias("version"), gone.alias("deleted"))
        newest = latest_per_name(rows.withColumn("_tie", F.xxhash64("vector", "deleted")), "id", "version", "_tie").drop("_tie")
        placed = place_vectors(index, newest.where("NOT deleted"))
        tombs = newest.where("deleted").withColumns({"vector": F.lit(None).cast(placed.schema["vector"].dataType), "cell": F.lit(NO_CELL)})
        both = placed.unionByName(tombs, allowMissingColumns=True)
        gather_cells(both).write.mode("overwrite").partitionBy("cell").parquet(f"{index.path}/vectors/batch={number}")

    stream = changes.writeStream.option("checkpointLocation", checkpoint)
    return stream.trigger(availableNow=True).foreachBatch(take).start()


def compact_index(index: IvfIndex, path: str) -> IvfIndex:
    """The newest rows as a new index without batches, with the same centroids and codebooks.

    Versions and deletions are kept, so that a batch that is older than what was folded in still changes nothing.
    """
    spark = index.spark
    for part in ("centroids", "codebooks"):
        spark.read.parquet(f"{index.path}/{part}").write.mode("overwrite").parquet(f"{path}/{part}")
    rows = index.newest().withColumn("batch", F.lit(-1))
    gather_cells(rows).write.mode("overwrite").partitionBy("batch", "cell").parquet(f"{path}/vectors")
    return IvfIndex(spark, path)
