"""Tables, files and streams: written from given tables and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleet.plans.vector import ivf_build, ivf_search
from fleet.queries.registry import query, table
from fleet.queries.vectors import _label_cells, _means, _rounded
from fleet.scratch import Scratch, temporary_table
from fleet.sources.sinks import append_rows, ensure_table, overwrite_table, to_driver, write_json_lines, write_parquet
from fleet.sources.tables import read_delimited, read_table
from fleet.streaming.images import append_stream, image_rows, label_counts
from fleet.streaming.index_sync import compact_index, sync_index


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def tsv_round_trip(spark, folder):
    rows, path = table(spark, folder, "nation"), f"{Scratch(spark).path}/tsv"
    rows.write.option("sep", "\t").option("header", True).csv(path)
    return read_delimited(spark, path, "n_nationkey int, n_name string, n_regionkey int")


@query("SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1")
def table_overwritten(spark, folder):
    """A table of suppliers per nation, then of customers under the same name."""
    name = temporary_table(spark, "overwrite")
    for source, key in (("supplier", "s_nationkey"), ("customer", "c_nationkey")):
        rows = table(spark, folder, source).groupBy(F.col(key).alias("c_nationkey")).agg(F.count("*").alias("n"))
        overwrite_table(rows, name)
    return spark.table(name)


@query("SELECT o_orderpriority, count(*) AS n, false AS made_again FROM orders GROUP BY 1")
def table_ensured(spark, folder):
    """A table that is made once: the second builder is not run."""
    name, rows = temporary_table(spark, "ensure"), table(spark, folder, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    ensure_table(spark, name, lambda: rows)
    again = ensure_table(spark, name, lambda: rows.where("n < 0"))
    return spark.table(name).withColumn("made_again", F.lit(again))


@query("SELECT r_regionkey, r_name FROM region UNION ALL SELECT n_nationkey, n_name FROM nation")
def table_appended(spark, folder):
    name = temporary_table(spark, "append")
    append_rows(table(spark, folder, "region"), name)
    append_rows(table(spark, folder, "nation").select(F.col("n_nationkey").alias("r_regionkey"), F.col("n_name").alias("r_name")), name)
    return spark.table(name)


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY 1")
def parquet_and_json_written(spark, folder):
    """Counts per brand through a Parquet folder, JSON lines and the driver."""
    path = Scratch(spark).path
    write_parquet(table(spark, folder, "part"), f"{path}/part")
    write_json_lines(spark.read.parquet(f"{path}/part").groupBy("p_brand").agg(F.count("*").alias("n")), f"{path}/brands")
    brands = spark.read.schema("p_brand string, n long").json(f"{path}/brands")
    return spark.createDataFrame(to_driver(brands, 10_000), "p_brand string, n long")


@query("SELECT count(*) AS n, 1 AS reads, 'SPARK' AS system_type, 'batch' AS reader FROM supplier")
def read_with_lineage(spark, folder):
    """Rows of a table, and the record of its read."""
    name, log = temporary_table(spark, "read"), temporary_table(spark, "lineage")
    overwrite_table(table(spark, folder, "supplier"), name)
    rows = read_table(spark, name, lineage_table=log).agg(F.count("*").alias("n"))
    reads = spark.table(log).where(F.col("source_table") == name).groupBy("system_type", F.col("properties")["reader"].alias("reader"))
    return rows.crossJoin(reads.agg(F.count("*").cast("int").alias("reads")))  # one row each


_SIDES = "200 + page_id % 700 AS w, 300 + page_id % 500 AS h"


@query(
    f"""WITH p AS (SELECT {_SIDES}, regexp_extract(url, '/(en|de|fr|es)/', 1) AS label FROM pages)
        SELECT label, count(*) AS cnt FROM p WHERE w >= 400 AND h >= 400 GROUP BY 1"""
)
def image_stream_counts(spark, folder):
    """Image files with a header per page, ingested as a stream in two runs; large ones per label."""
    path = Scratch(spark).path
    pages = table(spark, folder, "pages").selectExpr("url", "page_id", *_SIDES.split(", "))
    number = lambda c: F.lpad(F.hex(c), 8, "0")
    content = F.unhex(F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), number("w"), number("h"), F.lit("0802000000")))
    files = pages.select(
        F.concat(F.lit("flower_photos/"), F.regexp_extract("url", "/(en|de|fr|es)/", 1), F.lit("/"), "page_id", F.lit(".png")).alias("path"),
        content.alias("content"), (F.col("page_id") % 2).alias("run"),
    )
    for run in (0, 1):
        files.where(F.col("run") == run).drop("run").write.mode("append").parquet(f"{path}/arriving")
        stream = spark.readStream.schema("path string, content binary").parquet(f"{path}/arriving")
        append_stream(image_rows(stream), f"{path}/images", f"{path}/progress").awaitTermination()
    return label_counts(spark.read.parquet(f"{path}/images"))


@query("SELECT event_type, count(*) AS n, max(event_id) AS last_id FROM events GROUP BY 1")
def event_stream_appended(spark, folder):
    """Events that arrive in two parts, appended by a stream to a table, each once."""
    path, name = Scratch(spark).path, temporary_table(spark, "stream")
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    for part in (0, 1):
        events.where(F.col("event_id") % 2 == part).write.mode("append").parquet(f"{path}/arriving")
        stream = spark.readStream.schema(events.schema).parquet(f"{path}/arriving")
        append_stream(stream, name, f"{path}/progress", table=True).awaitTermination()
    return spark.table(name).groupBy("event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last_id"))


@query(
    """WITH means AS (SELECT label, list(m ORDER BY i) AS query FROM
                      (SELECT label, i, avg(embedding[i]::DOUBLE) AS m FROM embeddings, range(1, 65) t(i) GROUP BY 1, 2) GROUP BY 1),
            hits AS (SELECT q.label::BIGINT AS query_id, v.vec_id AS id,
                            list_sum(list_transform(range(1, 65), lambda i: (v.embedding[i]::DOUBLE - q.query[i]) ** 2)) AS distance
                     FROM means q, embeddings v)
       SELECT query_id, id, round(distance, 6) AS distance, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank
       FROM hits QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, id) <= 10"""
)
def index_synced_from_stream(spark, folder):
    """An index of half of the vectors in wrong places; a stream brings the right ones and the other half."""
    path = Scratch(spark).path
    rows = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    wrong = rows.where("id % 2 = 0").withColumn("vector", F.reverse("vector"))
    index = ivf_build(wrong, f"{path}/index", centroids=_label_cells(spark, folder))
    rows.withColumn("version", F.lit(1).cast("long")).write.parquet(f"{path}/changes")
    changes = spark.readStream.schema("id long, vector array<float>, version long").parquet(f"{path}/changes")
    sync_index(changes, index, f"{path}/progress").awaitTermination()
    return _rounded(ivf_search(_means(spark, folder), index, 10, nprobe=10))


@query(
    """WITH means AS (SELECT label, list(m ORDER BY i) AS query FROM
                      (SELECT label, i, avg(embedding[i]::DOUBLE) AS m FROM embeddings, range(1, 65) t(i) GROUP BY 1, 2) GROUP BY 1),
            hits AS (SELECT q.label::BIGINT AS query_id, v.vec_id AS id,
                            list_sum(list_transform(range(1, 65), lambda i: (v.embedding[i]::DOUBLE - q.query[i]) ** 2)) AS distance
                     FROM means q, embeddings v WHERE v.vec_id % 5 <> 1)
       SELECT query_id, id, round(distance, 6) AS distance, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank
       FROM hits QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, id) <= 10"""
)
def index_versions_out_of_order(spark, folder):
    """Three batches out of order: the newest rows and the deletion of a fifth come first, then two that are late.

    The index is compacted between the late ones, which bring wrong places for all ids and undo deletions in vain.
    """
    path = Scratch(spark).path
    rows = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    wrong = rows.withColumn("vector", F.reverse("vector"))
    index = ivf_build(wrong.where("id % 2 = 0"), f"{path}/index", centroids=_label_cells(spark, folder))
    batches = [
        rows.withColumns({"version": F.lit(9).cast("long"), "gone": F.col("id") % 5 == 1}),
        wrong.withColumns({"version": F.lit(3).cast("long"), "gone": F.lit(False)}),
        wrong.where("id % 3 = 0").withColumns({"version": F.lit(5).cast("long"), "gone": F.col("id") % 2 == 0}),
    ]
    for number, batch in enumerate(batches):
        if number == 2:  # the new index has a stream of its own
            index = compact_index(index, f"{path}/compacted")
        arriving, progress = f"{index.path}-changes", f"{index.path}-progress"
        batch.write.mode("append").parquet(arriving)
        changes = spark.readStream.schema(batch.schema).parquet(arriving)
        sync_index(changes, index, progress, deleted="gone").awaitTermination()
    return _rounded(ivf_search(_means(spark, folder), index, 10, nprobe=10))
