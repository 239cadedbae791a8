"""Reads, projections, filters, joins, splits and shards."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleet.functions.names import as_path, composite_key, label_from_path, last_part, lineage_time, numbered_name, run_date
from fleet.operators.keys import group_key_check, key_product, not_yet_written
from fleet.operators.scans import global_ordinal
from fleet.operators.splits import sample_rows, split_hashed, split_ordered
from fleet.operators.tensors import positional_join
from fleet.plans.vector import shard_vectors
from fleet.queries.registry import query, sql_uniform, table
from fleet.scratch import Scratch
from fleet.sources.sinks import write_shards
from fleet.sources.tables import group_rows, read_query, read_table, read_with_fallback


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def table_read(spark, folder):
    table(spark, folder, "orders").createOrReplaceTempView("fleet_orders")
    return read_table(spark, "fleet_orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


@query("SELECT p_partkey, p_brand, p_size FROM part")
def read_fallback(spark, folder):
    return read_with_fallback(spark, "no_such_schema.part", f"{folder}/part.parquet").select("p_partkey", "p_brand", "p_size")


@query(
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000"
)
def sql_filter(spark, folder):
    return read_query(
        spark,
        "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} WHERE o_orderstatus = 'F' AND o_totalprice > 200000",
        orders=table(spark, folder, "orders"),
    )


@query(
    """SELECT n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"""
)
def sql_join(spark, folder):
    return read_query(
        spark,
        """SELECT n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total
           FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
           GROUP BY n_name""",
        orders=table(spark, folder, "orders"),
        customer=table(spark, folder, "customer"),
        nation=table(spark, folder, "nation"),
    )


@query(
    """SELECT o_orderpriority, count(*) AS orders, count(DISTINCT o_custkey) AS customers,
              round(avg(o_totalprice), 4) AS mean_price
       FROM orders GROUP BY o_orderpriority"""
)
def sql_agg(spark, folder):
    return read_query(
        spark,
        """SELECT o_orderpriority, count(*) AS orders, count(DISTINCT o_custkey) AS customers,
                  round(avg(o_totalprice), 4) AS mean_price
           FROM {orders} GROUP BY o_orderpriority""",
        orders=table(spark, folder, "orders"),
    )


@query("SELECT l_orderkey, l_linenumber, l_quantity AS y FROM lineitem WHERE l_returnflag = 'R'")
def group_point_read(spark, folder):
    rows = group_rows(table(spark, folder, "lineitem"), l_returnflag="R")
    return rows.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("y"))


@query(
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'O'"
)
def two_key_filter(spark, folder):
    rows = group_rows(table(spark, folder, "lineitem"), l_returnflag="N", l_linestatus="O")
    return rows.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    """SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) AS n, round(sum(l_extendedprice), 2) AS total
       FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1998-01-01' GROUP BY 1"""
)
def range_filter(spark, folder):
    ship = F.col("l_shipdate")
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("1996-01-01", "1998-01-01"))
    rows = table(spark, folder, "lineitem").where((ship >= low) & (ship < high))
    return rows.groupBy(F.date_format(ship, "yyyy-MM").alias("month")).agg(
        F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total")
    )


@query(
    """SELECT CAST(o_orderdate AS DATE) AS ds, o_totalprice AS y, o_orderpriority AS group_name, 'orders' AS origin
       FROM orders"""
)
def project_rename(spark, folder):
    rows = table(spark, folder, "orders").drop("o_orderkey", "o_custkey", "o_orderstatus")
    renamed = rows.withColumnsRenamed({"o_orderdate": "ds", "o_totalprice": "y", "o_orderpriority": "group_name"})
    return renamed.withColumn("ds", F.col("ds").cast("date")).withColumn("origin", F.lit("orders"))


@query(
    """SELECT count(*) AS rows_all, count(*) FILTER (o_orderstatus = 'F') AS rows_f,
              CAST(ceil(count(*) / 1000.0) AS BIGINT) AS shards FROM orders"""
)
def row_counts(spark, folder):
    return table(spark, folder, "orders").agg(
        F.count("*").alias("rows_all"),
        F.count_if(F.col("o_orderstatus") == "F").alias("rows_f"),
        F.ceil(F.count("*") / F.lit(1000.0)).alias("shards"),
    )


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def ordered_limit(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return rows.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(100)


@query("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct_groups(spark, folder):
    return table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@query("SELECT * FROM (SELECT DISTINCT p_brand FROM part) CROSS JOIN (SELECT DISTINCT p_type FROM part)")
def key_cross_product(spark, folder):
    part = table(spark, folder, "part")
    return key_product(part.select("p_brand"), part.select("p_type"))


@query(
    """SELECT l_suppkey, count(*) AS parts FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) GROUP BY l_suppkey"""
)
def dedup_keys(spark, folder):
    pairs = table(spark, folder, "lineitem").select("l_suppkey", "l_partkey").dropDuplicates(["l_suppkey", "l_partkey"])
    return pairs.groupBy("l_suppkey").agg(F.count("*").alias("parts"))


@query(
    """SELECT l_orderkey, concat_ws(',', CASE WHEN a <> 1 THEN 'l_returnflag' END, CASE WHEN b <> 1 THEN 'l_linestatus' END)
              AS bad_columns
       FROM (SELECT l_orderkey, count(DISTINCT l_returnflag) AS a, count(DISTINCT l_linestatus) AS b
             FROM lineitem GROUP BY l_orderkey) WHERE a <> 1 OR b <> 1"""
)
def group_check(spark, folder):
    return group_key_check(table(spark, folder, "lineitem"), ["l_orderkey"], ["l_returnflag", "l_linestatus"])


@query(
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS ordinal FROM orders"""
)
def dense_ordinal(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return global_ordinal(rows, [F.col("o_totalprice").desc(), "o_orderkey"]).select("o_orderkey", "ordinal")


@query(
    """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderkey) <= floor(0.75 * (SELECT count(*) FROM orders))
              THEN 'train' ELSE 'val' END AS part FROM orders"""
)
def ordered_split(spark, folder):
    return split_ordered(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"], 0.25)


@query(f"SELECT o_orderkey, CASE WHEN {sql_uniform(42, 'o_orderkey')} < 0.3 THEN 'val' ELSE 'train' END AS part FROM orders")
def hashed_split(spark, folder):
    return split_hashed(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"], 0.3)


@query(
    f"""SELECT c_mktsegment, part, count(*) AS n FROM (SELECT c_mktsegment,
          CASE WHEN {sql_uniform(42, 'c_mktsegment', 'c_custkey')} < 0.25 THEN 'val' ELSE 'train' END AS part FROM customer)
        GROUP BY 1, 2"""
)
def group_split(spark, folder):
    rows = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    parts = split_hashed(rows, ["c_mktsegment", "c_custkey"], 0.25)
    return parts.groupBy("c_mktsegment", "part").agg(F.count("*").alias("n"))


@query(
    f"""SELECT o_orderkey, o_totalprice FROM orders WHERE {sql_uniform(42, 'o_orderkey')} < 0.1
        ORDER BY {sql_uniform(42, 'o_orderkey')}, o_orderkey LIMIT 1000"""
)
def sample_limit(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return sample_rows(rows, ["o_orderkey"], 0.1, 1000)


@query("SELECT count(*) AS n, count(*) AS ids FROM lineitem")
def row_ids(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey").withColumn("id", F.monotonically_increasing_id())
    ids = rows.groupBy("id").agg(F.count("*").alias("_n"))
    return ids.agg(F.sum("_n").alias("n"), F.count("*").alias("ids"))


@query(
    """SELECT shard, count(*) AS n, min(vec_id) AS first_id, max(vec_id) AS last_id FROM
       (SELECT vec_id, CAST((row_number() OVER (ORDER BY vec_id) - 1) // 128 AS BIGINT) AS shard FROM embeddings) GROUP BY shard"""
)
def shard_counts(spark, folder):
    shards = shard_vectors(table(spark, folder, "embeddings").select("vec_id", "embedding"), 128, "vec_id")
    target = f"{Scratch(spark).path}/shards"
    write_shards(shards, target)
    stored = spark.read.schema(shards.schema).parquet(target)
    return stored.groupBy("shard").agg(
        F.count("*").alias("n"), F.min("vec_id").alias("first_id"), F.max("vec_id").alias("last_id")
    )


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def anti_existing(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    seen = table(spark, folder, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return not_yet_written(customers, seen, ["c_custkey"])


@query(
    """SELECT o_orderkey, c_custkey, coalesce(a.i, b.i) AS ordinal
       FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS i FROM orders) a
       FULL JOIN (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) - 1 AS i FROM customer) b ON a.i = b.i"""
)
def position_pairs(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    joined = positional_join(orders, customers, ["o_totalprice", "o_orderkey"], [F.col("c_acctbal").desc(), "c_custkey"])
    return joined.select("o_orderkey", "c_custkey", "ordinal")


@query(
    """SELECT l_returnflag AS name, round(sum(l_quantity), 2) AS total FROM lineitem GROUP BY 1
       UNION ALL SELECT o_orderpriority, round(sum(o_totalprice), 2) FROM orders GROUP BY 1"""
)
def concat_results(spark, folder):
    lines = table(spark, folder, "lineitem").groupBy(F.col("l_returnflag").alias("name"))
    orders = table(spark, folder, "orders").groupBy(F.col("o_orderpriority").alias("name"))
    first = lines.agg(F.round(F.sum("l_quantity"), 2).alias("total"))
    return first.unionByName(orders.agg(F.round(F.sum("o_totalprice"), 2).alias("total")))


@query(
    """SELECT p_brand, count(*) AS cnt FROM part WHERE p_size >= 20 AND p_retailprice >= 950 GROUP BY p_brand ORDER BY cnt, p_brand"""
)
def struct_filter_count(spark, folder):
    shapes = table(spark, folder, "part").select(
        "p_brand", F.struct(F.col("p_size").alias("width"), F.col("p_retailprice").alias("height")).alias("size")
    )
    large = shapes.where((F.col("size.width") >= 20) & (F.col("size.height") >= 950))
    return large.groupBy("p_brand").agg(F.count("*").alias("cnt")).orderBy("cnt", "p_brand")


@query("SELECT page_id, regexp_extract(url, 'https?://[^/]+/([^/?#]+)', 1) AS label FROM pages")
def path_label(spark, folder):
    return table(spark, folder, "pages").select("page_id", label_from_path("url", "https?://[^/]+/([^/?#]+)").alias("label"))


@query(
    """SELECT page_id, list_extract(string_split(host, '.'), -1) AS last, replace(host, '.', '/') AS path
       FROM (SELECT page_id, regexp_extract(url, 'https?://([^/]+)', 1) AS host FROM pages)"""
)
def name_parts(spark, folder):
    hosts = table(spark, folder, "pages").select("page_id", F.regexp_extract("url", "https?://([^/]+)", 1).alias("host"))
    return hosts.select("page_id", last_part(F.col("host")).alias("last"), as_path(F.col("host")).alias("path"))


@query(
    """SELECT l_returnflag || '_' || l_linestatus || '_' || l_linenumber AS combo, count(*) AS n FROM lineitem GROUP BY 1"""
)
def composite_keys(spark, folder):
    combo = composite_key("l_returnflag", "l_linestatus", "l_linenumber").alias("combo")
    return table(spark, folder, "lineitem").groupBy(combo).agg(F.count("*").alias("n"))


@query(
    """SELECT p_partkey, 'group_' || CASE WHEN p_partkey + 1 < 10 THEN '0' ELSE '' END || (p_partkey + 1) AS group_name FROM part"""
)
def numbered_names(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", numbered_name("group_", F.col("p_partkey") + 1).alias("group_name")
    )


@query("SELECT event_id, strftime(ts, '%y%m%d') AS day, strftime(ts, '%Y%m%dT%H%M%SZ') AS stamp FROM events")
def date_formats(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", run_date(F.col("ts")).alias("day"), lineage_time(F.col("ts")).alias("stamp")
    )


@query(
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day,
              CAST(trunc(-l_extendedprice / 7) AS INTEGER) AS cut, CAST(CAST(l_discount AS FLOAT) AS DOUBLE) AS narrow
       FROM lineitem"""
)
def casts(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_shipdate").cast("date").cast("string").alias("day"),
        (-F.col("l_extendedprice") / 7).cast("int").alias("cut"),
        F.col("l_discount").cast("float").cast("double").alias("narrow"),
    )
