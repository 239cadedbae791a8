"""The operators of this package applied to whole tables."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleet.llm import (
    chunks, langid, licenses, mixing, neardup, packing, prefix_trie, quality, records, sharding, spelling, suffixes, topk,
)
from fleet.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

BPE = "byte_bpe_50k.json"
SEED = 20_240_601


def query(sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, folder)

        QUERIES[fn.__name__] = run
        if sql:
            SQL[fn.__name__] = sql
        return run

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")


@query()
def op1_feistel_shards(spark: SparkSession, folder: str) -> DataFrame:
    """24 shards whose row counts differ by one at most."""
    thin = documents(spark, folder).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
    )
    placed = sharding.assign_shards(thin, 24, SEED, ["doc_id", "text_crc32", "size"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


MIX_WEIGHTS, MIX_SHARE, MIX_LIMIT = [3, 1, 2], Fraction(3, 2), 2


@query()
def op2_budget_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, folder), MIX_WEIGHTS, MIX_SHARE, MIX_LIMIT, SEED)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op3_framed_records(spark: SparkSession, folder: str) -> DataFrame:
    where, _ = records.write_records(documents(spark, folder), public_tokenizers.path(BPE), end_id=2)
    return records.record_checksums(spark, where)


WINDOW = 1024


@query()
def op8_sum_of_squares_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.cut_pieces(documents(spark, folder), public_tokenizers.path(BPE), 0, WINDOW)
    return packing.pack(pieces, WINDOW)


@query()
def op10_chunk_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.fingerprint_and_edit(documents(spark, folder))


@query()
def op5_hyperdimensional_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    prototypes = langid.train_prototypes(docs.where(~F.coalesce(held_out, F.lit(False))), SEED)
    thin = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    return langid.identify(thin, prototypes, SEED).drop("text")


#: Documents lie as files in a directory per source and language.
FILES_SQL = "SELECT doc_id, concat_ws('/', source, lang, CAST(doc_id AS VARCHAR) || '.txt') AS path, text FROM documents"


@query(licenses.scan_sql(FILES_SQL))
def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return licenses.scan(documents(spark, folder).select("doc_id", path.alias("path"), "text"))


@query()
def op6_chosen_path_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, folder), 4, 80)


@query()
def op9_suffix_array_removal(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.removal_report(documents(spark, folder))


@query()
def op4_kneser_ney_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(documents(spark, folder))


HEADS = 6


@query(prefix_trie.nodes_sql(100, HEADS))
def op11_zfast_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation with its first crc32(conv_id) % 6 turns taken from the first of its hundred."""
    turns = prefix_trie.turn_table(spark.read.parquet(f"{folder.rstrip('/')}/conversations.parquet"))
    head = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    nodes = prefix_trie.trie_nodes(prefix_trie.with_shared_heads(turns, 100, head, HEADS - 1))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@query(spelling.groups_sql())
def op12_kd_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variant_groups(spelling.noisy_words(documents(spark, folder)))


@query(topk.top_sql(50, 5, 256))
def op13_norm_bucket_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder.rstrip('/')}/embeddings.parquet")
    return topk.top_products(vectors, F.col("vec_id") % 50 == 0, 5)
