"""Documents through five stages: language identification, near-duplicate removal, removal of repeated passages, a mix of
sources to target weights, and packing into token windows.

Every stage reads what the stage before it kept; all but the last return the columns of ``documents``. Stages that choose
among documents tell rows with a null or repeated ``doc_id`` apart by their content, equal rows by number. Null and empty
texts leave at the first stage, an empty table passes through all.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleet.llm import langid, mixing, neardup, packing, queries, suffixes
from fleet.llm.common import given_ids, shared_folder, small_batches, unique_ids
from fleet.operators.keys import join_on
from fleet.scratch import Scratch
from fleet.session import ship_package


def _alone(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that sets up its session, since stages are also called one by one."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@_alone
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, and those unlike their language at their length. ``lang`` stays as given."""
    prototypes = langid.train_prototypes(docs, queries.SEED)
    if not prototypes:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return langid.in_known_language(docs, prototypes, langid.usual_likeness(docs, prototypes, queries.SEED), queries.SEED)


@_alone
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component on five-word shingles at 0.8: the one with the smallest id."""
    named = unique_ids(docs)
    found = neardup.near_duplicates(named.select("doc_id", "text"), 5, 80)
    gone = Scratch(spark).store(found.where("NOT kept").select("doc_id"), "gone")
    return given_ids(named.join(_measured(gone), "doc_id", "left_anti"), docs.columns)


def _measured(ids: DataFrame) -> DataFrame:
    """Ids to be broadcast if there are few; more of them meet the texts in a shuffled join."""
    return F.broadcast(ids) if ids.count() <= neardup.BROADCAST_IDS else ids


@_alone
def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out passages of 100 bytes that occur earlier; documents of which nothing but white space stays go."""
    cut = suffixes.without_repeats(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.where(F.regexp_like("text", F.lit(mixing.WORD))).select(*docs.columns)


@_alone
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    named = unique_ids(docs)
    times = mixing.mix(named, queries.MIX_WEIGHTS, queries.MIX_SHARE, queries.MIX_LIMIT, queries.SEED).select("doc_id", F.col("times").alias("_fl_times"))
    joined = join_on(named, times, ["doc_id"]).where("_fl_times > 0")
    return given_ids(joined.withColumn("_fl_copy", F.explode(F.sequence(F.lit(1), F.col("_fl_times").cast("int")))), docs.columns)


@_alone
def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 1024 tokens."""
    return packing.pack(packing.cut_pieces(docs, public_tokenizers.path(queries.BPE), 0, queries.WINDOW), queries.WINDOW)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", remove_repeats),
    ("source_mix", mix_sources),
    ("packing", pack_windows),
]

#: Language vectors, shingles and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = shared_folder(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
