"""Cleans, mixes and encodes a document table: each stage is one operator of ``entityflow.llm``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityflow.llm import decontamination, mixing, simhash, token_planes, toxicity
from entityflow.llm.queries import END_ID, MIX_CAP, MIX_SHARE, MIX_WEIGHTS, table, toxicity_model
from entityflow.session import work_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of one half or more go."""
    return toxicity.reject(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id: four-word shingles, at most 4 differing bits."""
    return simhash.one_per_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark passage go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them, shuffled within shards."""
    return mixing.mix(docs, MIX_WEIGHTS, MIX_SHARE, MIX_CAP)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all rows in the binary format; a row per document as read back from it."""
    path = work_path(spark, "tokens")
    token_planes.write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID, path)
    return token_planes.read_tokens(spark, path).select(F.col("id").alias("doc_id"), "start", "n_tokens", F.col("crc32").alias("ids_crc32"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token ids", write_tokens),
]

# Several stages have no SQL form; tests/llm compares every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Each stage's rows are written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        place = work_path(spark, f"stage-{number}")
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return docs
