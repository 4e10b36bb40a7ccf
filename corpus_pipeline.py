"""The corpus pipeline: each stage reads the documents that its predecessor wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from runweave.llm import mixing, near_dups, packing, paragraphs, toxicity
from runweave.llm.encoding import vocabulary
from runweave.llm.store import Workspace

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Stages fit a classifier and work on hashes and tokens, which SQL can't express.
ORACLE_SQL = None


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs.select(COLUMNS), labels)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity of at least 0.8)."""
    return near_dups.keep_one(docs).select(COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out."""
    return paragraphs.without_passages(docs).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of three quarters of the tokens whose sources, languages and topics have slightly tempered shares."""
    return mixing.mixed(docs, power=0.9, kept_share=0.75).where("kept").select(COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 1024 tokens."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("toxicity", toxic_out), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("mixing", mix_sources), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.keep(stage(spark, docs, sf_dir), name)
    return docs
