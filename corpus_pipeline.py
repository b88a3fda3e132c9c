"""The corpus pipeline: toxic documents go, one document of each near-duplicate group stays,
repeated passages are cut out, sources are mixed to target weights, and the rest is tokenized."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fabula.llm import chunk_dedup, ngram_jaccard, temperature, toxicity, trie_bpe
from fabula.llm.scratch import written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that score below the toxic threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.clean(docs, toxicity.fit(docs, labels))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest doc_id of each component; documents without id or words stay."""
    gone = ngram_jaccard.jaccard_components(docs).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out passages that a document of a smaller doc_id holds too."""
    return chunk_dedup.deduplicated(docs)


def in_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and those of underweight sources again until the weights are met."""
    return temperature.remixed(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    return trie_bpe.trie_bpe(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("n-gram Jaccard join", without_near_copies),
    ("substring dedup", without_passages),
    ("mixing sources to target weights", in_target_weights),
    ("BPE encoding and decoding", tokenized),
]

#: Toxicity is fitted and tokens come from a vocabulary; SQL can express neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage{k}")
    return docs
