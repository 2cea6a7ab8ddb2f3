"""A training corpus from raw documents: five stages, each over all that the one before kept.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read
again as the next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessaria.llm import exact_dedup, mixing, packing, quality, simhash
from tessaria.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled rows, does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, but for the case of A-Z, the one with the largest id."""
    return exact_dedup.drop_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (five-word shingles alike to 0.8 or more) the one with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: any prefix of the files holds the sources at their target weights.

    The source column carries these weights to the next stage.
    """
    weights = mixing.target_weights(docs)
    return mixing.with_targets(mixing.mixed_order(docs, weights=weights), weights)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 4096 tokens at the weights that the mix left with them, each source's in the order of its rows."""
    return packing.pack(docs, packing.tokenizer_path(), weights=mixing.targets(docs), in_order=True)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("SimHash near-dedup", near_stage),
    ("mixing sources to target weights", mix_stage),
    ("packing", pack_stage),
]

#: Classifier and fingerprints have no form in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
