"""A corpus pipeline of five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes what a
stage returns as Parquet below the shared scratch folder and hands the next stage what
it reads back, so a stage never depends on the lineage of those before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlight.llm import decontaminate, jaccard, packing, personal, quality
from harborlight.llm.common import read_table, stored
from harborlight.llm.queries import WINDOW, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality rule go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words, similarity 0.8."""
    return jaccard.keep_one(docs, length=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by marks; the number of characters follows."""
    redacted = personal.redact(docs)
    return redacted.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of at most 2048 ids, with the ids."""
    pieces = packing.token_pieces(docs, tokenizer_path(), WINDOW)
    # pieces carry their ids here, some kilobytes each, so shards hold fewer of them
    return packing.pack(pieces, packing.most_pieces(docs, WINDOW), WINDOW, shard_pieces=8_000)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("personal data", personal_data),
    ("packing", pack),
]

#: token ids and near duplicates cannot be expressed in SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
