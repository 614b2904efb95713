"""Corpus pipeline: quality rules, line dedup, near-dedup, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. All stages but the last
return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamelake.llm import line_dedup, minhash, mixing, packing, quality
from gamelake.llm.tables import table, written

#: Most epochs of any source in the mix; every document passes at least once.
MAX_REPEATS = 1.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated and near-repeated lines go, and n_chars follows; so do documents
    all of whose lines stand elsewhere, equal or within two edits. Texts that held no word stay as they are."""
    done = line_dedup.dedup_lines(docs, direct=True)
    emptied = (F.col("n_removed") > 0) & ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return (done.filter(~emptied).withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
            .select(*docs.columns))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, 0.8) stays."""
    return minhash.keep_one(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources move towards equal weights; documents of scarce sources come again in a second epoch."""
    return mixing.mix(docs, max_repeats=MAX_REPEATS).select(*docs.columns)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), added=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_deduplication),
    ("minhash_near_dedup", near_deduplication),
    ("source_mixing", source_mixing),
    ("packing", sequence_packing),
]

#: Stages hold models and tokenizers that SQL cannot express; tests check them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
