"""From raw documents to sharded training text: quality rules, near-duplicate
removal, benchmark decontamination, mixing by source, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's input. All but the last return
the columns of ``docs``. NULLs, empty texts and empty tables pass each stage as
its operator states; rows equal in doc_id and text are one document to the
second stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltgrid.llm import decontam, minhash, mixing, quality, sharding
from voltgrid.llm.common import documents, materialize

# Stages on word shingles link from this similarity on.
PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no rule."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest doc_id."""
    return minhash.keep_one(docs, percent=PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontam.remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate and its own coin say."""
    return mixing.mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix with slot and shard."""
    return sharding.assign(docs)


STAGES = [("quality rules", quality_rules), ("MinHash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("mixing sources", mixed), ("sharding", sharded)]

# Stages two and three are no SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
