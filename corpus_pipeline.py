"""A training corpus out of raw documents: five stages, each one operator over all that the stage
before has kept.  Every stage's result is a Parquet table in the shared folder, so a lost executor
costs one stage's tasks at most.

toxicity          documents that the machine rejects go
near_duplicates   one document of each group of near copies stays (similarity 0.85 on word 5-shingles)
decontamination   documents in which a benchmark item occurs go
mixing            leaves of the domain-language-source tree are cut or repeated to their budgets
sharding          every record gets its shard by the edited slot map, whose newest version is kept
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerkit.llm import decontamination, mixing, neardup, sharding, toxicity
from ledgerkit.llm.common import read, written


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.not_toxic(docs, toxicity.fit_table(docs, read(spark, sf_dir, "labels")))


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs)


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def stage_sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs, map_path=sharding.map_path(spark, "pipeline", sf_dir))


STAGES = [("toxicity", stage_toxicity), ("near_duplicates", stage_near_duplicates),
          ("decontamination", stage_decontamination), ("mixing", stage_mixing), ("sharding", stage_sharding)]

#: The machine, the banding and the edit distance have no SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
