"""A training-corpus pipeline over ``documents``: quality rules, near-duplicate
removal, benchmark decontamination, pseudonyms for personal data, mixing.

Each stage is a function of (spark, docs, sf_dir) that calls one operator and
returns a DataFrame; ``run`` writes its result as Parquet in the shared scratch
folder and reads it again as the next stage's documents.  All stages but the
last return the columns of ``documents``; the last adds mix_epoch and
mix_block, with a row for each drawn copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillpoint.llm import decontaminate, minhash_dedup, mixing, pii, quality_rules
from tillpoint.llm.common import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and their host's verdict keep."""
    return quality_rules.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at five words and a similarity of 0.8."""
    return minhash_dedup.drop_near_duplicates(docs, shingle=5, num=80, den=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by pseudonyms."""
    return pii.pseudonymise(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, small sources up to about twice."""
    return mixing.mix(docs, repeat_limit=2.0)


STAGES = [("quality rules", quality), ("near duplicates", near_duplicates), ("decontamination", decontamination),
          ("pii", pseudonyms), ("mixing", mixture)]

#: sketches, spaced seeds and keyed permutations have no SQL form; the tests
#: compare the stages with plain Python versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage_" + name.replace(" ", "_"))
    return docs
