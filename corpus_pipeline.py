"""The corpus pipeline: quality, exact copies, near copies, benchmark leaks, mixture.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is written as Parquet and read
again as the next one's docs.  All stages but the last return the columns of ``documents``; the last adds the
words that the mixture takes of each document and the number of epochs that read it.

Edge cases, each tested: an empty table gives an empty one; columns beyond those of ``documents``, whatever their names, are kept as
they are, but for ``mix_words`` and ``mix_epochs``, which the last stage sets; repeated rows are judged alike; texts are read
whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from blockweave.llm import decontaminate, exact_dedup, jaccard_join, mixing, quality
from blockweave.llm.shared import small_batches, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; a null text is an empty one, and a score of 0.5 or more stays.  Without labels all stay."""
    small_batches(spark)
    return quality.keep_good(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, that of the least id, a null id last; null texts are empty ones."""
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays, that of the least id; rows with a null id, and texts without words, stay."""
    return jaccard_join.drop_near_copies(docs)


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose own text contains a benchmark item go, whatever their id; null and empty items are in nothing."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mixture takes, with words and epochs; texts without words pass with 0, a null source is a source."""
    return mixing.mixture(docs)


STAGES = [("quality", quality_stage), ("exact_dedup", exact_stage), ("near_dedup", near_stage), ("decontaminate", leak_stage), ("mix", mix_stage)]

#: The first stage's weights come from sequential training, which SQL can't express; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
