"""A corpus pipeline: each stage's result is written and is the next one's input.

Rows that are rejected as toxic go, one document of each group of near copies stays, contaminated
documents go, sources are mixed to their target weights (a document stands there as often as the mix
takes it), and every row that is left gets its shard.

All stages but the last return the columns of their input, whatever further columns it has and whatever
their names. Each handles null ids, texts and sources, empty and very long texts, repeated rows and empty
tables; what each case gives is said below and in the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dispatchlake.llm import decontaminate, mixing, sharding, shared, similar_sets, toxicity

#: Near copies of the pipeline share at least so many percent of their shingles of five words; op5 has its own bounds.
SHINGLE = 5
PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the classifier, learnt from `docs` and the labels that are not held out, does not predict to
    be toxic. Null and empty texts have the intercept's score; without labels every row stays."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: of the smallest id, null ids last. Of rows equal in id and text one
    stays; rows without words (null texts too) are no copies of one another and stay."""
    return similar_sets.drop_similar(docs, SHINGLE, PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of which less than a twentieth of the words repeats the benchmark; null and empty texts stay."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it: rows without words never, others up to three times. The null source
    is the last one; rows that are equal are taken one by one."""
    return mixing.apply_mix(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with slot and shard; rows without an id have those of the empty key, repeated rows the same."""
    return sharding.place(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

#: Trained weights decide in the first stage: SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of documents after all stages."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = shared.saved(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            shared.forget(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
