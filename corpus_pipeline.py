"""The corpus pipeline over ``documents``: five stages, each over all that the one before has kept.

1. quality rules: texts that fail the hard limits or lie far from their language and source go;
2. n-gram Jaccard join: the document with the smallest id of each group of near copies stays;
3. benchmark decontamination: documents with a verified overlap with a benchmark item go;
4. mixing: documents are drawn so that tokens match the target shares of sources, languages and forms;
5. sharding: the rest is dealt to shards that all match the mixture.

The first four return the columns of documents, the last one the place of every document.

A stage's result is written before the next stage begins, so the next one deletes what the stage had written on its way.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from climaflow.llm import common, decontaminate, jaccard_join, mixing, quality_rules, sharding
from climaflow.session import run_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Folders that the stage before has written on its way.
_left: list[str] = []


def _after(last: Stage | None) -> Callable[[Stage], Stage]:
    """A stage that comes after ``last``, whose result has been written and read again by then."""
    def wrap(stage: Stage) -> Stage:
        @wraps(stage)
        def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            if last is not None:
                common.delete(spark, *_left)
            _left.clear()
            with common.collecting() as made:
                result = stage(spark, docs, sf_dir)
            _left.extend(made)
            return result
        return run
    return wrap


@_after(None)
def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep(docs)


@_after(good_documents)
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


@_after(one_of_each_group)
def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_after(clean_documents)
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sample(docs)


@_after(mixture)
def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.assign(docs)


STAGES = [
    ("quality_rules", good_documents),
    ("ngram_jaccard", one_of_each_group),
    ("decontamination", clean_documents),
    ("mixing", mixture),
    ("sharding", shards),
]

# Robust estimates, hashes and raking have no SQL form; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage returns is written as Parquet and read again by the next one."""
    folder = run_dir(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = []
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}.parquet")
        docs = spark.read.parquet(f"{folder}/{name}.parquet")
        common.delete(spark, *before)
        before = [f"{folder}/{name}.parquet"]
    return STAGES[-1][1](spark, docs, sf_dir)
