"""A training-data pipeline over ``documents``: five stages, each written as
Parquet and reread as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from entiscore.llm import decontamination, jaccard, mixing, sharding, toxicity
from entiscore.llm.tables import shielded, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs, labels)
    return shielded(docs, ("doc_id", "text"), lambda d: toxicity.score(d, model).filter("predicted = 0"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts: five-word shingles, Jaccard similarity of 0.8 or more."""
    return jaccard.keep_one(docs, k=5, num=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, up to a tenth of its words edited."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontamination.clean(docs, items, least_words=1)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The uses of documents that the mix takes, a row each with its whole text; the next stage
    orders by text, so the curriculum decides how often a document is used, not where."""
    return shielded(docs, ("doc_id", "text", "source", "n_chars"), lambda d: mixing.training_order(mixing.mix(d), whole=True))


def into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows in 24 shards of the smallest feasible capacity."""
    return sharding.shard(docs, 24)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", into_shards),
]

# A trained classifier and edit matching are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table; the last one's result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
