"""The corpus pipeline: five stages over documents, each on all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. Rows with nulls,
empty texts, repeated rows and extra columns follow the definitions of the operators that the stages call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import quality as quality_model
from shelfspark.llm.common import hide, restore
from shelfspark.llm.decontaminate import contamination
from shelfspark.llm.mixing import mix_sources
from shelfspark.llm.near_dup import near_duplicates
from shelfspark.llm.ngrams import fold
from shelfspark.llm.registry import N_SHARDS, table
from shelfspark.llm.sharding import shard
from shelfspark.storage import delete, settled


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts as good; it is fitted on the labelled documents of the folds 1 to 4 of 5."""
    model = quality_model.train(docs, table(spark, sf_dir, "labels").filter(fold(F.col("doc_id"), 5) != 0))
    rows, names = hide(docs)
    return restore(quality_model.score(rows, model, names["text"]).filter("predicted = 1"), names)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8 or more): the one with the smallest id. Rows that
    repeat its id stay, too."""
    kept = near_duplicates(docs, words=5).filter("kept").select(F.col("doc_id").alias("__kept_id")).distinct()
    rows, names = hide(docs)
    return restore(rows.join(kept, F.col(names["doc_id"]).eqNullSafe(F.col("__kept_id")), "left_semi"), names)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark."""
    rows, names = hide(docs)
    return restore(contamination(rows, table(spark, sf_dir, "benchmark"), names["text"]).filter("NOT contaminated"), names)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    rows, names = hide(docs)
    mixed = mix_sources(rows, names["text"], names["source"], names["doc_id"]).filter("copies > 0")
    return restore(mixed.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))), names)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows with their shards."""
    return shard(docs, N_SHARDS)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing), ("sharding", sharding)]

#: SQL has neither the fitted classifier nor the similarity join; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Of the tables in between only the last stage's own and its input are left in shared storage, as the result reads them."""
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        given = docs
        docs, path = settled(spark, lambda stage=stage, given=given: stage(spark, given, sf_dir), name)
        if before is not None:
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
