"""From raw documents to packed training sequences: five stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topictide.llm import exact_dedup, jaccard_join, mixing, packing
from topictide.llm import quality_classifier as quality
from topictide.llm.common import table
from topictide.session import remove, scratch, work_path

# Targets as in the registered query, but every document at most once and a tenth of the tokens left out.
MIXTURE = mixing.Mixture(mixing.PRODUCTION.weights, max_epochs=1)
TOKEN_SHARE = 0.9


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, does not reject."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(model.score(F.col("text")) >= quality.THRESHOLD)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of all documents with an equal text: that with the largest id."""
    return exact_dedup.drop_copies(docs, keep="max")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return jaccard_join.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the weights of domains, languages and sources leave in."""
    return mixing.mix(docs, MIXTURE, share=TOKEN_SHARE).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in a training sequence."""
    pieces = packing.cut_documents(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(pieces)


STAGES = [
    ("quality_classifier", filter_quality),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# Scores, chosen paths and packing have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. A stage's own tables go when it is written, its predecessor's when the next one is."""
    docs, paths = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        paths.append(work_path(spark, f"pipeline-{name}"))
        with scratch(spark, name):
            stage(spark, docs, sf_dir).write.parquet(paths[-1])
        docs = spark.read.parquet(paths[-1])
        for old in paths[:-1]:
            remove(spark, old)
        paths = paths[-1:]
    return docs
