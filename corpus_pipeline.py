"""The corpus pipeline: each stage writes its rows before the next one reads them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.llm import classifier, line_dedup, mixing, near_dup, pieces
from fleetlake.llm.common import documents, free_name, labels, scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier keeps; it is fitted on the rated ones among ``docs``."""
    model = classifier.fit(docs, classifier.graded(labels(spark, sf_dir)))
    return classifier.keep_good(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without their repeated lines."""
    return line_dedup.dedup_lines(docs).select(docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the smallest ``doc_id``."""
    return near_dup.keep_one(docs)


# The least budget that loses no document: the source with the highest share for its weight is used
# once, the others up to twice.
MIX = mixing.Mix(target_entropy=0.9, max_repeats=2.0, budget=None)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the source weights ask for; none is lost."""
    return mixing.mix_documents(docs, MIX)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every use of a document, and the hash of the text they decode to; uses differ in their dropout."""
    use = free_name(docs, "_use")
    # The uses of a document are equal rows, so any order among them gives the same result.
    equal = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("doc_id")
    return pieces.encode_and_check(docs.withColumn(use, F.row_number().over(equal) - 1), use=use)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", encoded),
]

# Fitted models, sketches and tokens have no SQL form; brute-force tests cover the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
