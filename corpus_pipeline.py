"""A corpus for training: from raw documents to a weighted mix, in stages that each write a table."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm.decontamination import find_contamination
from shelfwise.llm.line_dedup import dedup_lines
from shelfwise.llm.mixing import emit, mix
from shelfwise.llm.quality_classifier import importance
from shelfwise.llm.simhash_dedup import RADIUS, SHINGLE, drop_near_duplicates
from shelfwise.session import remove, scratch, scratch_path


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that importance resampling towards the trusted ones selects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return importance(docs, labels).where("selected").select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that many documents repeat, and their new lengths."""
    return dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return drop_near_duplicates(docs, SHINGLE, RADIUS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without benchmark passages."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_contamination(docs, benchmark).where(~F.col("contaminated")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy of a document that the mix takes."""
    return emit(mix(docs))


STAGES = [
    ("quality classifier", select_quality),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_similar),
    ("decontamination", drop_contaminated),
    ("source mixing", mix_sources),
]

#: Hashes of the third stage and the models of the first are beyond SQL; tests compare each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the stages; each one's table and scratch files go when the next one is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
