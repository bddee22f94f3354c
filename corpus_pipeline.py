"""The training-data pipeline: stages over the documents table, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starling.llm import decontaminate, kn_quality, line_dedup, minhash, packing
from starling.llm.common import table


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model doesn't reject; trusted are those that the labels table rates good."""
    return kn_quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without cross-site boilerplate lines; documents that consist of it alone go."""
    return line_dedup.clean_documents(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the least doc_id) of each group of near-duplicates: five-word shingles, Jaccard of 0.8 or more."""
    return minhash.keep_one(docs, width=5, numerator=80, denominator=100)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window (or the whole of a shorter item) of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' tokens as pieces placed in sequences of 1024."""
    return packing.pack(docs)


STAGES = [("quality classifier", filter_quality), ("line dedup", dedup_lines), ("near-duplicates", dedup_documents),
          ("decontamination", drop_benchmark), ("packing", pack_sequences)]
# Language-model scores and tokens are beyond SQL. Tests compare near-duplicate components with brute force (the operator's);
# for the other stages they hold hand-made cases and invariants, and for all in a row that counts fall and columns stay.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder before the next reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = table(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
