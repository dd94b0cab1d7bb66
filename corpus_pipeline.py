"""The documents pipeline: each stage reads what the one before it wrote.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents. An empty table passes through every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, line_dedup, mixing, near_dups, toxicity
from tidemark.llm.columns import packed, unpacked
from tidemark.llm.graph import Steps
from tidemark.llm.shipping import ship


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    ship(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    clean = toxicity.scores(packed(docs), model).where(F.col("score") < toxicity.THRESHOLD)
    return unpacked(clean, docs)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the earliest of each group of equal or near lines; those left without a line go."""
    ship(spark)
    return line_dedup.deduped_documents(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the least id."""
    ship(spark)
    return near_dups.first_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the spans they share with test items; those that are mostly such spans go."""
    ship(spark)
    return decontamination.remove_spans(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the number of words it takes of each."""
    ship(spark)
    others = tuple(c for c in docs.columns if c != "doc_id")
    return mixing.mix(docs, keep=others).where("taken > 0")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
]

#: SQL expresses neither the language models nor the signatures.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read by the next."""
    steps = Steps(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = steps.keep(stage(spark, docs, sf_dir))
    return docs
