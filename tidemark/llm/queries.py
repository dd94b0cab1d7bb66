"""The operators with production parameters over their whole tables, and SQL where it can tell the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    centroids, decontamination, fill_middle, fingerprints, html_text, licenses, line_dedup, mixing, near_dups,
    token_counts, toxicity, url_filters, warc,
)
from tidemark.llm.shipping import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scores(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(toxicity.remainder() == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.digest(decontamination.matches(docs, table(spark, sf_dir, "benchmark")))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


@query
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op5_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.classes(table(spark, sf_dir, "documents"))


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


ORACLES["op9_mixing"] = mixing.ORACLE


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_kept", "text")


@query
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"))


@query
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(table(spark, sf_dir, "pages"))


@query
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(warc.archived(table(spark, sf_dir, "pages")))


ORACLES["op11_warc"] = warc.ORACLE


@query
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digest(fill_middle.rearranged(table(spark, sf_dir, "documents")))


ORACLES["op12_fill_middle"] = fill_middle.ORACLE


@query
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings"))


ORACLES["op13_centroids"] = centroids.ORACLE
