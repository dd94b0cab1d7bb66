"""Tables of a run, and connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import work_dir

#: Rows of a few numbers that may be sent to every executor; more are shuffled.
SENDABLE_ROWS = 300_000


def sent_if_small(frame: DataFrame, limit: int = SENDABLE_ROWS) -> DataFrame:
    """A frame of narrow rows marked for a broadcast if counting shows it to be small."""
    return F.broadcast(frame) if frame.count() <= limit else frame


class Steps:
    """Tables of one run in the shared folder: each is written and read again."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.path, self.n = spark, work_dir(spark, purpose), 0

    def keep(self, frame: DataFrame) -> DataFrame:
        self.n += 1
        frame.write.parquet(f"{self.path}/{self.n}")
        return self.spark.read.parquet(f"{self.path}/{self.n}")


def components(steps: Steps, links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b); the least node names its component.

    Alternates two steps until the links form stars around the least nodes: each
    node sends its greater neighbours, then its lesser ones, to the least of
    them all. Both keep what is connected; the number of steps grows with the
    logarithm of the longest path.
    """
    edges = steps.keep(_downward(links))
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = steps.keep(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")))
        # The greater neighbours b of a, each linked to the least neighbour of a.
        large = edges.select(F.col("b").alias("a"), F.col("a").alias("far")).join(least, "a").select(
            F.col("far").alias("a"), F.col("least").alias("b"))
        edges = steps.keep(_downward(large))
        least = steps.keep(edges.groupBy("a").agg(F.min("b").alias("least")))
        small = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = steps.keep(_downward(small.unionByName(least.select("a", F.col("least").alias("b")))))
        before, state = state, _state(edges)
        if state == before:
            break
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return steps.keep(stars.unionByName(centres))


def _downward(links: DataFrame) -> DataFrame:
    """Distinct links with the greater node first; those of a node with itself go."""
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())
