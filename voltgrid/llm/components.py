"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum (combined before the shuffle) and a join; no
neighbour list is gathered anywhere, so a node with very many neighbours is
spread by the skew-join handling. Each round is written to the shared
checkpoint folder, and each of its two steps on its own: the driver keeps
plans and task figures of every job, so plans are small and jobs few."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from voltgrid.llm.common import materialize, shuffled


def _large_star(edges: DataFrame) -> DataFrame:
    """Edges lead from larger to smaller nodes (a > b), before and after a step."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "b")
    return edges.join(shuffled(least), "b", "left").select("a", F.coalesce("m", "b").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    both = F.array(F.struct(F.col("a").alias("x"), F.col("m").alias("y")),
                   F.struct(F.col("b").alias("x"), F.col("m").alias("y")))
    return (edges.join(shuffled(least), "a").select(F.explode(both).alias("e")).where("e.x <> e.y")
            .select(F.col("e.x").alias("a"), F.col("e.y").alias("b")).distinct())


def _marked(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, written, with their count and a sum of their hashes."""
    seen = Observation()
    out = materialize(edges.observe(seen, F.count(F.lit(1)).alias("n"),
                                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hashes")), "edges")
    return out, (seen.get["n"], seen.get["hashes"])


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of ``edges`` (a, b;
    long, none NULL); nodes without an edge have no row."""
    now, mark = _marked(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct())
    while True:
        before = mark
        now, mark = _marked(_small_star(materialize(_large_star(now), "edges")))
        if mark == before:
            break
    # all edges are (node, smallest of its component) now
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
