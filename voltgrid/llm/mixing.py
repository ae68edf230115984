"""Mixing sources to target weights (operator 1).

Words are summed per source (partial sums before the shuffle, so a hot source
costs one row a task), the per-source targets become repetition rates, and a
document is emitted floor(rate) times plus one more time if its hash-seeded
coin, whose probability is the fraction of the rate, says so. The coin depends
on the seed and the document's id alone (the text's md5 where the id is NULL),
so reruns agree and a retried task emits the same copies.

Targets: all sources share ``share`` times the corpus by weight; a target
stops at ``cap`` times its source's size, and the excess goes to the others by
weight until none is above. That is one water level ``w`` with target =
min(cap * size, weight * w), found in one sorted pass over the sources.

Defined cases: a NULL source is a source of its own, last in order; NULL and
blank texts have size 0 and, like every document of a source of size 0, are
taken 0 times; repeated rows toss the same coin; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltgrid.llm.common import materialize, unit_interval, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
SEED = 17


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   cap: float = CAP) -> DataFrame:
    """One row per source: source, source_size, weight, target, rate.

    ``sizes`` has columns source and size. The windows run over one row per
    source, never over documents."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ceil = F.lit(cap) * F.col("source_size")
    fill = Window.orderBy(F.col("ceiling") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    level = F.try_divide(
        F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum("ceiling").over(before), F.lit(0.0)),
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    return (per.withColumn("weight", weight.cast("long")).withColumn("ceiling", ceil)
            .withColumn("level_if_first_below", level)
            # the level rises while full sources are passed and falls after: its maximum is the one
            .withColumn("level", F.max("level_if_first_below").over(whole))
            .withColumn("target", F.least("ceiling", F.col("weight") * F.col("level")))
            .withColumn("rate", F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)))
            .select("source", "source_size", "weight", "target", "rate"))


def mixing_plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                seed: int = SEED, size: Column | None = None, **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate,
    copies. ``size`` is the measure to mix by (default: words)."""
    measured = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
        (word_count(F.col(text)) if size is None else size).cast("long").alias("size"),
        F.coalesce(F.col(doc_id).cast("string"), F.md5(F.coalesce(F.col(text), F.lit("")))).alias("key"))
    # a few bytes per source; written, so that the planner knows its size and
    # broadcasts it only if it is below the session's threshold
    targets = materialize(source_targets(measured.select("source", "size"), **options), "mixing-targets")
    coin = unit_interval(F.col("d.key"), seed) < F.col("t.rate") - F.floor("t.rate")
    return (measured.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
            .select("d.doc_id", "d.source", "d.size", "t.source_size", "t.target", "t.rate",
                    (F.floor("t.rate") + coin.cast("long")).cast("long").alias("copies")))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        seed: int = SEED, **options) -> DataFrame:
    """The mix itself: the input's rows and columns, each row as often as it
    is taken."""
    cols = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("doc_id"),
                      F.col(source).cast("string").alias("source"), F.col(text).alias("text"),
                      F.coalesce(F.col(doc_id).cast("string"),
                                 F.md5(F.coalesce(F.col(text), F.lit("")))).alias("key"))
    sizes = row.select("source", word_count(F.col("text")).alias("size"))
    targets = materialize(source_targets(sizes, **options), "mixing-targets")
    coin = unit_interval(F.col("d.key"), seed) < F.col("t.rate") - F.floor("t.rate")
    copies = F.when(word_count(F.col("d.text")) > 0, F.floor("t.rate") + coin.cast("long")).otherwise(F.lit(0))
    return (row.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
            .select(F.explode(F.array_repeat(F.col("d.doc_id"), copies.cast("int"))).alias("row"))
            .select(*[F.col("row").getField(c).alias(c) for c in cols]))
