"""Exact quantiles by distributed selection.

``percentile`` (exact) merges a value→count map of *every* distinct value
into the final task, and an ordered window has one partition for each target.
``exact_quantiles`` gives the same linearly interpolated result
(numpy/pandas ``linear``, DuckDB ``quantile_cont``) by narrowing:

1. equal values are counted (partial aggregation, then one shuffle on the
   value), all columns asked for in the same table;
2. each target rank starts with the range from the least to the greatest value.
   A range is cut into ``CELLS`` equal ranges, the counts in each are added up
   (with the least and greatest value that it holds), and a running sum over at
   most ``CELLS`` rows says which of them holds the rank. That range, shrunk to
   its values, is cut again. Cutting is monotone, so no rounding can lose a
   rank;
3. after ``LEVELS`` rounds the target's range is below a 10^-9 part of the
   first for evenly spread values, and its few values are put in order.

All targets go through the same rounds. The state between rounds is one row
for each target (two targets, the ranks on either side, for each quantile), so
its broadcast is bounded by the number of quantiles. Everything is one lazy
one-row DataFrame; the counted values are the same subplan in every round, so
their shuffle is written once and read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS = 65_536
LEVELS = 2


def _reached(per: DataFrame) -> DataFrame:
    """Of each target (i, t) the row of ``per`` (…, cell, c) whose running
    count passes the rank r; r is counted from that row's start on."""
    order = Window.partitionBy("i", "t").orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = per.withColumn("upto", F.sum("c").over(order))
    return upto.where((F.col("upto") > F.col("r")) & (F.col("upto") - F.col("c") <= F.col("r"))) \
        .withColumn("r", F.col("r") - F.col("upto") + F.col("c"))


def counted_quantiles(counts: DataFrame, specs: list[tuple[float, str]], cells: int = CELLS,
                      levels: int = LEVELS) -> DataFrame:
    """One row with the columns ``name`` and ``name_below`` (how many values
    are less) per spec ``(q, name)``; ``counts`` has the rows i int (number of
    the spec), x double, c long: its values, not NULL, each once, and how often
    it occurs."""
    at = lambda vs, i: F.get(F.array(*[F.lit(float(v)) for v in vs]), i)
    whole = counts.groupBy("i").agg(F.sum("c").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    position = at([q for q, _ in specs], F.col("i")) * (F.col("n") - 1)
    state = whole.select(
        "i", (position - F.floor(position)).alias("f"), "lo", "hi", F.posexplode(F.array(
            F.floor(position), F.least(F.floor(position) + 1, F.col("n") - 1))).alias("t", "r")) \
        .withColumn("rank", F.col("r"))
    for _ in range(levels):
        cell = F.floor((F.col("x") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)) * cells)
        per = _within(counts, state).groupBy("i", "t", "r", "f", "rank", F.coalesce(
            F.least(cell, F.lit(cells - 1)), F.lit(0)).alias("cell")).agg(
            F.sum("c").alias("c"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        state = _reached(per).select("i", "t", "r", "f", "rank", "lo", "hi")
    found = _reached(_within(counts, state).withColumn("cell", F.col("x")))
    # of a found value, r is the rank among its equals: rank - r values are less
    of = lambda i, t, c: F.max(F.when((F.col("i") == i) & (F.col("t") == t), c))
    less = F.col("rank") - F.col("r")
    one = found.agg(*[of(i, t, c).alias(f"{k}{t}_{i}") for i in range(len(specs)) for t in (0, 1)
                      for k, c in (("x", F.col("x")), ("less", less), ("f", F.col("f")))])
    out = []
    for i, (_, name) in enumerate(specs):
        x0, x1, f = F.col(f"x0_{i}"), F.col(f"x1_{i}"), F.col(f"f0_{i}")
        value = F.when(f == 0, x0).otherwise(x0 + (x1 - x0) * f)
        out += [value.alias(name), F.when(value > x0, F.col(f"less1_{i}")).otherwise(F.col(f"less0_{i}")).alias(f"{name}_below")]
    return one.select(*out)


def _within(counts: DataFrame, state: DataFrame) -> DataFrame:
    """The counted values in each target's range; two rows of state a spec."""
    return counts.join(F.broadcast(state), "i").where((F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi")))


def count_values(df: DataFrame, columns: list[str | Column]) -> DataFrame:
    """i, x, c: the values of the columns (NULLs left out) and how often each
    occurs."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    pairs = [F.struct(F.lit(i).alias("i"), col(c).cast("double").alias("x")) for i, c in enumerate(columns)]
    return (df.select(F.inline(F.array(*pairs))).where(F.col("x").isNotNull())
            .groupBy("i", "x").agg(F.count(F.lit(1)).alias("c")))


def exact_quantiles(df: DataFrame, specs: list[tuple[str, float, str]], cells: int = CELLS,
                    levels: int = LEVELS) -> DataFrame:
    """One row with the columns ``name`` and ``name_below`` per spec
    ``(column, q, name)``: the exact ``q`` quantile of ``column`` (NULLs
    ignored; NULL when there is no value) and the number of values below it."""
    columns = list(dict.fromkeys(c for c, _, _ in specs))
    counts = count_values(df, columns)
    if len(columns) < len(specs):               # several quantiles of one column share its counts
        which = F.array(*[F.array(*[F.lit(k) for k, s in enumerate(specs) if s[0] == c]) for c in columns])
        counts = counts.select(F.explode(F.get(which, F.col("i"))).alias("i"), "x", "c")
    return counted_quantiles(counts, [(q, name) for _, q, name in specs], cells, levels)


def exact_quantile(df: DataFrame, col: str, q: float, name: str = "threshold", cells: int = CELLS,
                   levels: int = LEVELS) -> DataFrame:
    """One row, one column ``name``: the exact ``q`` quantile of ``col``."""
    return exact_quantiles(df, [(col, q, name)], cells, levels).select(name)
