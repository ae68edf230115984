"""Attach group-level statistics (mean, std, percentile …) to every row.

Per group (``by`` non-empty) this is a window partitioned by the group key;
its input is always an already-reduced frame (one row per station-day or
station-hour), so even a station holding a third of all sessions contributes
only its number of days to one window partition.

Network-wide (``by == []``) an unpartitioned window would pull every row into
a single task; instead the one-row aggregate is computed with partial
aggregation and broadcast back (``crossJoin`` of a frame proven to hold
exactly one row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of ``one_row`` — an ungrouped aggregate, hence at
    most one row by construction — to every row of ``df`` (J09). This is a
    broadcast nested-loop join against a single row: it emits exactly
    ``df``'s rows, never pairs."""
    return df.crossJoin(F.broadcast(one_row))


def with_group_stats(df: DataFrame, by: list[str], **aggs: Column) -> DataFrame:
    if by:
        w = Window.partitionBy(*by)
        return df.select("*", *[a.over(w).alias(n) for n, a in aggs.items()])
    return attach_one_row(df, df.agg(*[a.alias(n) for n, a in aggs.items()]))


def group_stats(df: DataFrame, by: list[str], **aggs: Column) -> DataFrame:
    """The statistics alone: one row per group (or exactly one row)."""
    g = df.groupBy(*by) if by else df
    return g.agg(*[a.alias(n) for n, a in aggs.items()])
