"""Anomaly detection over the per-station feature table.

A02 (this module's ``zscore_anomalies``) is the value-checkable rule: a row is
anomalous when any of the five model features lies more than ``k`` sample
standard deviations from the network mean. The statistics are one broadcast
row (partial aggregation), never an unpartitioned window.

A01, the isolation forest, lives in ``voltgrid.operators.isolation_forest``.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltgrid.functions.groupstats import attach_one_row
from voltgrid.schemas import conform
from voltgrid.functions.columns import ntz_literal

# The five model features (nulls count as 0) and the z rule.
MODEL_FEATURES = ["avg_downtime_minutes", "energy_consumption_per_traffic", "avg_wait_time_minutes",
                  "total_sessions", "total_energy_kwh"]
Z_LIMIT = 2.0
ANOMALY_TYPE = "usage_pattern"
DESCRIPTION = "Unusual usage pattern detected with score: %.3f"


def feature_matrix(features: DataFrame) -> DataFrame:
    """station_id plus the five model features as doubles, NULL → 0."""
    return features.select("station_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                                           for c in MODEL_FEATURES])


def anomaly_rows(flagged: DataFrame, score_col: str, as_of: _dt.datetime) -> DataFrame:
    """Rows of the anomaly table for flagged stations: type usage_pattern,
    severity |score|, description with the score, unresolved."""
    now = ntz_literal(as_of)
    s = F.col(score_col)
    out = flagged.select(
        "station_id", F.lit(ANOMALY_TYPE).alias("anomaly_type"), F.abs(s).alias("severity_score"),
        now.alias("detected_at"), F.format_string(DESCRIPTION, s).alias("description"),
        F.lit(False).alias("is_resolved"), now.alias("created_at"))
    return conform(out, "anomaly_detection", computed=True)


def zscore_anomalies(features: DataFrame, as_of: _dt.datetime, k: float = Z_LIMIT) -> DataFrame:
    """Stations whose largest |z| over the five features exceeds ``k``;
    severity = that largest |z|."""
    x = feature_matrix(features)
    stats = x.agg(*[a for c in MODEL_FEATURES
                    for a in (F.avg(c).alias(f"{c}__m"), F.stddev_samp(c).alias(f"{c}__s"))])
    j = attach_one_row(x, stats)
    zs = [F.abs(F.when(F.col(f"{c}__s") > 0, (F.col(c) - F.col(f"{c}__m")) / F.col(f"{c}__s"))
                .otherwise(F.lit(0.0))) for c in MODEL_FEATURES]
    scored = j.select("station_id", reduce(lambda a, b: F.greatest(a, b), zs).alias("score"))
    return anomaly_rows(scored.where(F.col("score") > k), "score", as_of)
