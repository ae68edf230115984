"""Isolation-forest anomaly detection on the per-station feature table
(Liu, Ting & Zhou, "Isolation Forest", ICDM 2008), as Spark jobs.

fit
  1. bounded pre-sample: the ``n_trees × max_samples`` rows with the smallest
     ``xxhash64(station_id, seed)`` — a hash-threshold filter (sized from the
     row count) then a top-k over the few survivors, never a full sort;
  2. each pre-sampled row is expanded to every tree id (``explode(sequence)``)
     and each tree keeps its ``min(max_samples, n)`` rows with the smallest
     ``xxhash64(station_id, tree, seed)`` — a window per tree over at most
     ``n_trees × max_samples`` rows;
  3. ``groupBy("tree").applyInPandas`` grows one tree per group with numpy,
     random stream seeded by ``(seed, tree)`` — the result does not depend on
     partitioning or executor count;
  4. the node table (at most ``n_trees × (2·max_samples − 1)`` rows: a model,
     bounded regardless of data size) is the fitted model.
score
  the model is broadcast and every row is scored by a vectorised
  ``mapInPandas`` (Arrow batches): ``s = 2^(−E[h(x)]/c(ψ))``;
  ``decision = −s − percentile(−s, contamination)`` — the exact percentile of
  the training scores (``functions.quantiles``) — and ``decision < 0`` flags.
  The scores are shuffled by station once; the threshold and the flags read
  that shuffle, so every row is scored once and nothing runs before the result
  is asked for.

Scores follow the published algorithm but not a particular library's random
stream, so they are checked by invariants (tests), not values.
"""

from __future__ import annotations

import datetime as _dt
import math
import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from pyspark import cloudpickle

from voltgrid.operators.anomalies import MODEL_FEATURES, anomaly_rows, feature_matrix
from voltgrid.session import checkpoint_dir
from voltgrid.functions.groupstats import attach_one_row
from voltgrid.functions.quantiles import exact_quantile

# Functions of this module run inside Python workers (applyInPandas /
# mapInPandas); ship them by value so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the detector (library defaults used by the reference).
N_TREES = 100
MAX_SAMPLES = 256
CONTAMINATION = 0.1
SEED = 42
EULER_GAMMA = 0.5772156649

NODE_SCHEMA = StructType([
    StructField("tree", LongType()), StructField("node", LongType()), StructField("feature", LongType()),
    StructField("threshold", DoubleType()), StructField("left", LongType()), StructField("right", LongType()),
    StructField("size", LongType()), StructField("depth", LongType()), StructField("psi", LongType())])


def c_factor(n):
    """Average path length of an unsuccessful BST search over n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def _grow_tree(pdf: pd.DataFrame, features: list[str], seed: int) -> pd.DataFrame:
    """Grow one isolation tree on its sample (pandas group of applyInPandas)."""
    tree = int(pdf["tree"].iloc[0])
    X = pdf[features].to_numpy(dtype=float)
    psi = len(X)
    limit = int(math.ceil(math.log2(max(psi, 2))))
    rng = np.random.default_rng([seed, tree])
    rows = []
    stack = [(0, np.arange(psi), 0)]
    next_id = 1
    while stack:
        node, idx, depth = stack.pop()
        sub = X[idx]
        if depth >= limit or len(idx) <= 1:
            rows.append((tree, node, -1, np.nan, -1, -1, len(idx), depth, psi))
            continue
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        candidates = np.flatnonzero(hi > lo)
        if len(candidates) == 0:
            rows.append((tree, node, -1, np.nan, -1, -1, len(idx), depth, psi))
            continue
        q = int(rng.choice(candidates))
        thr = float(rng.uniform(lo[q], hi[q]))
        go_left = sub[:, q] <= thr
        left, right = next_id, next_id + 1
        next_id += 2
        rows.append((tree, node, q, thr, left, right, len(idx), depth, psi))
        stack.append((right, idx[~go_left], depth + 1))
        stack.append((left, idx[go_left], depth + 1))
    return pd.DataFrame(rows, columns=[f.name for f in NODE_SCHEMA.fields])


@dataclass(frozen=True)
class IsolationForestModel:
    """Fitted forest as dense per-tree arrays (bounded size)."""

    feature: np.ndarray      # [trees, nodes] int, −1 at leaves
    threshold: np.ndarray    # [trees, nodes]
    left: np.ndarray
    right: np.ndarray
    leaf_value: np.ndarray   # depth + c(size) at leaves
    max_depth: int
    psi: int
    features: tuple[str, ...]

    def arrays(self) -> dict:
        """Plain dict of numpy arrays — what is broadcast to executors."""
        return {"feature": self.feature, "threshold": self.threshold, "left": self.left, "right": self.right,
                "leaf_value": self.leaf_value, "max_depth": self.max_depth, "psi": self.psi}

    def scores(self, X: np.ndarray) -> np.ndarray:
        return forest_scores(self.arrays(), X)


def path_lengths(m: dict, X: np.ndarray) -> np.ndarray:
    """Mean path length E[h(x)] of each row over all trees: every tree is
    walked level by level for the whole batch at once (numpy gathers)."""
    n = len(X)
    total = np.zeros(n)
    rows = np.arange(n)
    feature, threshold, left, right, leaf = m["feature"], m["threshold"], m["left"], m["right"], m["leaf_value"]
    for t in range(feature.shape[0]):
        node = np.zeros(n, dtype=np.int64)
        for _ in range(m["max_depth"] + 1):
            f = feature[t, node]
            inner = f >= 0
            if not inner.any():
                break
            x = X[rows, np.where(inner, f, 0)]
            nxt = np.where(x <= threshold[t, node], left[t, node], right[t, node])
            node = np.where(inner, nxt, node)
        total += leaf[t, node]
    return total / max(feature.shape[0], 1)


def forest_scores(m: dict, X: np.ndarray) -> np.ndarray:
    """Anomaly score s(x) = 2^(−E[h(x)]/c(ψ)) in (0, 1]; higher = more anomalous."""
    return np.power(2.0, -path_lengths(m, X) / float(c_factor([m["psi"]])[0] or 1.0))


def presample(X: DataFrame, k: int, seed: int = SEED) -> DataFrame:
    """The k rows with the smallest ``xxhash64(station_id, seed)``: a top-k,
    so each task sends its k smallest at most and they are merged once."""
    return X.orderBy(F.xxhash64("station_id", F.lit(seed)), "station_id").limit(k)


def tree_samples(X: DataFrame, n_trees: int = N_TREES, max_samples: int = MAX_SAMPLES,
                 seed: int = SEED) -> DataFrame:
    """Per-tree training samples (steps 1–2 of the module docstring)."""
    pool = presample(X, n_trees * max_samples, seed)
    ex = pool.withColumn("tree", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_trees - 1).cast("bigint"))))
    w = Window.partitionBy("tree").orderBy(F.xxhash64("station_id", "tree", F.lit(seed)), "station_id")
    return ex.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= max_samples).drop("_r")


def fit(features: DataFrame, n_trees: int = N_TREES, max_samples: int = MAX_SAMPLES,
        seed: int = SEED) -> IsolationForestModel:
    """Grow the forest on executors and return the bounded node table."""
    X = feature_matrix(features)
    feats = list(MODEL_FEATURES)
    nodes_df = tree_samples(X, n_trees, max_samples, seed).groupBy("tree").applyInPandas(
        lambda pdf: _grow_tree(pdf, feats, seed), schema=NODE_SCHEMA)
    nodes = nodes_df.toPandas()  # ≤ n_trees × (2·max_samples − 1) rows
    if nodes.empty:
        z = np.zeros((0, 1))
        return IsolationForestModel(z.astype(int), z, z.astype(int), z.astype(int), z, 0, 1, tuple(feats))
    T = int(nodes["tree"].max()) + 1
    M = int(nodes["node"].max()) + 1
    feature = np.full((T, M), -1, dtype=np.int64)
    threshold = np.zeros((T, M))
    left = np.zeros((T, M), dtype=np.int64)
    right = np.zeros((T, M), dtype=np.int64)
    leaf_value = np.zeros((T, M))
    t, m = nodes["tree"].to_numpy(), nodes["node"].to_numpy()
    feature[t, m] = nodes["feature"].to_numpy()
    threshold[t, m] = nodes["threshold"].fillna(0.0).to_numpy()
    left[t, m] = nodes["left"].to_numpy()
    right[t, m] = nodes["right"].to_numpy()
    leaf_value[t, m] = nodes["depth"].to_numpy() + c_factor(nodes["size"].to_numpy())
    return IsolationForestModel(feature, threshold, left, right, leaf_value, int(nodes["depth"].max()),
                                int(nodes["psi"].max()), tuple(feats))


def score(model: IsolationForestModel, features: DataFrame) -> DataFrame:
    """station_id + anomaly score ``s`` for every row (broadcast model,
    Arrow-batched vectorised scoring; stateless, so it also scores streams)."""
    X = feature_matrix(features)
    bmodel = X.sparkSession.sparkContext.broadcast(model.arrays())
    cols = list(model.features)

    def run(batches):
        arrays = bmodel.value
        for pdf in batches:
            s = forest_scores(arrays, pdf[cols].to_numpy(dtype=float)) if len(pdf) else np.zeros(0)
            yield pd.DataFrame({"station_id": pdf["station_id"], "score": s})
    return X.mapInPandas(run, schema="station_id string, score double")


def _materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the session's shared ``spark.checkpoint.dir``:
    cuts the lineage so later passes (and recovery after a lost executor)
    read the written result instead of recomputing the feature pipeline."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def detect_anomalies(features: DataFrame, as_of: _dt.datetime, contamination: float = CONTAMINATION,
                     n_trees: int = N_TREES, max_samples: int = MAX_SAMPLES, seed: int = SEED,
                     model: IsolationForestModel | None = None) -> DataFrame:
    """Fit (unless a model is given), score every station, flag the
    ``contamination`` share with the lowest decision values, and emit
    anomaly rows (severity = |decision|). Fitting is an action, and only then
    the feature matrix is checkpointed, for the fit and the scores; with a
    model the frame is lazy."""
    if model is None:
        features = _materialize(feature_matrix(features))
        model = fit(features, n_trees, max_samples, seed)
    d = decision_values(features, model, contamination)
    return anomaly_rows(d.where(F.col("decision") < 0), "decision", as_of)


def forest_summary(features: DataFrame, contamination: float = CONTAMINATION,
                   model: IsolationForestModel | None = None) -> DataFrame:
    """Stations, stations with a score, and stations flagged, as one row."""
    if model is None:
        features = _materialize(feature_matrix(features))
        model = fit(features)
    d = decision_values(features, model, contamination)
    n = features.agg(F.count(F.lit(1)).alias("stations"))
    return attach_one_row(n, d.agg(F.count("score").alias("scored"),
                                   F.count_if(F.col("decision") < 0).alias("flagged")))


def decision_values(features: DataFrame, model: IsolationForestModel,
                    contamination: float = CONTAMINATION) -> DataFrame:
    """station_id, score, decision for every row."""
    # one shuffle of station and negated score (never NULL); both readers ask for the same rows and columns
    s = score(model, features).select("station_id", (-F.col("score")).alias("neg")) \
        .where(F.col("neg").isNotNull()).repartition("station_id")
    offset = exact_quantile(s, "neg", contamination, name="offset")
    return attach_one_row(s, offset).select(
        "station_id", (-F.col("neg")).alias("score"), (F.col("neg") - F.col("offset")).alias("decision"))
