"""Language identification by nearest centroid (operator 6).

A text becomes the normalised TF-IDF vector of its hashed letter n-grams (one
to three letters of a word, word edges included; anything but letters is an
edge). Each language has several centroids, clustered by spherical k-means on
its own vectors; a text gets the language of the centroid with the largest
cosine, and is marked rejected if that cosine is below the centroid's own
distance bound (a low quantile of its members).

Document frequencies are counted over all texts to learn from. The centroids
are fitted on at most ``sample`` texts of each language, those with the
smallest hash of the text among a pre-selection of known rate; every text is
predicted, whole. The model is as large as languages * clusters * DIM floats.

Defined cases: a text that is NULL or has no letter is ``und`` with score 0;
if there is nothing to learn from, so is every text; of equal cosines the
first language by name wins; repeated rows are predicted alike; an empty table
gives an empty result. The operators replace input columns named lang_pred,
score or rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltgrid.llm.common import chunks_by_size, materialize, unit_interval

DIM = 4096
CLUSTERS = 4
SAMPLE = 400
ROUNDS = 12
QUANTILE = 0.01
SEED = 29
TEXT_BATCH = 1 << 20
UNKNOWN = "und"

_TABLES: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point its lower-case letter, 0 if it is no letter."""
    if not _TABLES:
        table = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                table[c] = ord(ch.lower()[0])
        _TABLES.append(table)
    return _TABLES[0]


def ngram_counts(texts: list[str | None]) -> np.ndarray:
    """(len(texts), DIM) counts of hashed n-grams."""
    n = len(texts)
    texts = [t or "" for t in texts]
    sizes = np.fromiter(map(len, texts), np.int64, n) + 1
    code = np.frombuffer("".join(x for t in texts for x in (t, "\n")).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[code]
    is_letter = letter > 0
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]          # one edge after each word
    at = np.flatnonzero(keep)
    if not len(at):
        return np.zeros((n, DIM), np.int64)
    doc = np.repeat(np.arange(n), sizes)[at]
    c = letter[at].astype(np.uint64)
    c1 = np.concatenate([[np.uint64(0)], c[:-1]])
    c2 = np.concatenate([np.zeros(2, np.uint64), c[:-2]])[:len(c)]
    a, b, d = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    shift = np.uint64(64 - DIM.bit_length() + 1)
    one = (c * a) >> shift
    two = (c * a + (c1 + np.uint64(1)) * b) * d >> shift
    three = (c * a + (c1 + np.uint64(1)) * b + (c2 + np.uint64(7)) * d) * b >> shift
    base = doc * DIM
    word, pair = c > 0, (c > 0) | (c1 > 0)
    inner = c1 > 0
    out = np.bincount((base + one.astype(np.int64))[word], minlength=n * DIM)
    out += np.bincount((base + two.astype(np.int64))[pair], minlength=n * DIM)
    out += np.bincount((base + three.astype(np.int64))[inner], minlength=n * DIM)
    return out.reshape(n, DIM)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts).astype(np.float32) * idf
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(size > 0, size, 1)


def _pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in chunks_by_size(frames, "text", TEXT_BATCH):
        for a in range(0, len(pdf), 512):
            yield pdf.iloc[a:a + 512]


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Over all texts: how many have each feature, and how many there are.
    A task sends DIM + 1 sums at most."""

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(DIM, np.int64), 0
        for pdf in _pieces(frames):
            df += (ngram_counts(pdf["text"].tolist()) > 0).sum(axis=0)
            n += len(pdf)
        has = np.flatnonzero(df)
        yield pd.DataFrame({"feature": np.append(has, -1), "n": np.append(df[has], n)})

    rows = (docs.select("text").mapInPandas(partial, "feature long, n long")
            .groupBy("feature").agg(F.sum("n").alias("n")).collect())       # DIM + 1 rows at most
    got = {r["feature"]: r["n"] for r in rows}
    df = np.zeros(DIM, np.int64)
    for k, v in got.items():
        if k >= 0:
            df[k] = v
    return df, int(got.get(-1, 0))


def spherical_kmeans(x: np.ndarray, clusters: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Centroids (unit length) and each row's centroid; starts are spread:
    the row nearest the mean, then each time the row farthest from all."""
    mean = x.mean(axis=0)
    picks = [int((x @ mean).argmax())]
    best = x @ x[picks[0]]
    while len(picks) < min(clusters, len(x)):
        picks.append(int(best.argmin()))
        best = np.maximum(best, x @ x[picks[-1]])
    c = x[picks].copy()
    own = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        for k in range(len(c)):
            if (own == k).any():
                m = x[own == k].mean(axis=0)
                c[k] = m / max(float(np.linalg.norm(m)), 1e-12)
    return c, (x @ c.T).argmax(axis=1)


@dataclass
class Model:
    langs: list[str]            # of each centroid, in order of name
    centroids: np.ndarray       # (centroids, DIM)
    bounds: np.ndarray          # least cosine that isn't rejected
    idf: np.ndarray


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", clusters: int = CLUSTERS,
        sample: int = SAMPLE, seed: int = SEED) -> Model:
    """Learn from the rows of ``docs`` with a text and a language."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    df, n = document_frequencies(known)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    counts = materialize(known.groupBy("lang").agg(F.count("*").alias("n")), "lang-counts")
    chance = unit_interval(F.md5("text"), seed)
    # four times the sample passes the rate, so a language's rows don't meet in one task
    few = (known.withColumn("u", chance).join(counts, "lang").where(F.col("u") * F.col("n") < 4 * sample)
           .select("lang", "text", "u"))

    def centroids(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["u", "text"]).head(sample)
        x = vectors(ngram_counts(pdf["text"].tolist()), idf)
        c, own = spherical_kmeans(x, clusters)
        cos = (x * c[own]).sum(axis=1)
        used = [k for k in range(len(c)) if (own == k).any()]
        return pd.DataFrame({"lang": pdf["lang"].iat[0], "cluster": used,
                             "centroid": [c[k].astype("<f4").tobytes() for k in used],
                             "bound": [float(np.quantile(cos[own == k], QUANTILE)) for k in used]})

    rows = sorted(few.groupBy("lang").applyInPandas(
        centroids, "lang string, cluster int, centroid binary, bound double").collect(),    # clusters a language
        key=lambda r: (r["lang"], r["cluster"]))
    return Model([r["lang"] for r in rows],
                 np.array([np.frombuffer(r["centroid"], "<f4") for r in rows], np.float32).reshape(len(rows), DIM),
                 np.array([r["bound"] for r in rows]), idf)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (cosine, 0 to 1) and rejected."""
    langs = np.array([*model.langs, UNKNOWN], dtype=object)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def nearest(texts: pd.Series) -> pd.DataFrame:
        out = []
        for pdf in _pieces(iter([texts.to_frame("text").reset_index(drop=True)])):
            counts = ngram_counts(pdf["text"].tolist())
            blank = counts.sum(axis=1) == 0
            if len(model.langs):
                cos = vectors(counts, model.idf) @ model.centroids.T
                best = cos.argmax(axis=1)
                score = np.clip(cos[np.arange(len(cos)), best], 0, 1).astype(np.float64)
                far = score < model.bounds[best]
                best[blank] = -1
            else:
                best, score, far = np.full(len(counts), -1), np.zeros(len(counts)), np.ones(len(counts), bool)
            score[blank] = 0
            out.append(pd.DataFrame({"lang_pred": langs[best], "score": score, "rejected": far | blank}))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame(
            {"lang_pred": [], "score": [], "rejected": []}).astype({"lang_pred": object, "rejected": bool})

    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("lang_pred", "score", "rejected")]
    return docs.select(*kept, nearest(F.col(text)).alias("__llm_p")).select(*kept, "__llm_p.*")
