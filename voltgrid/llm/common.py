"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltgrid.session import checkpoint_dir

# A word is a maximal run of anything but blank and the five ASCII controls
# from tab to carriage return; no Unicode white space ends a word.
SPACE_CHARS = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text: Column) -> Column:
    """All words of a text in order (NULL text: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def unit_interval(key: Column, seed: int | str) -> Column:
    """A number in [0, 1) from 52 bits of md5(seed:key); the same in every run
    and in any engine that has md5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder of the session."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet into the shared checkpoint
    folder and read it back. Lost executors don't lose it, its size is exact
    for the planner, and it is computed once. The folder holds one directory
    for each call; clear it as other checkpoints are cleared."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that shuffles both sides. The planner sizes
    a table by its compressed files and doesn't count the rows that an explode
    makes or an array's elements, so one that grows with the corpus may be far
    below the broadcast threshold there and many times above it in the
    driver's memory."""
    return df.hint("merge")


# ------------------------------------------------------------ numpy on texts

def byte_view(texts: list[bytes], gap: bytes = b"\n") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes as one array, each text followed by ``gap``; with the
    start and the end (without the gap) of each text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.zeros(len(texts), np.int64)
    np.cumsum(lengths[:-1] + len(gap), out=starts[1:])
    joined = gap.join([*texts, b""]) if texts else b""
    return np.frombuffer(joined, np.uint8), starts, starts + lengths


def chunks_by_size(frames: Iterator, column: str, limit: int) -> Iterator:
    """The rows of pandas batches again, in pieces of about ``limit``
    characters of ``column`` (one row at least)."""
    for pdf in frames:
        size = pdf[column].str.len().fillna(0).to_numpy(np.int64)
        piece = np.cumsum(size) // max(1, limit)
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(pdf)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield pdf.iloc[a:b]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit integers (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
