"""Benchmark decontamination (operator 7): latent semantic retrieval of
benchmark passages, confirmed by longest common subsequences and answers.

Passages are windows that start every STRIDE words, as wide as the benchmark
passage they are compared with (the least of WIDTHS that holds it); their
TF-IDF vectors (hashed to DIM features) are mapped into RANK dimensions by a
randomised singular value decomposition and scaled by the singular values.

1. Frequencies: over all documents, the passages' blocks that have a feature
   are counted.
2. Index: the decomposition is fitted on all passages of the corpus's distinct
   texts and all of the benchmark. The benchmark's rows are scaled to weigh as
   much in all as the corpus's, so the space separates benchmark passages from
   each other and from common prose. The words' features (two bytes each) and
   the passages' lengths are written once; a round multiplies the distributed
   matrix by a DIM * (RANK + extra) block on the executors and sums the products
   by block of features; the driver sees that fixed-size block only. A passage
   is the sum of its blocks of STRIDE words, and a block takes back the sum of
   the passages that hold it, so each word is read and given back once.
3. Threshold: measured in the fitted space, for each width. Every benchmark
   passage is spoilt as the hardest paraphrase that can be confirmed would
   be (words replaced until ``part`` are left, cut at one end by half a stride,
   filled up with foreign words); all but MISSED of the spoilt ones lie above
   the threshold, which is COSINE at most.
4. Search: every passage of every document is compared with all benchmark
   passages of its width. Candidates come from the cosine alone. In the same
   task their surroundings are confirmed: the longest common subsequence with the
   item's words covers ``full`` of the item, or ``part`` of it with the answer
   (the item's last sentence, ANSWER_WORDS words at least) recovered to
   ``answer``. A count of the item's words, each as often as the item has it,
   skips surroundings that hold too few for any confirmation. No pair of passages
   leaves a task unless it is confirmed.

The benchmark is a query set: its items go to the tasks in blocks of ITEMS at
most, one search per block.

Defined cases: NULL and blank texts and items match nothing; a text shorter
than a window is one passage; repeated rows and items are reported each; an
empty corpus or benchmark gives an empty result. ``find_leaks`` returns columns
of its own; ``remove_leaks`` returns the input's rows and columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltgrid.llm.common import chunks_by_size, materialize
from voltgrid.llm.shingles import word_hashes

STRIDE, QUERY_STRIDE = 8, 8
WIDTHS = (8, 16, 24, 32)    # of passages, in words
WINDOW = WIDTHS[-1]
DIM = 1 << 15
RANK, EXTRA, ROUNDS = 64, 10, 3
COSINE = 0.75               # threshold, at most
MISSED = 0.02               # of the spoilt benchmark passages, below the threshold
SPOILT = 400                # spoilt benchmark passages of each width, at least
FULL, PART, ANSWER = 0.8, 0.6, 0.8
ANSWER_WORDS = 6
ITEMS = 2_000
SEED = 43
TEXT_BATCH = 1 << 21
CHUNK = 256                 # features summed together: rows of 75 KB, small objects to the driver's heap
AFTER = WINDOW // STRIDE - 1                    # blocks of a passage after its first one: 3, 2 ** n - 1 in all
CHUNK_WORDS, PIECE = 1 << 17, 1 << 16           # words multiplied together; of a text in one piece
TASK_WORDS = 1 << 24        # of the corpus in a task of the fit, which gives out DIM * (RANK + EXTRA) numbers

_SEPARATES = np.zeros(256, bool)
_SEPARATES[:0x30] = True                        # controls, blank, punctuation
_SEPARATES[[*range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def terms(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the alphanumeric words and their bounds by text."""
    return word_hashes([(t or "").encode() for t in texts], separates=_SEPARATES)


def features(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - DIM.bit_length() + 1)).astype(np.int64)


def blocks_of(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start (in words) of each block of STRIDE words, and its text."""
    n = np.diff(bounds)
    count = -(-n // STRIDE)
    doc = np.repeat(np.arange(len(n)), count)
    inner = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    return bounds[doc] + inner * STRIDE, doc


def row_sums(table: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``table`` that each column of ``index`` names. The
    rows of a few columns lie in the processor's cache, one line of the index
    after the other, so that they are added as long vectors."""
    size, n = index.shape
    out = np.empty((n, table.shape[1]), table.dtype)
    held = np.empty((size * 256, table.shape[1]), table.dtype)
    for a in range(0, n, 256):
        at = index[:, a:a + 256]
        rows = table.take(at.ravel(), axis=0, mode="clip", out=held[:at.size])
        np.add.reduce(rows.reshape(size, -1), axis=0, out=out[a:a + 256].reshape(-1))
    return out


def block_sums(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``table`` that each STRIDE of ``places`` name."""
    return row_sums(table, places.reshape(-1, STRIDE).T.astype(np.int64, order="C"))


def segment_sums(table: np.ndarray, index: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``table``, whose last row is 0, that ``index`` names,
    by segments of ``sizes`` (none 0) of it. Long segments are summed STRIDE
    rows at a time, until one is left."""
    out = np.empty((len(sizes), table.shape[1]), table.dtype)
    first, least = np.cumsum(sizes) - sizes, 0
    for size in (1, 2, STRIDE // 2):
        own = np.flatnonzero((sizes > least) & (sizes <= size))
        inner = np.arange(size)[:, None]
        at = index[np.minimum(first[own] + inner, len(index) - 1)]
        at[inner >= sizes[own]] = len(table) - 1
        out[own] = row_sums(table, at)
        least = size
    if len(long := np.flatnonzero(sizes > least)):
        left = sizes[long]
        groups = -(-left // STRIDE)
        start = (np.cumsum(groups) - groups) * STRIDE
        padded = np.full(int(groups.sum()) * STRIDE, len(table) - 1, np.int64)
        at = np.arange(int(left.sum())) + np.repeat(start - (np.cumsum(left) - left), left)
        padded[at] = index[np.repeat(sizes > least, sizes)]
        part = block_sums(table, padded)
        if len(part) > len(long):
            part = segment_sums(np.append(part, np.zeros_like(part[:1]), axis=0), np.arange(len(part)), groups)
        out[long] = part
    return out


def run_sums(rows: np.ndarray) -> np.ndarray:
    """Sums of each row and the AFTER rows after it; without the last AFTER rows."""
    out, n = rows, 1
    while n <= AFTER:                                     # of 2, 4, ... rows
        out, n = out[:-n] + out[n:], 2 * n
    return out


def laid_out(words: np.ndarray, sizes: np.ndarray, gap: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Features of texts of ``sizes`` words in blocks of STRIDE places, a text's
    last block filled up with DIM, and ``gap`` empty blocks after each text;
    with the place of each word."""
    count = -(-sizes // STRIDE) + gap
    first = np.cumsum(count) - count
    at = np.arange(len(words)) + np.repeat(first * STRIDE - (np.cumsum(sizes) - sizes), sizes)
    out = np.full(int(count.sum()) * STRIDE, DIM, np.uint16)
    out[at] = words
    return out, at


def text_features(docs: DataFrame) -> DataFrame:
    """text_key, words (the words' features) of each row, written once."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in chunks_by_size(frames, "text", TEXT_BATCH):
            words, bounds = terms(pdf["text"].tolist())
            held = features(words).astype("<u2")
            yield pd.DataFrame({"text_key": pdf["text_key"].to_numpy(), "words": [
                held[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]})

    rows = docs.select("text", F.md5(F.coalesce("text", F.lit(""))).alias("text_key"))
    return materialize(rows.mapInPandas(cut, "text_key string, words binary"), "text-features", "snappy")


def block_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Blocks with each feature, and blocks, over all rows of ``texts`` (words)."""

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, total = np.zeros(DIM + 1, np.int64), 0
        for pdf in chunks_by_size(frames, "words", 2 * CHUNK_WORDS):
            sizes = pdf["words"].str.len().to_numpy(np.int64) // 2
            held = np.sort(laid_out(np.frombuffer(b"".join(pdf["words"]), "<u2"), sizes)[0].reshape(-1, STRIDE))
            once = np.ones(held.shape, bool)
            once[:, 1:] = held[:, 1:] != held[:, :-1]
            df += np.bincount(held[once], minlength=DIM + 1)
            total += len(held)
        has = np.flatnonzero(df[:DIM])
        yield pd.DataFrame({"feature": np.append(has, -1), "n": np.append(df[has], total)})

    rows = (texts.select("words").mapInPandas(partial, "feature long, n long")
            .groupBy("feature").agg(F.sum("n").alias("n")).collect())       # DIM + 1 rows at most
    df = np.zeros(DIM, np.int64)
    total = 0
    for r in rows:
        if r["feature"] < 0:
            total = int(r["n"])
        else:
            df[r["feature"]] = r["n"]
    return df, total


@dataclass
class Item:
    item_id: int | None
    words: np.ndarray
    masks: dict[int, int] = field(default_factory=dict)     # word -> bits of its places
    answer: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))


def _masks(words: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for k, w in enumerate(words.tolist()):
        out[w] = out.get(w, 0) | 1 << k
    return out


def common_subsequence(masks: dict[int, int], size: int, words: list[int]) -> int:
    """Length of the longest common subsequence, one bit per place of the
    item in an integer."""
    row = (1 << size) - 1
    full = row
    for w in words:
        if m := masks.get(w, 0):
            u = row & m
            row = ((row + u) | (row - u)) & full
    return size - row.bit_count()


def read_items(rows) -> list[Item]:
    out = []
    for r in rows:
        words, _ = terms([r["text"]])
        if len(words):
            last = [s for s in _SENTENCE.split(r["text"]) if len(terms([s])[0])][-1]
            size = max(ANSWER_WORDS, len(terms([last])[0]))
            out.append(Item(r["item_id"], words, _masks(words), words[-size:]))
    return out


def query_windows(items: list[Item]) -> tuple[list[np.ndarray], np.ndarray]:
    """Windows of the items' words, the last one at the item's end."""
    out, own = [], []
    for k, item in enumerate(items):
        n = len(item.words)
        starts = [0] if n <= WINDOW else sorted({*range(0, n - WINDOW, QUERY_STRIDE), n - WINDOW})
        out += [item.words[a:a + WINDOW] for a in starts]
        own += [k] * len(starts)
    return out, np.array(own, np.int64)


PASSAGES = "words binary, sizes binary, scale binary, passages long"


def square_norms(places: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Squared length of the summed vector of the passage from each block on:
    repeated features add up first, so equal ones count as pairs, too."""
    own = np.append(idf, 0.0) ** 2
    n = len(places) // STRIDE
    other = np.where(places == DIM, DIM + 1, places)      # empty places equal nothing
    equal = [np.flatnonzero(places[:-d] == other[d:]) for d in range(1, WINDOW)]
    i = np.concatenate(equal)
    block = i // STRIDE
    lag = (i + np.repeat(np.arange(1, WINDOW), [len(e) for e in equal])) // STRIDE - block
    value = np.bincount(lag * n + block, weights=2 * own[places[i]], minlength=(AFTER + 2) * n)
    by_lag = np.zeros((AFTER + 1, n + AFTER))
    by_lag[:, :n] = value.reshape(-1, n)[:AFTER + 1]      # the last lag is past the passage
    by_lag[0, :n] += own[places].reshape(-1, STRIDE).sum(axis=1)
    return sum(by_lag[k, t:t + n] for k in range(AFTER + 1) for t in range(AFTER + 1 - k))


def packed(texts: list[np.ndarray], idf: np.ndarray, weight: float = 1.0, only_first: bool = False) -> tuple:
    """A row of PASSAGES: the texts' words, the weights of the passages that
    start at their blocks over their squared length (0 for other blocks), and
    how many these are. Long texts are cut with what their passages still need."""
    pieces, counts = [], []
    for words in texts:
        for a in range(0, len(words), PIECE):
            pieces.append(words[a:a + PIECE + AFTER * STRIDE])
            counts.append(1 if only_first else -(-min(PIECE, len(words) - a) // STRIDE))
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    held = np.concatenate(pieces)
    places, _ = laid_out(held, sizes, AFTER)
    blocks = -(-sizes // STRIDE) + AFTER
    inner = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    scale = np.where(inner < np.repeat(counts, blocks), weight / np.maximum(square_norms(places, idf), 1e-24), 0)
    return held.astype("<u2").tobytes(), sizes.astype("<i4").tobytes(), scale.astype("<f4").tobytes(), sum(counts)


def corpus_passages(texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """All passages of the distinct texts, as rows of PASSAGES."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in chunks_by_size(frames, "words", 2 * CHUNK_WORDS):
            held = [np.frombuffer(w, "<u2") for w in pdf["words"] if len(w)]
            if held:
                yield pd.DataFrame([packed(held, idf)], columns=["words", "sizes", "scale", "passages"])

    distinct = texts.groupBy("text_key").agg(F.first("words").alias("words")).select("words")
    return materialize(distinct.mapInPandas(pack, PASSAGES), "passages", "lz4")


def passage_sums(row: tuple, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of a row of PASSAGES, their blocks, the sum of each passage's
    rows of ``table`` (its last row 0) and the passages' weights."""
    words, sizes = np.frombuffer(row.words, "<u2"), np.frombuffer(row.sizes, "<i4").astype(np.int64)
    places, at = laid_out(words, sizes, AFTER)
    return words, at // STRIDE, run_sums(block_sums(table, places)), np.frombuffer(row.scale, "<f4")[:-AFTER, None]


def multiplied(row: tuple, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features of a row of PASSAGES and, for each, its part of the
    transposed matrix times the matrix times ``table``."""
    words, block, x, scale = passage_sums(row, table)
    left = np.zeros((len(x) + 2 * AFTER + 1, x.shape[1]), x.dtype)
    np.multiply(x, scale, out=left[AFTER:AFTER + len(x)])
    back = run_sums(left)               # of the passages that hold a block; the last row is 0
    order = np.argsort(words, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(words[order].astype(np.int32)) > 0]))
    return words[order[first]], segment_sums(back, block[order], np.diff(np.append(first, len(words))))


def fit_projection(passages: DataFrame, count: int, queries: list[np.ndarray], idf: np.ndarray,
                   rank: int = RANK, seed: int = SEED) -> np.ndarray:
    """(DIM, rank): idf-weighted right singular vectors over the singular values,
    of all ``count`` passages of the corpus and the benchmark's.
    A space of more than half as many dimensions as benchmark passages (8 at
    least) would spread them into the corpus's smallest ones, so rank is less then."""
    rank = min(rank, max(8, len(queries) // 2))
    weight = max(1, count) / len(queries)
    own = [packed([features(q).astype(np.uint16) for q in queries[a:a + 2000]], idf, weight, only_first=True)
           for a in range(0, len(queries), 2000)]
    tasks = max(8, -(-count * STRIDE // TASK_WORDS))
    rows = passages.unionByName(passages.sparkSession.createDataFrame(own, PASSAGES)).coalesce(tasks)

    def weighted(q: np.ndarray) -> np.ndarray:
        return np.append(q * idf[:, None], np.zeros((1, q.shape[1])), axis=0).astype(np.float32)

    def multiply(q: np.ndarray) -> np.ndarray:
        """The matrix's transpose times the matrix times q."""
        def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            table, total = weighted(q), np.zeros((DIM, q.shape[1]))
            for pdf in frames:
                for row in pdf.itertuples(index=False):
                    f, part = multiplied(row, table)
                    total[f] += part
            yield pd.DataFrame({"chunk": range(DIM // CHUNK), "part": [
                total[k:k + CHUNK].astype("<f4").tobytes() for k in range(0, DIM, CHUNK)]})

        def add(pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "part": [
                sum(np.frombuffer(p, "<f4").astype("<f8") for p in pdf["part"]).astype("<f4").tobytes()]})

        got = (rows.mapInPandas(partial, "chunk int, part binary")
               .groupBy("chunk").applyInPandas(add, "chunk int, part binary").collect())
        out = np.zeros((DIM, q.shape[1]))
        for r in got:
            out[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.frombuffer(r["part"], "<f4").reshape(CHUNK, -1)
        return out * idf[:, None]

    def gram(q: np.ndarray) -> np.ndarray:
        """q's transpose times what ``multiply`` gives: squares of the matrix times q."""
        def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            table, total = weighted(q), np.zeros((q.shape[1], q.shape[1]))
            for pdf in frames:
                for row in pdf.itertuples(index=False):
                    _, _, x, scale = passage_sums(row, table)
                    total += x.T @ (x * scale)
            yield pd.DataFrame({"part": [total.tobytes()]})

        got = rows.mapInPandas(partial, "part binary").collect()        # one of 40 KB for each task
        return sum(np.frombuffer(r["part"]).reshape(q.shape[1], -1) for r in got)

    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((DIM, rank + EXTRA)))[0].astype(np.float32)
    for _ in range(ROUNDS - 1):
        q = np.linalg.qr(multiply(q))[0].astype(np.float32)
    small = gram(q)
    value, vector = np.linalg.eigh((small + small.T) / 2)
    top = np.argsort(-value)[:rank]
    top = top[value[top] > 1e-9 * max(1e-12, float(value[top[0]]))]
    return ((q @ vector[:, top]) / np.sqrt(value[top]) * idf[:, None]).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    return x / np.where(size > 0, size, 1)


def width_of(sizes: np.ndarray) -> np.ndarray:
    """The least width that holds each benchmark passage."""
    return np.array(WIDTHS)[np.minimum(np.searchsorted(WIDTHS, sizes), len(WIDTHS) - 1)]


def thresholds(windows: list[np.ndarray], queries: np.ndarray, project: np.ndarray, df: np.ndarray,
               part: float = PART, cosine: float = COSINE, seed: int = SEED) -> dict[int, float]:
    """The cosine that all but MISSED of the spoilt benchmark passages reach,
    by width; ``cosine`` at most. Foreign words are drawn by their frequency."""
    rng = np.random.default_rng(seed)
    sizes = np.array(list(map(len, windows)))
    width = width_of(sizes)
    often = np.cumsum(df + 1e-9)
    foreign = lambda n: np.searchsorted(often, rng.random(n) * often[-1])
    out = {}
    for w in np.unique(width).tolist():
        got = []
        held = np.flatnonzero(width == w).tolist()
        for k in held:
            f, n = features(windows[k]), int(sizes[k])
            for _ in range(max(4, -(-SPOILT // len(held)))):
                spoilt = f.copy()
                lost = rng.choice(n, int((1 - part) * n), replace=False)
                spoilt[lost] = foreign(len(lost))
                cut = int(rng.integers(0, min(STRIDE // 2, n - 1) + 1))
                spoilt = np.concatenate([spoilt[cut:] if rng.random() < 0.5 else spoilt[:n - cut],
                                         foreign(w - n + cut)])
                got.append(float(_unit(project[spoilt].sum(axis=0)[None])[0] @ queries[k]))
        out[w] = min(cosine, float(np.quantile(got, MISSED)))
    return out


@dataclass
class Index:
    items: list[Item]
    project: np.ndarray
    queries: np.ndarray         # (windows, rank), unit length
    own: np.ndarray             # item of each window
    sizes: np.ndarray           # words of each window
    least: dict[int, float]     # cosine of a candidate, by width
    full: float = FULL
    part: float = PART
    answer: float = ANSWER

    @cached_property
    def kinds(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Each item's features and how often it has them."""
        return [np.unique(features(item.words), return_counts=True) for item in self.items]

    def holding(self, k: int, f: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Whether the places from ``lo`` to ``hi`` hold enough of item k's
        words for any confirmation, each as often as the item has it."""
        own, times = self.kinds[k]
        kind = np.full(DIM + 1, len(own), np.int64)
        kind[own] = np.arange(len(own))
        out = np.zeros(len(lo), bool)
        for a in range(0, len(lo), 1024):
            start, end = lo[a:a + 1024, None], hi[a:a + 1024, None]
            place = start + np.arange((end - start).max())
            held = kind[np.where(place < end, f[np.minimum(place, len(f) - 1)], DIM)]
            held += np.arange(len(start))[:, None] * (len(own) + 1)
            count = np.bincount(held.ravel(), minlength=len(start) * (len(own) + 1))
            common = np.minimum(count.reshape(len(start), -1)[:, :-1], times).sum(axis=1)
            out[a:a + 1024] = common >= self.part * len(self.items[k].words)
        return out

    @cached_property
    def table(self) -> np.ndarray:
        """The projection with a row of 0 for empty places."""
        return np.append(self.project, np.zeros_like(self.project, shape=(1, self.project.shape[1])), axis=0)

    @cached_property
    def by_width(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Width, items and transposed vectors of the benchmark's passages."""
        width = width_of(self.sizes)
        return [(w, self.own[width == w], np.ascontiguousarray(self.queries[width == w].T))
                for w in np.unique(width).tolist()]

    def confirm(self, item: Item, near: list[int]) -> tuple[int, float, bool]:
        """Common words in order, share of the item, leak or not."""
        n = len(item.words)
        hits = [w for w in near if w in item.masks]
        if len(hits) < self.part * n:
            return 0, 0.0, False
        size = common_subsequence(item.masks, n, hits)
        if size >= self.full * n:
            return size, size / n, True
        if size < self.part * n:
            return size, size / n, False
        got = common_subsequence(_masks(item.answer), len(item.answer), hits)
        return size, size / n, got >= self.answer * len(item.answer)

    def search(self, texts: list[str | None]) -> list[tuple[int, int, float, int, float]]:
        """(text, item, cosine, common words, share) of the leaks."""
        words, bounds = terms(texts)
        starts, doc = blocks_of(bounds)
        if not len(starts):
            return []
        f = features(words)
        # blocks with empty ones after each text; ``real`` is the block or -1
        places, at = laid_out(f, np.diff(bounds), AFTER)
        real = np.full(len(places) // STRIDE, -1)
        real[at[starts] // STRIDE] = np.arange(len(starts))
        sums = block_sums(self.table, places)
        # candidates: row of item, block, cosine
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for a in range(0, len(sums), 2048):
            b = min(a + 2048, len(sums))
            x, blocks = sums[a:b].copy(), 1
            for width, own, vectors in self.by_width:
                for j in range(blocks, width // STRIDE):
                    x[:max(0, len(sums) - j - a)] += sums[a + j:b + j]
                blocks = width // STRIDE
                near = _unit(x) @ vectors
                able = np.flatnonzero((near.max(axis=1) >= self.least[width]) & (real[a:b] >= 0))
                if len(able):
                    near = near[able]
                    r, q = np.nonzero(near >= self.least[width])
                    found.append((own[q], real[a + able[r]], near[r, q]))
        if not found:
            return []
        item, block, cosine = (np.concatenate(c) for c in zip(*found, strict=True))
        # one candidate for each item and block: the nearest of the item's passages
        order = np.lexsort((-cosine, block, item))
        item, block, cosine = item[order], block[order], cosine[order]
        new = np.ones(len(item), bool)
        new[1:] = (item[1:] != item[:-1]) | (block[1:] != block[:-1])
        item, block, cosine = item[new], block[new], cosine[new]
        size = np.array([len(i.words) for i in self.items])
        lo = np.maximum(bounds[doc[block]], starts[block] - size[item])
        hi = np.minimum(bounds[doc[block] + 1], starts[block] + WINDOW + size[item])
        able = np.zeros(len(item), bool)
        for k in np.unique(item).tolist():
            at = np.flatnonzero(item == k)
            able[at] = self.holding(k, f, lo[at], hi[at])
        item, block, cosine, lo, hi = (c[able] for c in (item, block, cosine, lo, hi))
        order = np.lexsort((block, -cosine, item, doc[block]))
        out = []
        done: tuple[int, int] | None = None
        for j in order.tolist():
            d, k = int(doc[block[j]]), int(item[j])
            if done == (d, k):
                continue
            common, share, leak = self.confirm(self.items[k], words[lo[j]:hi[j]].tolist())
            if leak:
                out.append((d, k, min(1.0, max(0.0, float(cosine[j]))), common, share))
                done = d, k
        return out


def build_indexes(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", items: int = ITEMS, rank: int = RANK, cosine: float = COSINE,
                  **limits: float) -> Iterator[Index]:
    """One index for each block of the benchmark."""
    texts = text_features(docs.select(F.col(text).alias("text")))
    df, blocks = block_frequencies(texts)
    idf = np.log((1 + blocks) / (1 + df)) + 0.1
    rows = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    n = max(1, -(-rows.count() // (items // 2)))
    part = rows.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    passages, count = None, 0
    for k in range(n):
        held = read_items(part.where(F.col("part") == k).collect())     # half of ITEMS on average
        if held and blocks:
            windows, own = query_windows(held)
            if passages is None:
                passages = corpus_passages(texts, idf)
                count = passages.agg(F.sum("passages")).first()[0]
            project = fit_projection(passages, count, windows, idf, rank)
            queries = _unit(np.stack([project[features(w)].sum(axis=0) for w in windows]))
            least = thresholds(windows, queries, project, df, limits.get("part", PART), cosine)
            yield Index(held, project, queries, own, np.array(list(map(len, windows))), least, **limits)


LEAKS = "doc_id long, item_id long, cosine double, common_words long, item_share double"


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """doc_id, item_id, cosine, common_words, item_share for each confirmed
    pair of document and item."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    out = docs.sparkSession.createDataFrame([], LEAKS)
    for index in build_indexes(docs, benchmark, text, **options):
        out = out.unionByName(rows.mapInPandas(_leaks_of(index), LEAKS))
    return out


def _leaks_of(index: Index):
    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in chunks_by_size(frames, "text", TEXT_BATCH):
            ids = pdf["doc_id"].tolist()
            found = [(None if pd.isna(ids[d]) else int(ids[d]), index.items[k].item_id, c, n, s)
                     for d, k, c, n, s in index.search(pdf["text"].tolist())]
            got = pd.DataFrame(found, columns=["doc_id", "item_id", "cosine", "common_words", "item_share"])
            yield got.astype({"doc_id": "Int64", "item_id": "Int64"})

    return find


def remove_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no item, judged and passed on in the
    same task."""
    out = docs
    for index in build_indexes(docs, benchmark, text, **options):
        out = out.where(_holds_nothing(index)(F.col(text)))
    return out


def _holds_nothing(index: Index):
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        keep = np.ones(len(texts), bool)
        at = 0
        for pdf in chunks_by_size(iter([texts.to_frame("text")]), "text", TEXT_BATCH):
            keep[[at + d for d, *_ in index.search(pdf["text"].tolist())]] = False
            at += len(pdf)
        return pd.Series(keep)

    return clean
