"""Repeated byte strings by a sparse suffix sort (operator 8).

Every string of ``width`` bytes that occurs at two places is found, and each
byte that such a string covers is removed. The suffixes that are sorted start
at sample positions fixed by content: in each window of ``width`` bytes the
positions of the least fingerprint of GRAM bytes. Two equal windows have equal
samples, so each repeated window shows up at a sample with the same GRAM
leading bytes, and only one suffix in some 75 is ever moved.

1. Samples (fingerprint of the leading GRAM bytes, text, position) are dealt
   by range with sampled splitters and sorted; those whose fingerprint occurs
   once are dropped. Neighbours on both sides of a splitter share no leading
   bytes, as equal ones are dealt together.
2. What is left gets its surroundings from its text: the ``width`` bytes of
   the suffix and up to width - GRAM bytes before it, and their digest. A task
   gives out the bytes of equal surroundings once and the digest for the other
   places. Places whose surroundings another place has are repeated as a whole;
   they are found by counting digests (partial sums), so the inside of a
   passage that very many texts share, or of a periodic text, costs a few
   numbers a place.
3. The different surroundings are dealt by range again. A bucket sorts the
   suffixes with equal leading bytes by multikey quicksort, eight bytes a key,
   and the bytes before them likewise, backwards; common prefixes of neighbours
   then tell, for each of the windows around a sample, which are equal byte for
   byte. Groups that cross a batch are carried over. A task's memory bounds what
   it can sort: a group of more than CROWD different surroundings (35 MB) goes
   by the windows' 128-bit digests, counted with partial sums, instead.
4. The windows' bytes are merged per text.

A text is known by its md5 (128 bits); copies of a text are one text, and a
text that two rows hold is removed whole (if it has ``width`` bytes). Long texts
are sampled in overlapping segments.

Defined cases: NULL texts are empty; texts below ``width`` bytes keep all;
matches never cross texts; runs of one byte and periodic texts overlap
themselves and count; repeated rows are copies; an empty table gives an empty
result; the result has doc_id, n_bytes, spans and kept, further columns are
ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltgrid.llm.common import chunks_by_size, materialize, mix64

WIDTH = 200
GRAM = 48
SEGMENT = 1 << 20
CROWD = 100_000
REMEMBERED = 1 << 20         # surroundings that a task knows to have given out
BATCH = 30_000              # suffixes sorted together, about 11 MB of bytes

_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, n of each."""
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _POWERS:
        both = []
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            both.append(np.cumprod(p))
        _POWERS[size] = tuple(both)
    up, down = _POWERS[size]
    return up[:n], down[:n]


def _sliding(x: np.ndarray, n: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each run of n neighbours."""
    done = 1
    while done * 2 <= n:
        x = pick(x[:-done], x[done:])
        done *= 2
    return x if done == n else pick(x[:done - n], x[n - done:])


def sample(data: bytes, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Sample positions of one segment and the fingerprints of their leading
    bytes (int64); nothing if it is shorter than ``width``."""
    n, span = len(data), width - gram + 1
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    prints = mix64((total[gram:] - total[:-gram]) * down[:n + 1 - gram])
    high = (prints >> np.uint64(32)).astype(np.uint32)
    least = _sliding(high, span, np.minimum)            # of the window that starts here
    edge = np.zeros(span - 1, np.uint32)
    most = _sliding(np.concatenate([edge, least, edge]), span, np.maximum)
    at = np.flatnonzero(high == most)
    return at, prints[at].view(np.int64)


def _text_key(text: Column) -> list[Column]:
    digest = F.md5(F.coalesce(text, F.lit("")))
    return [F.conv(F.substring(digest, a, 16), 16, -10).cast("long").alias(k) for k, a in (("t1", 1), ("t2", 17))]


def _samples(docs: DataFrame, text: str, width: int) -> DataFrame:
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()        # 16 bytes for each text of this partition: copies in it are sampled once
        for pdf in chunks_by_size(frames, "text", SEGMENT):
            out = []
            for t in pdf["text"]:
                data = (t or "").encode()
                if len(data) < width or (digest := hashlib.md5(data).digest()) in seen:
                    continue
                seen.add(digest)
                t1, t2 = struct.unpack(">qq", digest)
                for base in range(0, len(data) - width + 1, SEGMENT):
                    at, h = sample(data[base:base + SEGMENT + width - 1], width)
                    out.append((h, np.full(len(h), t1), np.full(len(h), t2), at + base))
            if out:
                h, t1, t2, at = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pd.DataFrame({"h": h, "t1": t1, "t2": t2, "at": at})

    return docs.select(F.col(text).alias("text")).mapInPandas(rows, "h long, t1 long, t2 long, at long")


def _repeated(samples: DataFrame) -> DataFrame:
    """The samples whose fingerprint two places share."""
    cols = ["h", "t1", "t2", "at"]

    def pick(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, told = None, False        # the last row, and whether it has been given out
        for pdf in frames:
            a = np.stack([pdf[c].to_numpy(np.int64) for c in cols])
            if held is not None:
                a = np.concatenate([held, a], axis=1)
            other = (a[:, 1:] != a[:, :-1]).any(axis=0)
            new = np.concatenate([[True], other])       # a place again is dropped
            new[0] = held is None or not told
            first = np.flatnonzero(np.concatenate([[True], other]))
            b = a[:, first]
            same = b[0, 1:] == b[0, :-1]
            keep = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            if told:
                keep[0] = True                           # given out before, not again below
            give = keep.copy()
            give[0] &= not told
            last_kept = bool(keep[-1])
            yield pd.DataFrame(dict(zip(cols, b[:, give], strict=True)))
            held, told = b[:, -1:], last_kept

    return (samples.repartitionByRange("h").sortWithinPartitions(*cols)
            .mapInPandas(pick, "h long, t1 long, t2 long, at long"))


AROUND = ("h long, t1 long, t2 long, at long, s1 long, s2 long, n_left int, n_right int, before binary, after binary")


def _surroundings(docs: DataFrame, text: str, places: DataFrame, width: int) -> DataFrame:
    """Of each sample its place, the digest of the bytes around it (s1, s2) and
    their numbers, read from one row of each text; the bytes themselves where
    the task has not given out equal ones."""
    back = width - GRAM
    key = _text_key(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    one = rows.select(*key, "doc_id").groupBy("t1", "t2").agg(F.min("doc_id").alias("from_id"))
    # of one text: no more than its length
    by_text = (places.groupBy("t1", "t2").agg(F.collect_list(F.struct("at", "h")).alias("places"))
               .join(one, ["t1", "t2"]).withColumnsRenamed({"t1": "p1", "t2": "p2"}))
    # doc_id is a key of the join: only one of a text's copies meets its places
    held = (rows.select(*key, "doc_id", "text").join(by_text, (F.col("t1") == F.col("p1")) & (F.col("t2") == F.col("p2"))
                                                     & F.col("doc_id").eqNullSafe(F.col("from_id")))
            .select("t1", "t2", "text", "places"))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        given: set[bytes] = set()
        for pdf in chunks_by_size(frames, "text", SEGMENT):
            out = []
            for t1, t2, t, places in pdf.itertuples(index=False):
                data = t.encode()
                for p in places:
                    at = p["at"]
                    before, after = data[max(0, at - back):at], data[at:at + width]
                    digest = hashlib.md5(b"%d:" % len(before) + before + after).digest()
                    new = digest not in given
                    if new:
                        if len(given) >= REMEMBERED:
                            given.clear()
                        given.add(digest)
                    out.append((p["h"], t1, t2, at, *struct.unpack(">qq", digest), len(before), len(after),
                                before if new else None, after if new else None))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in AROUND.split(", ")])

    return held.mapInPandas(cut, AROUND)


def _spans_of_equal(around: DataFrame, width: int) -> DataFrame:
    """Places whose surroundings occur at another place, all bytes of them."""
    place = F.xxhash64("t1", "t2", "at")
    twice = materialize(around.groupBy("s1", "s2").agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
                        .where("lo < hi").select("s1", "s2"), "equal")
    return (around.where(F.col("n_left") + F.col("n_right") >= width).drop("before", "after")
            .join(twice, ["s1", "s2"], "left_semi")
            .select("t1", "t2", (F.col("at") - F.col("n_left")).alias("start"), (F.col("at") + F.col("n_right")).alias("end")))


def multikey_sort(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the byte rows within their groups, and for each in that order
    the bytes it shares with the one before (-1 at a group's start).

    Multikey quicksort with eight bytes as a key: rows that tie on all keys so
    far are sorted by the next key, the others rest."""
    n, size = rows.shape
    keys = rows.reshape(n, size // 8, 8).view(">u8")[:, :, 0]
    order = np.argsort(group, kind="stable")
    start = np.concatenate([[True], group[order][1:] != group[order][:-1]])
    for k in range(keys.shape[1]):
        cls = np.cumsum(start)
        tied = ~start
        tied[:-1] |= tied[1:]           # members of classes of two or more
        live = np.flatnonzero(tied)
        if not len(live):
            break
        rank = np.lexsort((keys[order[live], k], cls[live]))
        order[live] = order[live[rank]]
        v, c = keys[order[live], k], cls[live]
        start[live[1:]] |= (v[1:] != v[:-1]) | (c[1:] != c[:-1])
    shared = np.full(n, -1)
    g = group[order]
    inner = np.flatnonzero(np.concatenate([[False], g[1:] == g[:-1]]))
    for part in np.array_split(inner, max(1, len(inner) // 20_000)):
        differ = rows[order[part]] != rows[order[part - 1]]
        shared[part] = np.where(differ.any(axis=1), differ.argmax(axis=1), size)
    return order, shared


def _padded(parts: list[bytes], size: int) -> np.ndarray:
    return np.frombuffer(b"".join(p.ljust(size, b"\0") for p in parts), np.uint8).reshape(len(parts), size)


def equal_windows(h: np.ndarray, before: list[bytes], after: list[bytes], width: int = WIDTH,
                  gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last): the windows that start ``first`` to ``last`` bytes
    before the row's sample are equal to one of another row of its group."""
    n, back = len(h), width - gram
    left_size = -(-back // 8) * 8
    left = _padded([b[::-1] for b in before], left_size)
    right = _padded(after, -(-width // 8) * 8)
    n_left = np.fromiter(map(len, before), np.int64, n)
    n_right = np.fromiter(map(len, after), np.int64, n)
    _, group = np.unique(h, return_inverse=True)
    # equal leading fingerprints with other leading bytes part here
    order_r, shared_r = multikey_sort(right, group)
    order_l, shared_l = multikey_sort(left, group)
    repeated = np.zeros((back + 1, n), bool)
    cls_r, cls_l = np.empty(n, np.int64), np.empty(n, np.int64)
    for l in range(back + 1):
        cls_r[order_r] = np.cumsum(shared_r < width - l)
        cls_l[order_l] = np.cumsum(shared_l < l)
        fits = np.flatnonzero((n_left >= l) & (n_right >= width - l))
        key = cls_r[fits] * (n + 1) + cls_l[fits]
        rank = np.argsort(key, kind="stable")
        same = key[rank][1:] == key[rank][:-1]
        hit = np.concatenate([[False], same]) | np.concatenate([same, [False]]) if len(rank) else np.zeros(0, bool)
        repeated[l, fits[rank[hit]]] = True
    flat = np.zeros((n, back + 3), np.int8)
    flat[:, 1:-1] = repeated.T
    turn = np.diff(flat, axis=1)
    row, first = np.nonzero(turn == 1)
    _, last = np.nonzero(turn == -1)
    return row, first, last - 1


def _spans_in_buckets(around: DataFrame, width: int) -> DataFrame:
    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def work(pdf):
            pdf = pdf.drop_duplicates(["s1", "s2"])
            row, first, last = equal_windows(pdf["h"].to_numpy(), pdf["before"].tolist(), pdf["after"].tolist(), width)
            at = pdf["at"].to_numpy()[row]
            return pd.DataFrame({"t1": pdf["t1"].to_numpy()[row], "t2": pdf["t2"].to_numpy()[row],
                                 "start": at - last, "end": at - first + width})

        for pdf in frames:
            held.append(pdf)
            size += len(pdf)
            if size >= BATCH:
                both = pd.concat(held, ignore_index=True)
                # the last group may go on
                cut = int(np.searchsorted(both["h"].to_numpy(), both["h"].iat[-1]))
                if cut:
                    yield work(both.iloc[:cut])
                held, size = [both.iloc[cut:]], len(both) - cut
        if size:
            yield work(pd.concat(held, ignore_index=True))

    return (around.repartitionByRange("h").sortWithinPartitions("h")
            .mapInPandas(compare, "t1 long, t2 long, start long, end long"))


def _spans_by_digest(around: DataFrame, width: int) -> DataFrame:
    """The same for crowded groups: every window by its digest."""
    def windows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for a in range(0, len(pdf), 200):
                out = []
                for r in pdf.iloc[a:a + 200].itertuples(index=False):
                    data, back = r.before + r.after, len(r.before)
                    for i in range(min(back, len(data) - width) + 1):
                        w1, w2 = struct.unpack(">qq", hashlib.md5(data[i:i + width]).digest())
                        out.append((w1, w2, r.t1, r.t2, r.at - back + i))
                yield pd.DataFrame(out, columns=["w1", "w2", "t1", "t2", "start"])

    every = materialize(around.select("t1", "t2", "at", "before", "after").mapInPandas(
        windows, "w1 long, w2 long, t1 long, t2 long, start long"), "windows")
    place = F.xxhash64("t1", "t2", "start")
    twice = every.groupBy("w1", "w2").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).where("lo < hi")
    return (every.join(twice.select("w1", "w2"), ["w1", "w2"], "left_semi")
            .select("t1", "t2", "start", (F.col("start") + width).alias("end")).distinct())


def repeated_spans(docs: DataFrame, text: str = "text", width: int = WIDTH, crowd: int = CROWD) -> DataFrame:
    """t1, t2 (the text's md5), spans array<struct<start, end>> of each text
    with a repeated window; overlapping spans are not merged yet."""
    places = materialize(_repeated(materialize(_samples(docs, text, width), "samples")), "places")
    around = materialize(_surroundings(docs, text, places, width), "surroundings")
    with_bytes = around.where(F.col("after").isNotNull()).drop("n_left", "n_right")
    crowded = materialize(with_bytes.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("h"),
                          "crowded")
    found = _spans_of_equal(around, width)
    if crowded.isEmpty():
        found = found.unionByName(_spans_in_buckets(with_bytes, width))
    else:
        found = (found.unionByName(_spans_in_buckets(with_bytes.join(crowded, "h", "left_anti"), width))
                 .unionByName(_spans_by_digest(with_bytes.join(crowded, "h", "left_semi"), width)))
    return found.groupBy("t1", "t2").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the spans' bytes."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, text: str = "text", width: int = WIDTH, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_bytes, spans (maximal runs of removed bytes), kept (the
    other bytes) for each row of ``docs``."""
    key = _text_key(F.col("text"))
    rows = docs.select(F.col("doc_id"), F.col(text).alias("text"))
    copies = rows.select(*key).groupBy("t1", "t2").agg(F.count("*").alias("n")).where("n > 1")
    marks = (repeated_spans(docs, text, width, crowd).join(copies, ["t1", "t2"], "full")
             .select("t1", "t2", "spans", (F.coalesce("n", F.lit(1)) > 1).alias("copied")))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in chunks_by_size(frames, "text", 8 * SEGMENT):
            spans, kept, sizes = [], [], []
            for t, found, copied in zip(pdf["text"], pdf["spans"], pdf["copied"], strict=True):
                data = (t or "").encode()
                sizes.append(len(data))
                if copied is True and len(data) >= width:
                    runs = [(0, len(data))]
                else:
                    runs = merged([(s["start"], s["end"]) for s in found]) if found is not None else []
                ends = [0, *(b for _, b in runs)]
                starts = [*(a for a, _ in runs), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(ends, starts, strict=True)))
                spans.append([{"start": a, "end": b} for a, b in runs])
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_bytes": sizes, "spans": spans, "kept": kept})

    joined = (rows.select("doc_id", "text", *key).join(marks, ["t1", "t2"], "left")
              .select("doc_id", "text", "spans", F.coalesce("copied", F.lit(False)).alias("copied")))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInPandas(cut, f"doc_id {kind}, n_bytes long, spans array<struct<start: bigint, end: bigint>>, "
                                   "kept binary")
