"""Token files (operator 4): ids of a public tokenizer, compressed document by
document with one shared zstandard dictionary.

``write_tokens`` range-partitions the documents by doc_id, encodes each whole
text, appends the end id and writes Parquet rows that are blocks of compressed
documents: payload (the documents' zstandard frames, one after the other), an
offset index (doc_ids, offsets, lengths, counts), the shard and block numbers, the
ids of the shard before the block and the dictionary's hash. Any document is read by decompressing its frame
alone. Beside the blocks lies the dictionary, one row. Spark's writer commits
the files, so a retried task leaves no half file.

The dictionary is trained on a bounded sample: ``sample_ids`` ids in a row, from
a hashed place, of each of the ``sample_docs`` documents with the smallest hash
(a compression aid only; every document is stored whole).

Encoding: a text is cut where a pre-token starts whatever follows (before a
blank or a line feed that follows no white space, after a line feed alone,
before a mark that follows a letter), equal pieces of a batch are encoded once,
and a worker remembers pieces it has seen, as Arrow arrays; new ones are encoded
many at a time, with a line feed (a pre-token and a token of its own) between
them. The ids equal those of encoding the whole text (a property test checks
it). A tokenizer whose pre-tokens start elsewhere encodes whole texts.

Defined cases: a NULL text is an empty one, so only the end id is stored; a
NULL doc_id sorts first; of equal doc_ids the texts' hashes decide; equal rows
are stored each; an empty table gives no blocks and an empty result; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltgrid.llm.common import chunks_by_size, materialize, scratch_path

END_ID = 0
TOKENIZER = "byte_bpe_50k.json"
SAMPLE_DOCS = 1000
SAMPLE_IDS = 2048
SEED = 7
DICT_BYTES = 64 * 1024
LEVEL = 3
BLOCK_BYTES = 4 << 20
TEXT_BATCH = 4 << 20        # bytes of text encoded together
READ_BATCH = 4 << 20        # bytes of ids given back together
CACHE_PIECES = 1_000_000    # pieces a worker remembers; later ones are encoded with each batch
CACHE_LENGTH = 64           # bytes of the longest piece it remembers
JOINED = 1 << 12            # pieces encoded as one text

# White space that isn't a blank or a line feed, with some characters that only
# other Unicode versions count as such: no piece starts after it.
OTHER_SPACE = "".join(map(chr, (
    0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)))
# A piece that line feeds on both sides could change.
ODD = f"[{OTHER_SPACE}\n]|(?s:. )|^ $"
# Kinds of bytes: ASCII characters that are no white space, the first bytes of characters that
# are none, ASCII letters, marks.
SOLID = np.isin(np.arange(256), np.arange(0x21, 0x7F))
HEAD = SOLID | np.isin(np.arange(256), [*range(0xC3, 0xE0), *range(0xE4, 0xEF), *range(0xF0, 0xF5)])
LETTER = np.isin(np.arange(256), [*range(0x41, 0x5B), *range(0x61, 0x7B)])
MARK = np.isin(np.arange(256), list(b".,!;:?"))
WIDE_SPACE = np.array(sorted(int.from_bytes(c.encode(), "big") for c in OTHER_SPACE if ord(c) > 0x7F))

BLOCKS = ("shard int, block int, first long, dict_hash string, doc_ids array<bigint>, offsets array<bigint>, "
          "lengths array<bigint>, counts array<bigint>, payload binary")


BLOCKS_ARROW = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()),
                          ("dict_hash", pa.string()),
                          *((c, pa.list_(pa.int64())) for c in ("doc_ids", "offsets", "lengths", "counts")),
                          ("payload", pa.binary())])


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def cuts(data: np.ndarray) -> np.ndarray:
    """A flag for each byte of UTF-8 (and one for the end): whether a piece may start there. At
    the start of a text the flag says nothing."""
    begins = np.zeros(len(data) + 1, bool)

    def solid(at: np.ndarray) -> np.ndarray:
        """Those places that follow a character that is no white space."""
        at = at[at > 0]
        last = data[at - 1]
        good = SOLID[last]
        far = np.flatnonzero(last > 0x7F)
        if len(far):
            two = data[at[far] - 2].astype(np.int32) << 8 | last[far]
            three = data[at[far] - 3].astype(np.int32) << 16 | two
            good[far] = ~(np.isin(two, WIDE_SPACE) | np.isin(three, WIDE_SPACE))
        return at[good]

    begins[solid(np.flatnonzero(data == 0x20))] = True
    feeds = solid(np.flatnonzero(data == 0x0A))
    begins[feeds] = True
    feeds = feeds[feeds < len(data) - 1]
    begins[feeds[HEAD[data[feeds + 1]]] + 1] = True
    marks = np.flatnonzero(MARK[data[1:]]) + 1
    last, lead = data[marks - 1], data[marks - 2]
    # letters of two bytes: U+00C0 to U+00FF without the two signs among them, U+0400 to U+047F
    wide = (last > 0x7F) & ((lead == 0xC3) & (last != 0x97) & (last != 0xB7) | (lead == 0xD0) | (lead == 0xD1))
    begins[marks[LETTER[last] | wide]] = True
    return begins


class Encoder:
    """The tokenizer with a memory of pieces; one per Python worker and file."""

    _open: dict[str, Encoder] = {}

    def __init__(self, path: str):
        # a task has one core; threads of its own would only cost
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.words = pa.array([], pa.string())
        self.ids = pa.array([], pa.large_binary())
        line = self.tok.encode("\n", add_special_tokens=False).ids
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        split = made.get("pre_tokenizer") or {}
        # the cuts are those of this pre-tokenizer's pattern
        self.cut = (len(line) == 1 and split.get("type") == "ByteLevel" and split.get("use_regex", True)
                    and not split.get("add_prefix_space") and not made.get("normalizer")
                    and not made["model"].get("dropout")
                    and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or set(t["content"]) & set(" \n.,!;:?")
                                for t in made.get("added_tokens", ())))
        self.line = line[0] if self.cut else None

    @classmethod
    def at(cls, path: str) -> Encoder:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(self.tok.encode_batch_fast([t], add_special_tokens=False)[0].ids, np.uint32) for t in texts]

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces without line feeds, encoded with line feeds between: the number of each
        piece's ids, and all of them."""
        ids = self._plain(["\n".join(pieces)])[0]
        ends = np.flatnonzero(ids == self.line)
        if len(ends) == len(pieces) - 1:
            return np.diff(ends, prepend=-1, append=len(ids)) - 1, ids[ids != self.line]
        each = self._plain(pieces)
        return np.fromiter(map(len, each), np.int64, len(each)), np.concatenate(each)

    def _pieces(self, pieces: pa.Array) -> pa.Array:
        """Ids of distinct pieces, four bytes each."""
        sizes, flat = [np.zeros(1, np.int64)], [np.zeros(0, np.uint32)]
        odd = pc.match_substring_regex(pieces, ODD).to_numpy(zero_copy_only=False)
        order = np.argsort(odd, kind="stable")
        n = len(odd) - int(odd.sum())
        for a in range(0, n, JOINED):
            some, ids = self._joined(pieces.take(pa.array(order[a:min(n, a + JOINED)])).to_pylist())
            sizes.append(some)
            flat.append(ids)
        for k in order[n:].tolist():
            flat += self._plain([pieces[k].as_py()])
            sizes.append(np.array([len(flat[-1])]))
        ends = 4 * np.cumsum(np.concatenate(sizes))
        found = pa.Array.from_buffers(pa.large_binary(), len(odd),
                                      [None, pa.py_buffer(ends), pa.py_buffer(np.concatenate(flat))])
        back = np.empty(len(odd), np.int64)
        back[order] = np.arange(len(odd))
        return found.take(pa.array(back))

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (strings without nulls), one text after the other, and where each
        text's start, with the end."""
        if not self.cut:
            each = [self._plain([t])[0] for t in column.to_pylist()]
            bounds = np.cumsum([0, *map(len, each)])
            return np.concatenate([np.zeros(0, np.uint32), *each]), bounds
        large = pa.types.is_large_string(column.type)
        _, places, content = column.buffers()
        starts = np.zeros(1, np.int64) if places is None or not len(column) else np.frombuffer(
            places, np.int64 if large else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
        if starts[0] == starts[-1]:
            return np.zeros(0, np.uint32), np.zeros(len(column) + 1, np.int64)
        data = np.frombuffer(content, np.uint8)[starts[0]:starts[-1]]
        starts -= starts[0]
        begins = cuts(data)
        begins[starts] = True
        places = np.flatnonzero(begins).astype(np.int32)
        codes = pa.Array.from_buffers(pa.string(), len(places) - 1,
                                      [None, pa.py_buffer(places), pa.py_buffer(data)]).dictionary_encode()
        words = codes.dictionary
        # the seen are looked up among the batch's, which are fewer
        seen = pc.fill_null(pc.index_in(self.words, value_set=words), -1).to_numpy(zero_copy_only=False)
        at = np.full(len(words), -1, np.int64)
        hits = np.flatnonzero(seen >= 0)
        at[seen[hits]] = hits
        new = np.flatnonzero(at < 0)
        ids = self.ids
        if len(new):
            fresh = words.take(pa.array(new))
            encoded = self._pieces(fresh)
            at[new] = np.arange(len(ids), len(ids) + len(new))
            ids = pa.concat_arrays([ids, encoded])
            if len(self.words) < CACHE_PIECES:
                short = pc.less_equal(pc.binary_length(fresh), CACHE_LENGTH)
                self.words = pa.concat_arrays([self.words, fresh.filter(short)])
                self.ids = pa.concat_arrays([self.ids, encoded.filter(short)])
        taken = ids.take(pa.array(at[codes.indices.to_numpy()]))
        ends = np.frombuffer(taken.buffers()[1], np.int64)[:len(taken) + 1]
        flat = np.frombuffer(taken.buffers()[2], np.uint32)[:ends[-1] // 4]
        return flat, ends[np.searchsorted(places, starts)] // 4

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        flat, bounds = self.encode_column(pa.array(texts, pa.large_string()))
        return [flat[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def slices_by_bytes(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches again, in pieces of about ``limit`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        size = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
        piece = np.cumsum(size, dtype=np.int64) // limit
        edges = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(batch)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


def serialize(ids: np.ndarray) -> bytes:
    """Little-endian unsigned 32-bit."""
    return ids.astype("<u4").tobytes()


def train_dictionary(docs: DataFrame, path: str, doc_id: str, text: str, sample_docs: int,
                     sample_ids: int) -> bytes:
    """Trained where the sample meets: one task (with one Python worker) with ``sample_docs`` slices of
    ``sample_ids`` ids at most; a row of ``DICT_BYTES`` comes back."""
    key = F.xxhash64(F.lit(SEED), F.col(doc_id).cast("string"), F.octet_length(text))
    # a rate of four times the sample first, so that few texts meet for the last choice
    rate = min(1.0, 4 * sample_docs / max(1, docs.count()))
    below = min(2**63 - 1, int(rate * 2**64) - 2**63)
    few = docs.where((F.octet_length(text) > 0) & (key <= below))
    sample = few.select(key.alias("key"), F.col(text).alias("text")).orderBy("key", F.md5("text")).limit(sample_docs)

    def train(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        enc, samples = Encoder.at(path), []
        for pdf in chunks_by_size(frames, "text", TEXT_BATCH):
            for t, x in zip(pdf["text"], enc.encode(pdf["text"].tolist()), strict=True):
                at = zlib.crc32(t.encode()) % max(1, len(x) - sample_ids + 1)
                samples.append(serialize(x[at:at + sample_ids]))
        total = sum(map(len, samples))
        try:
            out = zstandard.train_dictionary(min(DICT_BYTES, max(1024, total // 8)), samples).as_bytes()
        except zstandard.ZstdError:     # too few samples: their bytes are the dictionary
            out = b"".join(samples)[-DICT_BYTES:]
        yield pd.DataFrame({"dictionary": [out]})

    rows = sample.select("text").coalesce(1).mapInPandas(train, "dictionary binary").collect()
    return bytes(rows[0][0]) if rows else b""


def _dictionary(data: bytes):
    import zstandard
    return zstandard.ZstdCompressionDict(data) if data else None


def write_tokens(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                 tokenizer: str | None = None, end_id: int = END_ID, sample_docs: int = SAMPLE_DOCS,
                 sample_ids: int = SAMPLE_IDS, level: int = LEVEL) -> None:
    """Write blocks and dictionary under ``path`` (any file system of Spark)."""
    spark = docs.sparkSession
    tokenizer = tokenizer or tokenizer_path()
    data = train_dictionary(docs, tokenizer, doc_id, text, sample_docs, sample_ids)
    tag = hashlib.sha256(data).hexdigest()
    (spark.range(1).select(F.lit(bytearray(data)).alias("dictionary"), F.lit(tag).alias("dict_hash"))
     .write.parquet(f"{path}/dictionary"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = (rows.withColumn("tie", F.xxhash64("text"))
               .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("tie"))
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")
               .select(F.spark_partition_id().alias("shard"), "doc_id", "text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        zd = _dictionary(data)
        zc = zstandard.ZstdCompressor(level=level, dict_data=zd) if zd else zstandard.ZstdCompressor(level=level)
        enc, end = Encoder.at(tokenizer), serialize(np.array([end_id]))
        held: list[tuple] = []
        size = block = first = 0

        def flush(shard):
            lengths = [len(f) for _, f, _ in held]
            return pa.RecordBatch.from_pydict({
                "shard": [shard], "block": [block], "first": [first], "dict_hash": [tag],
                "doc_ids": [[d for d, _, _ in held]],
                "offsets": [[0, *np.cumsum(lengths[:-1]).tolist()]], "lengths": [lengths],
                "counts": [[n for _, _, n in held]], "payload": [b"".join(f for _, f, _ in held)]}, BLOCKS_ARROW)

        shard = None
        for batch in slices_by_bytes(batches, "text", TEXT_BATCH):
            shard = batch.column("shard")[0].as_py()
            ids, bounds = enc.encode_column(batch.column("text"))
            for d, a, b in zip(batch.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(),
                               strict=True):
                held.append((d, zc.compress(serialize(ids[a:b]) + end), b - a + 1))
                size += len(held[-1][1])
                if size >= BLOCK_BYTES:
                    yield flush(shard)
                    first += sum(n for _, _, n in held)
                    held, size, block = [], 0, block + 1
        if held:
            yield flush(shard)

    ordered.mapInArrow(encode, BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids binary (little-endian unsigned 32-bit),
    one row per stored document.

    Where a shard starts is a running sum over one small row per shard, read
    from the index columns alone and written, so that its size is known."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    held = spark.read.parquet(f"{path}/dictionary").select("dictionary", "dict_hash").first()
    data, tag = bytes(held[0]), held[1]
    if hashlib.sha256(data).hexdigest() != tag:
        raise ValueError("the dictionary doesn't match its hash")
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    per = blocks.groupBy("shard").agg(F.sum(total).alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(per.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "starts")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        zd = _dictionary(data)
        zr = zstandard.ZstdDecompressor(dict_data=zd) if zd else zstandard.ZstdDecompressor()
        for b in (row for batch in batches for k in range(len(batch)) for row in batch.slice(k, 1).to_pylist()):
            if b["dict_hash"] != tag:
                raise ValueError(f"block {b['shard']}/{b['block']} was written with another dictionary")
            payload = memoryview(b["payload"])
            counts = np.array(b["counts"], np.int64)
            start = b["base"] + b["first"] + np.cumsum(counts) - counts
            part = np.cumsum(4 * counts) // READ_BATCH
            edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(counts)]
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                yield pa.RecordBatch.from_arrays([
                    pa.array(b["doc_ids"][i:j], pa.int64()), pa.array(start[i:j]), pa.array(counts[i:j]),
                    pa.array([zr.decompress(payload[o:o + n]) for o, n in
                              zip(b["offsets"][i:j], b["lengths"][i:j], strict=True)], pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])

    return blocks.join(starts, "shard").mapInArrow(
        decode, "doc_id long, start long, n_tokens long, ids binary")


def token_files(docs: DataFrame, **options) -> DataFrame:
    """Write the documents into a new folder of the session's checkpoint
    folder and read them back."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, **options)
    return read_tokens(docs.sparkSession, path)
