"""MinHash near-duplicates with an LSH forest (operator 2).

A document's set is its distinct five-word shingles (A-Z lower-cased). Equal
sets are one node, so exact copies, however many, cost a grouped minimum. Each
node has TREES signature orders; the first DEPTH values of an order are its
region. Every region takes part in all steps, however many nodes it has.
Candidates are, in turn,

1. in every region, each node with the region's first node; in a region of more
   than CROWD nodes also with the first of those that agree in the next tree;
2. in regions that still hold several components, the neighbours in the sorted
   order of the tree: those with the longest common prefix;
3. the nodes of regions that then still hold several components, gathered by
   the regions they share: every pair of different components whose signatures
   agree as far as a true link's would.

Candidates are confirmed on the full sets; links never come from signatures.
Step 3 makes the search complete: what steps 1 and 2 leave out are pairs whose
ends are connected already. A pair at the threshold of 0.85 is in no common
region with a probability below 1e-7 (0.8: below 4e-6), whatever the sizes of
its regions.

Step 3 compares blocks of BLOCK nodes with each other, but for those of the
largest component with themselves. A task holds two blocks with their sets,
confirms its pairs itself and gives out links that connect components, at most
one for each of its nodes. Links, components and sets stay distributed.

Defined cases: texts without words (or NULL) have no shingles and no links;
component_id is the smallest non-NULL doc_id of the component, kept is true
for rows whose doc_id equals it (and for a NULL doc_id alone in its
component); repeated rows are exact copies; an empty table gives an empty
result. Further columns are ignored by ``near_duplicates``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltgrid.llm.common import chunks_by_size, materialize, mix64, shuffled
from voltgrid.llm.components import components
from voltgrid.llm.shingles import distinct_by_text, shingle_hashes, word_hashes

TREES, DEPTH = 24, 4
HASHES = TREES * DEPTH
PERCENT = 85
CROWD = 256
BLOCK = 512
TEXT_BATCH = 2 << 20

_seed = mix64(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FLIP = (_seed[:HASHES] >> np.uint64(32)).astype(np.uint32)
_TIMES = (_seed[HASHES:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of HASHES minima for each non-empty set."""
    flat = np.concatenate(sets)
    low = (flat ^ (flat >> np.uint64(32))).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[:-1]])]).astype(np.int64)
    out = np.empty((len(sets), HASHES), np.uint32)
    for j in range(HASHES):
        x = (low ^ _FLIP[j]) * _TIMES[j]
        x ^= x >> np.uint32(15)
        out[:, j] = np.minimum.reduceat(x * _TIMES[-1 - j], starts)
    return out


def region_keys(sig: np.ndarray) -> np.ndarray:
    """(rows, TREES) int64: a hash of tree and first DEPTH values."""
    key = np.arange(1, TREES + 1, dtype=np.uint64)[None, :] * np.uint64(0xD1342543DE82EF95)
    part = sig.reshape(len(sig), TREES, DEPTH).astype(np.uint64)
    for d in range(DEPTH):
        key = mix64(key ^ (part[:, :, d] + np.uint64(d << 40)))
    return key.astype(np.int64)


def text_sets(texts: list[str | None]) -> list[np.ndarray]:
    return distinct_by_text(*shingle_hashes(*word_hashes([(t or "").encode() for t in texts])))


def least_agreement(percent: int) -> int:
    """Signature values that agree, at least, for a pair at the threshold: 6.5
    standard deviations below the mean."""
    p = percent / 100
    return max(0, math.floor(HASHES * p - 6.5 * math.sqrt(HASHES * p * (1 - p))))


def _sketches(docs: DataFrame, text: str) -> DataFrame:
    """Each row's doc_id with digest of the set, size, region keys and the
    signature's low bytes."""

    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in chunks_by_size(frames, "text", TEXT_BATCH):
            sets = text_sets(pdf["text"].tolist())
            full = [k for k, s in enumerate(sets) if len(s)]
            keys, sig = [None] * len(sets), [None] * len(sets)
            if full:
                values = signatures([sets[k] for k in full])
                for k, row, low in zip(full, region_keys(values), values.astype(np.uint8), strict=True):
                    keys[k], sig[k] = row, low.tobytes()
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"], "digest": [hashlib.md5(s.tobytes()).digest() for s in sets],
                "text_key": pdf["text_key"], "n_shingles": [len(s) for s in sets], "keys": keys, "sig": sig})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"),
                       F.md5(F.coalesce(F.col(text), F.lit(""))).alias("text_key"))
    return rows.mapInPandas(sketch, "doc_id long, digest binary, text_key string, n_shingles long, "
                                    "keys array<bigint>, sig binary")


def _confirm(pairs: DataFrame, sketches: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links, on the full sets; signatures only
    rule out pairs that are far off."""
    least = least_agreement(percent)
    sig = lambda side: sketches.select(F.col("node").alias(side), F.col("sig").alias(f"sig_{side}"))
    held = lambda side: sets.select(F.col("node").alias(side), F.col("items").alias(f"items_{side}"))

    def near(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                a, b = (np.frombuffer(b"".join(pdf[c]), np.uint8).reshape(len(pdf), HASHES) for c in ("sig_a", "sig_b"))
                yield pdf.loc[(a == b).sum(axis=1) >= least, ["a", "b"]]

    def links(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            keep = []
            for x, y in zip(pdf["items_a"], pdf["items_b"], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pdf.loc[keep, ["a", "b"]]

    close = (pairs.join(sig("a"), "a").join(sig("b"), "b").select("a", "b", "sig_a", "sig_b")
             .mapInPandas(near, "a long, b long"))
    return (close.join(held("a"), "a").join(held("b"), "b").select("a", "b", "items_a", "items_b")
            .mapInPandas(links, "a long, b long"))


def _neighbours(members: DataFrame) -> DataFrame:
    """Pairs next to each other in a tree's order that aren't connected yet.
    The order is dealt by range, so a crowded region is shared by tasks; a
    pair that a range boundary parts is left to the complete step."""

    def adjacent(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for pdf in frames:
            both = pdf if last is None else pd.concat([last, pdf], ignore_index=True)
            p, q = both.iloc[:-1], both.iloc[1:]
            ok = (p["key"].to_numpy() == q["key"].to_numpy()) & (p["component"].to_numpy() != q["component"].to_numpy())
            yield pd.DataFrame({"a": p["node"].to_numpy()[ok], "b": q["node"].to_numpy()[ok]})
            last = both.iloc[-1:]

    order = members.select("key", "node", "component", "sig")
    return (order.repartitionByRange("key", "sig", "node").sortWithinPartitions("key", "sig", "node")
            .mapInPandas(adjacent, "a long, b long")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return int((y[at] == x).sum())


def _across(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components among nodes that regions connect,
    compared and confirmed block by block."""
    least = least_agreement(percent)
    shared = members.select(F.col("first").alias("a"), F.col("node").alias("b"))
    gathered = materialize(components(shared).withColumnRenamed("component", "cluster"), "clusters")
    named = shuffled(gathered).join(members.select("node", "component", "sig").distinct(), "node")
    # blocks of a cluster: first those of its largest component, then the others
    size = named.groupBy("cluster", "component").agg(F.count("*").alias("size"))
    blocks = (size.groupBy("cluster").agg(F.max(F.struct("size", "component")).alias("top"), F.sum("size").alias("all"))
              .where(F.col("all") > F.col("top.size"))
              .select("cluster", F.col("top.component").alias("most"),
                      F.ceil(F.col("top.size") / BLOCK).cast("int").alias("m"),
                      F.ceil((F.col("all") - F.col("top.size")) / BLOCK).cast("int").alias("n")))
    top = F.col("component") == F.col("most")
    own = F.when(top, F.pmod(F.xxhash64("node"), "m")).otherwise(F.col("m") + F.pmod(F.xxhash64("node"), "n"))
    dealt = (named.join(blocks, "cluster").join(sets, "node")
             .select("cluster", "node", "component", "sig", "items", own.cast("int").alias("own"),
                     F.explode(F.sequence(F.when(top, F.col("m")).otherwise(0), F.col("m") + F.col("n") - 1))
                     .alias("other"))
             .select("cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     "own", "node", "component", "sig", "items"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        node, own = pdf["node"].to_numpy(), pdf["own"].to_numpy()
        names, comp = np.unique(pdf["component"].to_numpy(), return_inverse=True)
        items = [np.frombuffer(x, np.uint64) for x in pdf["items"]]
        sig = np.frombuffer(b"".join(pdf["sig"]), np.uint8).reshape(len(pdf), HASHES)
        within = pdf["i"].iat[0] == pdf["j"].iat[0]
        group = np.arange(len(names))           # components that links of this task have joined
        out = []
        for k in range(1, len(node)):
            other = group[comp[:k]] != group[comp[k]]
            if not within:
                other &= own[:k] != own[k]
            at = np.flatnonzero(other)
            at = at[(sig[at] == sig[k]).sum(axis=1) >= least]
            for m in at.tolist():
                if group[comp[m]] == group[comp[k]]:
                    continue
                both = _common(items[m], items[k])
                if 100 * both >= percent * (len(items[m]) + len(items[k]) - both):
                    out.append((min(node[m], node[k]), max(node[m], node[k])))
                    group[group == group[comp[k]]] = group[comp[m]]
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    return dealt.groupBy("cluster", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def _open_regions(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members, with components, of the regions that hold several."""
    named = members.join(shuffled(found), "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    return named.join(several.select("key"), "key", "left_semi")


def near_duplicates(docs: DataFrame, text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs`` (which has doc_id and ``text``): doc_id,
    digest (of the set, 16 bytes), text_key, n_shingles, component_id, kept,
    stays (kept, and the first by text where several rows share the doc_id)."""
    rows = materialize(_sketches(docs, text), "sketches")
    full = rows.where("n_shingles > 0")
    # the first row of a set: by doc_id, NULL last, then by text
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    nodes = materialize(
        full.groupBy("digest").agg(F.min(row).alias("from"),
                                   F.first("keys").alias("keys"), F.first("sig").alias("sig"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    places = nodes.select("node", F.posexplode("keys").alias("tree", "key"))
    regions = places.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("first")).where("n > 1")
    members = materialize(places.join(shuffled(regions), "key").select("key", "node", "tree", "first", "n"), "members")
    # the nodes of a crowded region that agree in the next tree, too
    closer = (members.where(F.col("n") > CROWD).select("node", "tree")
              .join(shuffled(nodes.select("node", "keys")), "node")
              .select("node", F.xxhash64("tree", F.get("keys", F.col("tree")),
                                         F.get("keys", (F.col("tree") + 1) % TREES)).alias("key")))
    closer = closer.join(closer.groupBy("key").agg(F.min("node").alias("first")), "key")
    wanted = (nodes.join(shuffled(members.select("node").distinct()), "node", "left_semi")
              .select("node", F.col("from.doc_id").alias("from_id"), F.col("from.text_key").alias("text_key")))
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"),
                         F.md5(F.coalesce(F.col(text), F.lit(""))).alias("text_key"))
             .join(wanted, "text_key").where(F.col("doc_id").eqNullSafe(F.col("from_id"))))

    def items(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in chunks_by_size(frames, "text", TEXT_BATCH):
            yield pd.DataFrame({"node": pdf["node"], "items": [s.tobytes() for s in text_sets(pdf["text"].tolist())]})

    # rows repeated with their doc_id repeat the node: one stays
    sets = materialize(texts.dropDuplicates(["node"]).select("node", "text")
                       .mapInPandas(items, "node long, items binary"), "sets")

    pairs = (members.select("first", "node").unionByName(closer.select("first", "node")).where("first < node")
             .select(F.col("first").alias("a"), F.col("node").alias("b")).distinct())
    found = materialize(components(_confirm(pairs, nodes, sets, percent)), "components")
    sigs = nodes.select("node", "sig")
    for step in (lambda m: _confirm(_neighbours(m), nodes, sets, percent), lambda m: _across(m, sets, percent)):
        left = materialize(_open_regions(members, found).join(sigs, "node"), "open-regions")
        if left.isEmpty():
            break
        # stars of the components so far stand for their links
        stars = found.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = materialize(components(stars.unionByName(step(left))), "components")

    named = nodes.select("node", "digest", "from").join(shuffled(found), "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("from").alias("first"))
    by_set = named.join(least, "component").select("digest", "first")
    linked = F.col("n_shingles") > 0
    return (rows.select("doc_id", "digest", "text_key", "n_shingles").join(by_set, "digest", "left")
            .withColumn("component_id", F.when(linked, F.col("first.doc_id")).otherwise(F.col("doc_id")))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
            .withColumn("stays", F.col("kept") & (~linked | (F.col("text_key") == F.col("first.text_key"))))
            .drop("first"))


def keep_one(docs: DataFrame, text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, with the input's columns: one for each
    component, and each row without words."""
    cols = docs.columns
    key = lambda doc_id, text_key: F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), text_key)
    judged = near_duplicates(docs, text, percent).where("stays")
    stays = judged.select(key(F.col("doc_id"), F.col("text_key")).alias("__llm_key")).distinct()
    rows = docs.withColumn("__llm_key", key(F.col("doc_id"), F.md5(F.coalesce(F.col(text), F.lit("")))))
    return rows.join(stays, "__llm_key", "left_semi").dropDuplicates(["__llm_key"]).select(
        *[F.col(f"`{c}`") for c in cols])
