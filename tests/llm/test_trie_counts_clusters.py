"""Prefix trie, token counts and clustering against brute force, the library
and small awkward tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001, SF01
from voltgrid.llm import pivots, prefix_trie, radix, token_counts
from voltgrid.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string"


# ---------------------------------------------------------------- radix tree

@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(max_size=6), max_size=60), st.lists(st.integers(0, 255), max_size=300))
def test_radix_tree_holds_what_was_put_in(keys, wide):
    """Any keys in any order, empty and prefixes of others; nodes of all four
    layouts."""
    keys += [b"wide" + bytes([b]) for b in wide]
    root = radix.Node(b"", 0)
    for k in keys:
        node = radix.insert(root, k, len(k))
        node.value = (node.value or 0) + 1
    found, order = {}, []
    for node, above in radix.bottom_up(root):
        if node.value is not None:
            found[node.key[:node.end]] = node.value
        if above is not None:
            assert node.end > above.end and node.key[:above.end] == above.key[:above.end]
            assert above.children.get(node.key[above.end]) is node
            assert node.value is not None or len(node.children) > 1       # paths are compressed
        n = len(node.children)
        assert type(node.children) is (radix.Sorted if n <= 16 else radix.Indexed if n <= 48 else radix.Direct)
        assert [c.key[node.end] for c in node.children] == sorted(c.key[node.end] for c in node.children)
        order.append(node.key[:node.end])
    assert found == {k: keys.count(k) for k in keys}


# --------------------------------------------------------------------- trie

def brute_trie(turns):
    convs = defaultdict(list)
    for c, t, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs[c].append(((t is not None, t or 0), digest, role, text))
    own = {c: [(r, x) for _, _, r, x in sorted(ts)] for c, ts in convs.items()}
    rem = lambda c: int(math.fmod(c, 20))
    rebuilt = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(own.get(c - rem(c), [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    below = defaultdict(list)
    for n in members:
        for d in range(len(n) + 1):
            below[n[:d]].append(n)
    parents = {n[:-1] for n in members if n}
    words = lambda n: len(WORD.findall(n[-1][1])) if n else 0
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m),
                   sum(1 for b in below[n] if len(b) == len(n) + 1), sum(1 for b in below[n] if b not in parents),
                   sum((len(members[b]) - 1) * words(b) for b in below[n]),
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(n)).encode()).hexdigest())
                  for n, m in members.items())


def trie_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def check_trie(spark, turns, *blocks, **more):
    df = spark.createDataFrame(turns, SCHEMA).withColumns(
        {c: F.lit("x") for c in ("key", "n", "low", "depth", "node", "h", "donor", "seq", "keys")}).repartition(3)
    want = sorted(brute_trie(turns), key=str)
    for block in blocks:
        assert trie_rows(prefix_trie.prefix_trie(df, block=block, **more)) == want, block


AWKWARD = [
    (0, None, "user", "first"), (0, 0, "user", "hello there"), (0, 1, None, None), (0, 1, None, None), (0, 2, "", ""),
    (20, 0, "user", "hello there"), (21, 0, "user", "hello there"), (22, 3, "user", "hello there"),
    (None, 0, "user", "nobody"), (45, 0, "a", "b"), (-7, 0, "user", "x y z"), (-21, 0, "user", "x y z"),
    (2**53 + 1, 0, "us", "er"), (2**53 + 2, 0, "user", ""), (2**53 + 3, 0, "", "user"), (7, 0, "user", "word " * 3000),
    (60, 0, "user", "a"), (60, 0, "user", "b"), (60, 0, "user", "a"), (61, 5, "assistant", "\x1c  é\n"),
]


def test_trie_of_awkward_turns(spark):
    check_trie(spark, AWKWARD, 1, 2, 3, 2048)


def test_trie_of_shared_and_long_conversations(spark):
    """A conversation that a third share, a first turn that nearly all share,
    prefixes of each other, and one of 700 turns: in one block and in many
    levels of blocks."""
    rnd = random.Random(4)
    turns = []
    for c in range(400):
        if c % 3 == 0:
            texts = ["hot", "one two", "three"]
        else:
            texts = ["hot"] * (c % 11 != 0) + [f"t{rnd.randrange(3)}" for _ in range(rnd.randrange(6))]
        turns += [(c, i, "ua"[i % 2], t) for i, t in enumerate(texts)]
    turns += [(4001, i, "u", f"long {i % 5}") for i in range(700)] + [(4002, i, "u", f"long {i % 5}") for i in range(350)]
    check_trie(spark, turns, 5, 60, 2048)


def test_trie_ends_beyond_one_text(spark):
    """More members than a text of ids holds."""
    check_trie(spark, [(c, 0, "u", "same") for c in range(100)], 2048, chunk=7)


def test_trie_of_the_test_tables_and_empty(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    turns = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select(*SCHEMA.replace(" long", "").replace(" string", "").split(", ")).collect()]
    assert trie_rows(QUERIES["op11_prefix_trie"](spark, SF001)) == sorted(brute_trie(turns), key=str)


# ------------------------------------------------------------- token counts

PATH = public_tokenizers.path(token_counts.MODEL)
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)
COUNTER = token_counts.Counter(PATH)

TEXTS = [None, "", " ", "   ", "a", " a", "a ", "▁", "▁▁ ▁", "<s> </s> <unk> <0x0A>", "\x00\x01", "\n\n\t", "a" * 5000,
         " " * 3000, "ab" * 4000, "é" * 900, "1234567890" * 50, "日本語テキスト", "\U0001f600\U0001f468‍\U0001f469",
         "don't stop-believing (now)!!! ...", "x  y   z    w", "﻿​ ", "Ünïcödé ß ﬁ ｆｕｌｌ", "ⅫⅩ½²",
         " ".join(f"w{i * i % 977}" for i in range(6000))]


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="ab ▁.,1\n<>/sé日", max_size=60)
       | st.lists(st.sampled_from(["the", "in", "er", " ", "  ", "ing", "▁", ".", "1", "ation", "\n"]), max_size=30).map("".join))
def test_counts_equal_the_library(text):
    assert COUNTER.count(text) == len(MODEL.encode(text))


def test_counts_of_awkward_rows(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS * 2)], "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("n_tokens", "N_BYTES", "over_limit", "word")})
    out = token_counts.token_counts(df, PATH, limit=100)
    assert out.columns == ["doc_id", "text", "word", "n_bytes", "n_tokens", "over_limit"]
    for r in out.collect():
        t = TEXTS[r.doc_id % len(TEXTS)] or ""
        n = len(MODEL.encode(t))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 100), t[:40]
    assert token_counts.token_counts(df.where("1 = 0"), PATH).collect() == []


def test_counts_of_documents_and_a_full_memory(spark, monkeypatch):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op12_token_counts"](spark, SF01).collect()}
    want = dict(zip(docs, map(len, MODEL.encode(list(docs.values())))))
    assert {d: r.n_tokens for d, r in got.items()} == want
    assert {d for d, r in got.items() if r.over_limit} == {d for d, n in want.items() if n > 4096}
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    small = token_counts.Counter(PATH)
    assert [small.count(docs[d]) for d in list(docs)[:40]] == [want[d] for d in list(docs)[:40]]
    assert len(small.known) == 3


def test_other_models_are_refused():
    with pytest.raises(Exception):
        token_counts.Counter(public_tokenizers.path("byte_bpe_50k.json"))


# --------------------------------------------------------------- clustering

def brute_clusters(rows, k=40, rounds=5, dim=64, seed=2):
    kept = [(i, [math.floor(256 * float(x)) for x in e]) for i, e in rows
            if e is not None and len(e) == dim and all(x is not None and math.isfinite(x) for x in e)]
    name = lambda i: "" if i is None else str(i)
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{name(r[0])}".encode()).hexdigest(), r[1]))[:k]
    cents = [v for _, v in start]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    place = lambda v: min((far(v, c), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[place(v)[1]].append(v)
        cents = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(cents)]
    placed = [(i, *place(v)) for i, v in kept]
    per = defaultdict(int)
    for _, d, j in placed:
        per[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, j, d, per[j], sum(per.values()), digest[j]) for i, d, j in placed), key=str)


def cluster_rows(df):
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)
                   for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns(
        {c: F.lit("x") for c in ("v", "cluster", "distance", "to_pivots", "h")}).repartition(3)


def test_clusters_of_awkward_vectors(spark):
    """NULL, short, long and non-finite vectors, repeated rows and ids, ids
    beyond 2^53, ties, and a vector that very many share."""
    rng = np.random.default_rng(6)
    vec = lambda n=4: [float(np.float32(x)) for x in rng.normal(0, 1, n)]
    rows = [(i, vec()) for i in range(60)] + [(2**53 + i, vec()) for i in range(4)]
    rows += [(100 + i, [0.25, -0.25, 0.0, 1.0]) for i in range(80)] + [(3, rows[3][1]), (3, vec()), (None, vec()), (None, vec())]
    rows += [(200, None), (201, []), (202, vec(3)), (203, vec(5)), (204, [1.0, None, 0.0, 0.0]),
             (205, [1.0, float("nan"), 0.0, 0.0]), (206, [float("inf"), 0.0, 0.0, 0.0])]
    for k, p in ((7, 3), (7, 24), (300, 2), (1, 1)):
        got = pivots.cluster(frame(spark, rows), k=k, rounds=3, pivots=p, dimensions=4)
        assert cluster_rows(got) == brute_clusters(rows, k, 3, 4), (k, p)


def test_clusters_of_the_test_tables_and_empty(spark):
    df = spark.read.parquet(f"{SF001}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert cluster_rows(QUERIES["op13_centroid_clustering"](spark, SF001)) == brute_clusters(rows)
    assert pivots.cluster(df.where("1 = 0")).collect() == []


def test_too_large_components_raise(spark):
    with pytest.raises(Exception, match="2\\^27"):
        pivots.cluster(frame(spark, [(1, [1e30, 0.0, 0.0, 0.0])]), k=1, dimensions=4).collect()


def test_pivots_spare_distances_and_ties_go_to_the_smaller(spark):
    """Two far groups: a vector is measured against its own group's centroids
    only; equal centroids give the smaller number."""
    rng = np.random.default_rng(7)
    v = rng.integers(-20, 20, (500, 8)).astype(np.int64) + np.repeat([[0], [5000]], 250, axis=0)
    cents = np.concatenate([v[:5], v[:5], v[-10:]])
    fixed = v[[0, 260]]
    cluster, best, exact = pivots.nearest(v, pivots.pivot_distances(v, fixed), cents, pivots.pivot_distances(cents, fixed))
    every = ((v[:, None, :] - cents[None]) ** 2).sum(axis=2)
    assert (cluster == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert exact <= 500 * 11 and not set(cluster) & set(range(5, 10))
