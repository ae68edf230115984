"""Operators against brute force, round trips and small awkward tables."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from conftest import SF001
from voltgrid.llm import (chat, common, components, decontam, langid, minhash, mixing, pii, quality, sharding,
                          suffixes, tokens)
from voltgrid.llm.queries import PLANTED, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use themselves, as columns of the input
CLASH = ("size", "n_words", "slot", "shard", "score", "kept", "node", "key", "copies", "pii", "spans", "h", "t1", "n")


def table(spark, rows, extra=True):
    df = spark.createDataFrame([(d, t, None, s, None) for d, t, s in rows], SCHEMA)
    return df.withColumns({c: F.lit("x") for c in CLASH}) if extra else df


LONG = " ".join(f"w{i * i % 977}" for i in range(6000))
AWKWARD = [
    (1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, "one two", "b"), (5, "one two", "b"), (5, "one two", "b"),
    (None, "a text without id that has some words in it", None), (7, LONG, "a"), (8, LONG + " tail", "a"),
    (9, "ÄÖ\u00a0ß \u2028 é \U0001f600 x", "c"), (10, "a" * 5000, "c"), (None, None, None), (11, "\x00 nul \x1c", "b"),
    (12, "1" * 3000 + " " + "1." * 500 + "@" * 50, "b"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return table(spark, AWKWARD).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


@pytest.fixture(scope="module")
def docs001(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]


# ------------------------------------------------------------------ quality

def test_quality_matches_brute_force(spark, docs001, awkward):
    for rows, df in ((docs001, spark.read.parquet(f"{SF001}/documents.parquet")),
                     ([r[:2] for r in AWKWARD], awkward)):
        got = {}
        for r in quality.judge(df).collect():
            got.setdefault((r["doc_id"], r["text"]), r)
        for d, t in rows:
            for name, value in brute.quality(t).items():
                assert got[d, t][name] == value, (d, name)


def test_quality_keeps_clean_documents(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = quality.judge(docs).join(labels, "doc_id").select("quality", "base_failed", "kept").collect()
    clean = [r for r in rows if r["quality"] == 1 and not r["base_failed"]]
    junk = [r for r in rows if r["quality"] == 0]
    assert all(r["kept"] for r in clean)
    assert sum(not r["kept"] for r in junk) >= 0.9 * len(junk)


def test_quality_empty_and_columns(empty, awkward):
    assert quality.keep_good(empty).collect() == []
    assert quality.keep_good(awkward).columns == awkward.columns
    assert {r["size"] for r in quality.keep_good(awkward).collect()} <= {"x"}


def test_other_window_widths(spark):
    df = table(spark, [(1, "a b c d a b c d x y", "s")])
    assert quality.measures(df, window=4).first()["n_repeat_words"] == 8
    assert quality.measures(df, window=8).first()["n_repeat_words"] == 0


# ------------------------------------------------------------------- mixing

def test_targets_by_resharing(spark):
    sizes = {"a": 100, "b": 1000, "c": 10, "d": 0, None: 400}
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    got = {r["source"]: r for r in mixing.source_targets(df).collect()}
    order = ["a", "b", "c", "d", None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        share = {s: total * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] >= 2 * sizes[s]}
        if not full:
            target.update(share)
            break
        for s in full:
            target[s] = 2 * sizes[s]
            total -= target[s]
        open_ -= full
    for s in order:
        assert got[s]["target"] == pytest.approx(target[s]), s
        assert got[s]["weight"] == weight[s]


def test_mix_emits_what_the_plan_says(spark, awkward, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plan = {r["doc_id"]: r for r in mixing.mixing_plan(docs).collect()}
    taken = {r["doc_id"]: r["count"] for r in mixing.mix(docs).groupBy("doc_id").count().collect()}
    assert taken == {d: r["copies"] for d, r in plan.items() if r["copies"]}
    by_source = {}
    for r in plan.values():
        s = by_source.setdefault(r["source"], [0, r["target"]])
        s[0] += r["size"] * r["copies"]
        assert 0 <= r["copies"] <= 2
    assert sum(abs(a - b) for a, b in by_source.values()) < 0.1 * sum(b for _, b in by_source.values())
    assert mixing.mix(empty).collect() == []
    mixed = mixing.mix(awkward)
    assert mixed.columns == awkward.columns
    assert all(brute.words(r["text"]) for r in mixed.collect())
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.mix(awkward.repartition(5)).collect()))


# ----------------------------------------------------------------- sharding

def plain_table(names, size):
    """The turns one after the other."""
    number = lambda x: int(hashlib.md5(x.encode()).hexdigest()[:8], 16)
    order = [[(number(f"{s}:offset") % size + k * (number(f"{s}:skip") % (size - 1) + 1)) % size for k in range(size)]
             for s in names]
    out, at, turn = {}, [0] * len(names), 0
    while len(out) < size:
        while order[turn][at[turn]] in out:
            at[turn] += 1
        out[order[turn][at[turn]]] = turn
        turn = (turn + 1) % len(names)
    return out


@pytest.mark.parametrize("shards,size", [(1, 2), (3, 7), (5, 101), (32, 4099)])
def test_lookup_table(spark, shards, size):
    names = sharding.shard_names(shards)
    got = {r["slot"]: r["shard"] for r in sharding.lookup_table(spark, names, size).collect()}
    assert got == plain_table(names, size)
    counts = np.bincount(list(got.values()), minlength=shards)
    assert counts.max() - counts.min() <= 1


def test_few_slots_move_when_a_shard_goes(spark):
    names = sharding.shard_names(8)
    before, after = plain_table(names, 997), plain_table(names[:-1], 997)
    assert sum(before[s] != after[s] for s in before if before[s] != 7) < 0.2 * 997


def test_assign_awkward(awkward, empty):
    out = sharding.assign(awkward)
    rows = out.collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r["shard"] < 32 for r in rows)
    assert len({r["slot"] for r in rows if r["doc_id"] == 5}) == 1
    assert sharding.assign(empty).collect() == []
    assert not any("Python" in line for line in out._jdf.queryExecution().toString().splitlines())
    with pytest.raises(ValueError):
        sharding.lookup_table(awkward.sparkSession, ["a", "b"], 10)


# --------------------------------------------------------------------- chat

TURNS = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "<x>", "a\\b", ""]),
                           st.text(alphabet="\\<>bglturn:/ne x\n\u00e9", max_size=30)), min_size=1, max_size=7)


@settings(max_examples=8, deadline=None)
@given(st.lists(TURNS, min_size=1, max_size=6))
def test_chat_round_trip(spark, convs):
    rows = [(c, k, r, t) for c, turns in enumerate(convs) for k, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    out = chat.format_conversations(df).select(
        "conv_id", "formatted", "n_blocks", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert len(out) == len(convs)
    for r in out:
        turns = convs[r["conv_id"]]
        assert [(x["role"], x["text"]) for x in r["turns"]] == turns
        assert r["loss"] == [t for role, t in turns if role == "assistant"]
        assert r["n_blocks"] == 1 + sum(a[0] != b[0] for a, b in zip(turns, turns[1:]))


def test_chat_awkward(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string"
    df = spark.createDataFrame([(1, 1, None, None, "x"), (1, 0, "assistant", None, "x"), (None, 0, "user", "a", "x"),
                                (2, None, "user", "b" * 100_000, "x"), (2, None, "user", "b" * 100_000, "x")], schema)
    rows = {r["conv_id"]: r for r in chat.format_conversations(df).collect()}
    assert rows[1]["formatted"] == "<turn:assistant></turn>\n<turn:></turn>\n"
    assert [tuple(s) for s in rows[1]["loss_spans"]] == [(16, 16)]
    assert rows[None]["loss_spans"] == [] and rows[2]["n_blocks"] == 1
    assert len(rows[2]["formatted"]) == 200_000 + len("<turn:user><next></turn>\n")
    assert chat.format_conversations(df.where("false")).collect() == []
    got = {r["conv_id"]: r for r in QUERIES["op5_chat_formatting"](spark, SF001).collect()}[-7]
    assert got["n_turns"] == 2 and got["loss_chars"] == len(PLANTED)
    assert got["loss_sha256"] == hashlib.sha256(PLANTED.encode()).hexdigest()


# ---------------------------------------------------------------------- pii

def base_of(text):
    return [(k, a, b) for k, a, b, _ in pii.find_spans(text) if k in pii.BASE_KINDS]


def test_pii_matches_brute_force(docs001):
    for _, text in [*docs001, *((d, t) for d, t, _ in AWKWARD)]:
        assert base_of(text) == brute.base_pii(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab@.-+0123456789 ()%\u00e9", max_size=60))
def test_pii_base_spans_on_noise(text):
    assert base_of(text) == brute.base_pii(text)


def test_pii_added_kinds():
    found = lambda t: [k for k, *_ in pii.find_spans(t)]
    assert "iban" in found("my IBAN is DE89 3704 0044 0532 0130 00 thanks")
    assert "iban" not in found("my IBAN is DE89 3704 0044 0532 0130 01 thanks")
    assert "ssn" in found("social security 123-45-6789.") and "ssn" not in found("number 123-45-6789.")
    assert "ssn" not in found("social security 666-45-6789.")
    two = "DE89 3704 0044 0532 0130 00 GB82 WEST 1234 5698 7654 32 iban"
    assert [two[a:b] for k, a, b, _ in pii.find_spans(two) if k == "iban"] == [two[:27], two[28:55]]
    after_none = "iban AB12 CD34 EF56 GH78 DE89 3704 0044 0532 0130 00"
    assert [after_none[a:b] for k, a, b, _ in pii.find_spans(after_none) if k == "iban"] == [after_none[25:]]
    for n in (20, 100, 300, 5000):
        long_token = ("a1B2" * n)[:n]
        assert [(a, b) for k, a, b, _ in pii.find_spans("token " + long_token) if k == "secret"] == [(6, 6 + n)], n
    assert "secret" in found('token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"')
    assert "secret" not in found("hash 04dbebab91ab85687d33eeaaf9ac699e1188f962")
    assert pii.redact("x a@b.co y", pii.find_spans("x a@b.co y")) == "x [EMAIL] y"


def test_pii_linear_and_awkward(awkward, empty):
    for text in ("1" * 400_000, "a" * 400_000 + "@", "1." * 200_000, "+1" * 200_000, "A1" * 200_000, "@" * 400_000):
        pii.find_spans(text)
    assert len(pii.detect(awkward).collect()) == len(AWKWARD)
    assert pii.detect(empty).collect() == []


# ------------------------------------------------------------------- tokens

def test_token_files_match_the_library(spark, awkward, empty, scratch):
    got = [tuple(r) for r in QUERIES["op4_token_files"](spark, SF001).orderBy("doc_id").collect()]
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    assert got == brute.tokens([tuple(r) for r in rows], tokens.tokenizer_path())
    out = tokens.token_files(awkward.repartition(3)).orderBy("start").collect()
    assert [r["doc_id"] for r in out] == sorted((d for d, *_ in AWKWARD), key=lambda d: (d is not None, d or 0))
    assert sorted(r["n_tokens"] for r in out) == sorted(
        n for _, _, n, _ in brute.tokens([r[:2] for r in AWKWARD], tokens.tokenizer_path()))
    assert tokens.token_files(empty).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\r.,'sdllreve\u00e9\u00a0\u2003x1Z\x00\x1c!?", max_size=40), min_size=1, max_size=4))
def test_pieces_encode_as_whole_texts(texts):
    path = tokens.tokenizer_path()
    enc = tokens.Encoder.at(path)
    for text, ids in zip(texts, enc.encode(texts), strict=True):
        assert ids.tolist() == enc.tok.encode(text, add_special_tokens=False).ids


class Counting:
    """A tokenizer that counts the characters it is given."""

    def __init__(self, tok):
        self.tok, self.given = tok, 0

    def encode_batch_fast(self, texts, **options):
        self.given += sum(map(len, texts))
        return self.tok.encode_batch_fast(texts, **options)


def test_pieces_are_remembered_whatever_white_space_they_have():
    enc = tokens.Encoder(tokens.tokenizer_path())
    first = "One two\tthree  four.\n\nFive six, seven\u00a0eight \u00e9t\u00e9. nine\nten \n "
    want = enc.encode([first])[0].tolist()
    assert want == enc.tok.encode(first, add_special_tokens=False).ids
    enc.tok = Counting(enc.tok)
    assert enc.encode([first + first])[0].tolist() == enc.tok.tok.encode(first + first, add_special_tokens=False).ids
    # only the pieces at the seam are new
    assert enc.tok.given < len(first) / 2
    # a word of the text with another mark or before a line feed
    enc.encode([","])
    enc.tok.given = 0
    enc.encode(["One six, \u00e9t\u00e9, nine, six\nten nine\nten"])
    assert enc.tok.given == 0


def test_memory_of_pieces_is_small():
    """Two workers remember their pieces beside an executor's heap."""
    enc = tokens.Encoder(tokens.tokenizer_path())
    n = 60_000
    words = " ".join(f"{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}x{k}" for k in range(n))
    long = ["z" * 5000 + str(k) for k in range(100)]
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes()
    enc.encode([words])
    enc.encode(long)
    kept = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert kept < 90 * n


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([
    *" \n\t.,!'sdtaZ19\u00e9\u00d7\u0416\u0451\u3042\u2003\u3000\u200b\u0301\u00ab\u2019\x00\x1c", "  ", " word",
    "word.", "'ll", "<|endoftext|>", "\U0001f600"]), max_size=20).map("".join), min_size=1, max_size=6))
def test_pieces_of_any_script_encode_as_whole_texts(texts):
    enc = tokens.Encoder.at(tokens.tokenizer_path())
    for text, ids in zip(texts, enc.encode(texts), strict=True):
        assert ids.tolist() == enc.tok.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_encode_whole_texts(scratch):
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers, trainers
    texts = ["One two. Three\nfour  FIVE, six", "", " one two", "one. two"]
    for split, change in ((pre_tokenizers.Metaspace(), None), (pre_tokenizers.ByteLevel(add_prefix_space=True), None),
                          (pre_tokenizers.ByteLevel(add_prefix_space=False), normalizers.Replace(". ", "_"))):
        tok = Tokenizer(models.BPE())
        tok.pre_tokenizer = split
        if change:
            tok.normalizer = change
        tok.train_from_iterator(["one two three four five six. One, Two\nThree \u2581"] * 3, trainers.BpeTrainer(
            vocab_size=400, show_progress=False, initial_alphabet=pre_tokenizers.ByteLevel.alphabet()))
        tok.save(path := f"{scratch}/t.json")
        got = tokens.Encoder(path).encode(texts)
        assert [x.tolist() for x in got] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_slices_by_bytes_keep_rows_and_order():
    batches = [pa.record_batch({"text": ["ab", "", "c" * 9, "d", "e"], "k": [0, 1, 2, 3, 4]})] * 2
    got = [b.column("k").to_pylist() for b in tokens.slices_by_bytes(batches, "text", 4)]
    assert got == [[0, 1], [2], [3, 4]] * 2


# ------------------------------------------------------------------ minhash

def near_rows(seed=3):
    """Copies, chains of near copies around a hub, and unrelated texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    rows, n = [], 0
    for size in (1, 2, 12, 40):
        base = [word() for _ in range(rng.choice([30, 200]))]
        for k in range(size):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2])):
                w[rng.randrange(len(w))] = word()
            rows.append((n, " ".join(w)))
            n += 1
    rows += [(n + k, " ".join(word() for _ in range(rng.choice([1, 3, 5, 60])))) for k in range(30)]
    rng.shuffle(rows)
    return rows


def test_near_duplicates_match_brute_force(spark):
    rows = near_rows() + [(1000, None), (1001, ""), (1002, "one two"), (1003, "ONE  two"), (1004, " \n"),
                          (1005, LONG), (1006, LONG + " tail")]
    df = table(spark, [(d, t, "s") for d, t in rows]).repartition(5)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(df).collect()}
    comp, sizes = brute.near_duplicates(rows)
    for (d, _), c, n in zip(rows, comp, sizes, strict=True):
        assert (got[d]["component_id"], got[d]["n_shingles"], got[d]["kept"]) == (c, n, d == c)


def test_every_step_finds_links(spark, monkeypatch):
    """Small blocks, crowded regions, no neighbours: the complete step
    suffices."""
    rows = near_rows(5)
    monkeypatch.setattr(minhash, "BLOCK", 7)
    monkeypatch.setattr(minhash, "CROWD", 6)
    monkeypatch.setattr(minhash, "_neighbours", lambda m: m.sparkSession.createDataFrame([], "a long, b long"))
    df = table(spark, [(d, t, "s") for d, t in rows])
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df).collect()}
    assert got == dict(zip((d for d, _ in rows), brute.near_duplicates(rows)[0], strict=True))


@pytest.mark.parametrize("percent, inner, edge", [(80, 8, 3), (85, 6, 1)])
def test_hub_of_crowded_regions(spark, percent, inner, edge):
    """A base text with 1,500 variants at the threshold, which are linked by
    the base only: each in regions of several hundred nodes."""
    rng = random.Random(percent)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base, rows = [word() for _ in range(400)], []
    for k in range(1500):
        w = list(base)
        for at in [edge, *(x + 2 for x in rng.sample(range(10, 390, 5), inner))]:
            w[at] = word()
        rows.append((k + 1, " ".join(w)))
    rows.append((0, " ".join(base)))
    hub = brute.shingles(rows[-1][1])
    for _, t in rows:
        s = brute.shingles(t)
        assert percent <= 100 * len(hub & s) / len(hub | s) < percent + 0.1 or s == hub
    got = minhash.near_duplicates(table(spark, [(d, t, "s") for d, t in rows]), percent=percent).collect()
    assert [r["doc_id"] for r in got if r["component_id"] != 0] == []


def test_pairs_of_crowded_regions_only(spark, monkeypatch):
    """Pairs that agree in trees far apart, every region crowded."""
    monkeypatch.setattr(minhash, "CROWD", 1)
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows = []
    while len(rows) < 4:
        a = [word() for _ in range(58)]
        b = [*a[:25], word(), *a[26:55], word(), *a[56:]]
        keys = minhash.region_keys(minhash.signatures(minhash.text_sets([" ".join(a), " ".join(b)])))
        same = np.flatnonzero(keys[0] == keys[1])
        if len(same) and (np.diff([*same, same[0] + minhash.TREES]) > 3).all():
            rows += [(len(rows), " ".join(a)), (len(rows) + 1, " ".join(b))]
    got = {r["doc_id"]: r["component_id"] for r in
           minhash.near_duplicates(table(spark, [(d, t, "s") for d, t in rows]), percent=70).collect()}
    assert got == {d: d // 2 * 2 for d, _ in rows}


def test_keep_one_awkward(spark, awkward, empty):
    assert minhash.near_duplicates(empty).collect() == []
    out = minhash.keep_one(awkward)
    rows = out.collect()
    assert out.columns == awkward.columns
    texts = [r["text"] for r in rows]
    assert texts.count("one two") == 1 and sum(t is not None and t.startswith(LONG) for t in texts) == 1
    assert sum(r["doc_id"] is None for r in rows) == 2        # a text of its own and a NULL


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 14), st.integers(0, 14)), max_size=16))
def test_components(spark, edges):
    parent = list(range(15))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in edges:
        lo, hi = sorted((root(a), root(b)))
        parent[hi] = lo
    got = {r["node"]: r["component"] for r in
           components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: root(k) for e in edges if e[0] != e[1] for k in e}


def test_component_steps_are_small(spark):
    """The driver keeps figures of every stage: two exchanges for a large-star
    step, three for a small-star step."""
    edges = spark.range(1, 50).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [step(edges)._jdf.queryExecution().executedPlan().toString()
                 for step in (components._large_star, components._small_star)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [len(re.findall(r"Exchange \w+", p)) for p in plans] == [2, 3]


def test_tables_of_nodes_are_not_broadcast(spark, monkeypatch):
    """The planner sizes tables after an explode and compressed tables of ids
    far too low; the joins between them shuffle, whatever it says."""
    plans = []

    def seen(df, name, *rest):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return common.materialize(df, name, *rest)

    for module in (minhash, components):
        monkeypatch.setattr(module, "materialize", seen)
    docs = [(k, " ".join(f"w{i * i % 97}" for i in range(60 + k % 3)), "s") for k in range(12)]
    out = minhash.near_duplicates(table(spark, docs))
    assert {r["component_id"] for r in out.collect()} == {0}
    # without the plans that confirm pairs: signatures and sets are sized as they are
    held = [p for name, p in plans if name in ("members", "edges") and "MapInPandas" not in p]
    assert len(held) > 4 and any("Generate" in p for p in held)
    assert not [p for p in held if "Broadcast" in p]


# ----------------------------------------------------------------- language

def test_languages_held_out(spark):
    rows = QUERIES["op6_language_id"](spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 250 and sum(r["lang"] == r["lang_pred"] for r in held) > 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_awkward(spark, awkward, empty):
    known = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "en"),
                                   ("words", None), ("1 2 3", "xx")], "text string, lang string")
    model = langid.fit(known)
    assert sorted(set(model.langs)) == ["de", "en"]
    rows = langid.predict(awkward, model).collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        letters = any(ch.isalpha() for ch in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and (letters or r["score"] == 0)
    assert langid.predict(empty, model).collect() == []
    nothing = langid.fit(known.where("false"))
    assert {r["lang_pred"] for r in langid.predict(awkward, nothing).collect()} == {"und"}


def test_ngrams_stay_in_their_text():
    both = langid.ngram_counts(["abc", "", "1 2", "x yz!"])
    for k, t in enumerate(["abc", "", "1 2", "x yz!"]):
        assert (both[k] == langid.ngram_counts([t])[0]).all()
    assert both[1].sum() == both[2].sum() == 0


# ------------------------------------------------------------ contamination

def test_leaks_recall_against_substrings(spark):
    sf = "/root/testdata/sf0.01"
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op7_decontamination"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    true = {(d["doc_id"], b["item_id"]) for d in docs for b in items if d["text"] and b["text"] in d["text"]}
    assert len(true & got) >= 0.95 * len(true)
    # what is found beyond substrings has most of the item's words in order
    norm = lambda t: re.findall(r"[^\W_]+", t.lower())
    by_id, item = {d["doc_id"]: d["text"] for d in docs}, {b["item_id"]: b["text"] for b in items}
    for d, b in got - true:
        words = norm(item[b])
        row = [0] * (len(words) + 1)
        for w in norm(by_id[d]):
            new = row[:]
            for k, x in enumerate(words):
                new[k + 1] = row[k] + 1 if w == x else max(new[k], row[k + 1])
            row = new
        assert row[-1] >= decontam.PART * len(words)


@pytest.fixture(scope="module")
def benchmark_index(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    index, = decontam.build_indexes(docs, spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet"))
    return index, decontam.terms([r["text"] for r in docs.orderBy("doc_id").limit(400).collect()])[0]


def test_index_is_fitted_on_all_passages(spark):
    """More than 40,000 passages, with repeated, long and short texts: the
    benchmark's vectors against a plain matrix of every passage."""
    rng = np.random.default_rng(11)
    vocabulary = [f"v{k}" for k in range(400)]
    text = lambda n, top: " ".join(vocabulary[k] for k in np.minimum(rng.zipf(1.3, n), top) - 1)
    texts = [text(800, 100 + k % 300) for k in range(560)] + [text(n, 400) for n in (1, 7, 8, 9, 31, 33, 70_007)]
    items = [text(n, 400) for n in (9, 16, 30, 40, 55, 70, 90) * 3]
    rows = [(k, t, "s") for k, t in enumerate([*texts, *texts[:40], texts[0], "", None, "..."])]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    index, = decontam.build_indexes(table(spark, rows), bench)

    words = lambda t: decontam.features(decontam.terms([t])[0])
    passages = lambda f, n: [f[a:a + n] for a in range(0, len(f), decontam.STRIDE)]
    blocks = [b for _, t, _ in rows for b in passages(words(t), decontam.STRIDE)]
    df = sum(np.bincount(np.unique(b), minlength=decontam.DIM) for b in blocks)
    idf = np.log((1 + len(blocks)) / (1 + df)) + 0.1
    corpus = [p for t in texts for p in passages(words(t), decontam.WINDOW)]
    assert len(corpus) > 60_000
    queries = [decontam.features(w) for w in decontam.query_windows(index.items)[0]]
    used = np.unique(np.concatenate([words(t) for t in [*texts, *items]]))
    matrix = np.zeros((len(corpus) + len(queries), len(used)), np.float32)
    for k, p in enumerate([*corpus, *queries]):
        np.add.at(matrix[k], np.searchsorted(used, p), idf[p])
        matrix[k] /= np.linalg.norm(matrix[k]) * (1 if k < len(corpus) else (len(queries) / len(corpus)) ** 0.5)
    gram = (matrix.T @ matrix).astype(float)
    rank = min(decontam.RANK, max(8, len(queries) // 2))
    q = np.random.default_rng(decontam.SEED).standard_normal((decontam.DIM, rank + decontam.EXTRA))
    q = np.linalg.qr(q)[0][used]
    for _ in range(decontam.ROUNDS - 1):
        q = np.linalg.qr(gram @ q)[0]
    value, vector = np.linalg.eigh(q.T @ gram @ q)
    top = np.argsort(-value)[:rank]
    project = np.zeros((decontam.DIM, rank))
    project[used] = (q @ vector[:, top]) / np.sqrt(value[top]) * idf[used, None]
    want = decontam._unit(np.stack([project[f].sum(axis=0) for f in queries]))
    assert np.abs(index.queries @ index.queries.T - want @ want.T).max() < 1e-3


def _other_space(index, project, queries=None):
    if queries is None:
        windows, _ = decontam.query_windows(index.items)
        queries = np.stack([project[decontam.features(w)].sum(axis=0) for w in windows])
    return decontam.Index(index.items, project, decontam._unit(queries), index.own, index.sizes, index.least)


def _search_words(index, monkeypatch, texts):
    """search() on texts that are given as word hashes."""
    bounds = np.cumsum([0, *map(len, texts)])
    with monkeypatch.context() as m:
        m.setattr(decontam, "terms", lambda _: (np.concatenate(texts), bounds))
        return index.search([""] * len(texts))


def _planted(index, words, share, replace, rng):
    """Items at every offset of a passage, ``share`` of the words kept, the
    answer whole; only those that confirm() calls a leak."""
    texts, own = [], []
    for k, item in enumerate(index.items):
        n = len(item.words)
        at = rng.choice(max(1, n - len(item.answer)), min(int((1 - share) * n), max(0, n - len(item.answer))), replace=False)
        held = item.words.copy()
        if replace:
            held[at] = rng.choice(words, len(at))
        else:
            held = np.delete(held, at)
        start, off = int(rng.integers(0, len(words) - 400)), 64 + k % 16
        text = np.concatenate([words[start:start + off], held, words[start + off:start + 200]])
        if index.confirm(item, text[max(0, off - n):off + 2 * n + decontam.WINDOW].tolist())[2]:
            texts.append(text)
            own.append(k)
    return texts, np.array(own)


@pytest.mark.parametrize("share,replace", [(1.0, True), (0.82, True), (0.82, False), (0.65, True), (0.65, False)])
def test_leaks_recall_by_length(benchmark_index, monkeypatch, share, replace):
    """Candidates come from the cosine: in the fitted space nearly all planted
    items are found, whatever their length and the share of words kept."""
    index, words = benchmark_index
    texts, own = _planted(index, words, share, replace, np.random.default_rng(5))
    assert len(texts) > 150
    got = {(d, k) for d, k, *_ in _search_words(index, monkeypatch, texts)}
    found = np.array([(d, k) in got for d, k in enumerate(own.tolist())])
    size = np.array([len(index.items[k].words) for k in own.tolist()])
    for lo, hi in ((0, 20), (20, 32), (32, 48), (48, 99)):
        held = found[(size >= lo) & (size < hi)]
        assert held.mean() >= (0.99 if share == 1 else 0.9), (lo, held.mean(), len(held))


def test_latent_space_decides(benchmark_index, monkeypatch):
    """A random projection and random vectors lose candidates that the fitted
    space has."""
    index, words = benchmark_index
    rng = np.random.default_rng(6)
    texts, own = _planted(index, words, 0.65, True, rng)
    true = set(enumerate(own.tolist()))
    hits = lambda i: len(true & {(d, k) for d, k, *_ in _search_words(i, monkeypatch, texts)})
    fitted = hits(index)
    random_space = _other_space(index, rng.standard_normal(index.project.shape).astype(np.float32))
    random_queries = _other_space(index, index.project, rng.standard_normal(index.queries.shape).astype(np.float32))
    assert fitted >= 0.95 * len(true)
    assert hits(random_space) < 0.6 * fitted
    assert hits(random_queries) < 0.1 * fitted


def test_search_against_plain_loops(benchmark_index, monkeypatch):
    """Every passage against every benchmark passage, one by one."""
    index, words = benchmark_index
    rng = np.random.default_rng(7)
    texts, _ = _planted(index, words, 0.82, True, rng)
    texts = [*texts[::12], words[:0], words[:3], words[1000:1700], np.repeat(index.items[0].words, 5)]
    width = decontam.width_of(index.sizes)
    want = set()
    for d, text in enumerate(texts):
        f = decontam.features(text)
        for a in range(0, len(text), decontam.STRIDE):
            for w in sorted(set(width.tolist())):
                v = index.project[f[a:a + w]].astype(float).sum(axis=0)
                near = index.queries[width == w] @ (v / max(np.linalg.norm(v), 1e-12))
                for k in set(index.own[width == w][near >= index.least[w]].tolist()):
                    n = len(index.items[k].words)
                    if index.confirm(index.items[k], text[max(0, a - n):a + decontam.WINDOW + n].tolist())[2]:
                        want.add((d, k))
    got = _search_words(index, monkeypatch, texts)
    assert {(d, k) for d, k, *_ in got} == want and len(got) == len(want) > 10


def test_paraphrase_and_awkward(spark, awkward, empty):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("bcdfgaeiou") for _ in range(5))
    item = [word() for _ in range(40)]
    changed = list(item)
    for k in range(0, 30, 4):
        changed[k] = word()
    docs = [(k, " ".join(word() for _ in range(120)), "s") for k in range(40)]
    docs += [(100, " ".join([word() for _ in range(50)] + item + [word() for _ in range(50)]), "s"),
             (101, " ".join([word() for _ in range(33)] + changed + [word() for _ in range(9)]), "s"),
             (102, "; ".join(item).upper(), "s"), (103, " ".join(item[:8]), "s")]
    bench = spark.createDataFrame([(1, " ".join(item) + "."), (2, None), (None, "..."), (3, "")],
                                  "item_id long, text string")
    df = table(spark, docs)
    leaks = decontam.find_leaks(df, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in leaks} == {(100, 1), (101, 1), (102, 1)}
    kept = decontam.remove_leaks(df, bench)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {*range(40), 103}
    assert decontam.find_leaks(empty, bench).collect() == []
    assert decontam.find_leaks(df, bench.where("false")).collect() == []
    assert len(decontam.remove_leaks(awkward, bench).collect()) == len(AWKWARD)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=30), st.lists(st.integers(0, 5), max_size=40))
def test_common_subsequence(a, b):
    row = [0] * (len(a) + 1)
    for w in b:
        new = row[:]
        for k, x in enumerate(a):
            new[k + 1] = row[k] + 1 if w == x else max(new[k], row[k + 1])
        row = new
    assert decontam.common_subsequence(decontam._masks(np.array(a, np.uint64)), len(a), b) == row[-1]


# ----------------------------------------------------------- repeated bytes

def digest(rows):
    return sorted((len(r["kept"]) + sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]),
                   hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in rows)


def want(texts):
    return sorted((n, k, h) for n, _, k, h in brute.repeated_bytes(texts))


def test_repeats_match_brute_force(spark, docs001, awkward, empty):
    rows = suffixes.remove_repeats(spark.read.parquet(f"{SF001}/documents.parquet")).collect()
    assert digest(rows) == want([t for _, t in docs001])
    assert digest(suffixes.remove_repeats(awkward).collect()) == want([t for _, t, _ in AWKWARD])
    assert suffixes.remove_repeats(empty).collect() == []


@pytest.mark.parametrize("crowd", [suffixes.CROWD, 3])
def test_repeats_of_passages(spark, monkeypatch, crowd):
    """Shared passages of 190 to 700 bytes in texts of their own, some inside
    one text; crowded groups; small batches and segments."""
    rng = random.Random(9)
    monkeypatch.setattr(suffixes, "BATCH", 50)
    monkeypatch.setattr(suffixes, "SEGMENT", 700)
    noise = lambda n: "".join(rng.choice("abcdefgh \u00e9") for _ in range(n))
    passages = [noise(n) for n in (190, 199, 200, 201, 260, 700)] + ["xy" * 150, "z" * 450]
    texts = [noise(rng.randrange(0, 900)) for _ in range(20)]
    for _ in range(60):
        texts.append(noise(rng.randrange(0, 300)) + rng.choice(passages) + noise(rng.randrange(0, 200))
                     + rng.choice(passages)[rng.randrange(0, 50):] + noise(rng.randrange(0, 90)))
    texts += texts[-3:]
    df = table(spark, [(k, t, "s") for k, t in enumerate(texts)]).repartition(6)
    assert digest(suffixes.remove_repeats(df, crowd=crowd).collect()) == want(texts)


def test_repeats_of_periodic_and_hot_texts(spark):
    """200 KB of one letter and of a short period, and a passage that very many
    texts hold between words of their own."""
    rng = random.Random(3)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    hot = noise(500)
    texts = ["a" * 200_000, "ab12 " * 40_000, noise(50) + "ab12 " * 60, "a" * 199 + "b"]
    texts += [noise(90) + hot + noise(90) for _ in range(300)] + [hot[40:330], hot[40:330]]
    df = table(spark, [(k, t, "s") for k, t in enumerate(texts)]).repartition(6)
    assert digest(suffixes.remove_repeats(df).collect()) == want(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=16, max_size=16), min_size=1, max_size=30), st.integers(0, 3))
def test_multikey_sort(rows, groups):
    a = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 16) % 3
    group = np.arange(len(a)) % (groups + 1)
    order, shared = suffixes.multikey_sort(a, group)
    want_ = sorted(range(len(a)), key=lambda k: (group[k], a[k].tobytes()))
    assert [(group[k], a[k].tobytes()) for k in order] == [(group[k], a[k].tobytes()) for k in want_]
    for p, (x, y) in enumerate(zip(order[:-1], order[1:], strict=True), 1):
        if group[x] != group[y]:
            assert shared[p] == -1
        else:
            n = next((i for i in range(16) if a[x][i] != a[y][i]), 16)
            assert shared[p] == n
