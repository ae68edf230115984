"""The trie of conversation prefixes (operator 11).

A turn becomes a key of fixed width, big-endian: 16 bytes of the digest of
role and text, then 4 bytes with the words of the text. A conversation is the
string of its turns' keys, and equal conversations are one sequence with the
number and the least id of its members, so a conversation that very many share
is one row. Sequences are range-partitioned and sorted by their bytes, and each
task builds adaptive radix trees (``radix``) over blocks of them. Inside a tree
bytes branch anywhere; only depths that end a turn give out nodes, those within
a compressed path too.

A node whose prefix starts neither the first nor the last key of its block lies
in that block as a whole and is given out. The nodes on the two outer paths may
go on in the next block: what the block knows of them (what hangs on them and is
closed) is kept along the path, and the outer paths of all blocks, two rows a
block, are the keys of the next level, which works like the first. Every level
has less than a thousandth of the rows of the one before, until one block is
left. Nodes whose parent was still open learn its id from the level where that
was closed, by an equi-join.

No prefix is ever written out for each conversation, and no group is gathered:
a first turn that a third of all conversations share is spread over as many
blocks as it fills. The ids that end at a node are hashed in ascending order:
they are range-partitioned by sequence and id, joined to texts of up to
``CHUNK`` ids, and a task hashes the texts of a sequence one after the other,
without gathering them. SHA-256 is sequential, so this last step of one
sequence runs in one task, on one row for every ``CHUNK`` ids.

Defined cases: rows of a NULL conv_id belong to no conversation; a NULL role or
text counts as empty; turns order by ``turn``, NULL first, and equal ones by the
digest of role and text; repeated rows are turns of their own; a conversation
that is rebuilt without turns ends at the root; an empty table has no node, not
even the root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltgrid.llm import radix
from voltgrid.llm.common import materialize, word_count

GROUP = 20                # conversations that share the donor of their first turns
HEADS = 4                 # the number of borrowed turns is below this
DIGEST, WIDTH = 16, 20    # bytes of a turn's digest, and with its words
BLOCK = 2048              # sequences of a block,
BLOCK_BYTES = 1 << 25     # or so many bytes of them
LEAST_GAIN = 0.75         # a level that leaves more of the rows than this is followed by the last one
CHUNK = 4096              # ids that are joined to one text
NONE = 2**63 - 1          # the least member where there is none yet
EMPTY = hashlib.sha256(b"").hexdigest()


# ------------------------------------------------------------- conversations

def turn_key(role: Column, text: Column) -> Column:
    """Hex of the key of a turn: digest of role and text, words of the text."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.concat(F.substring(digest, 1, 2 * DIGEST), F.lpad(F.hex(word_count(text)), 2 * (WIDTH - DIGEST), "0"))


def heads(conv_id: Column) -> Column:
    """How many first turns a conversation takes from its donor."""
    return (F.crc32(conv_id.cast("string")) % HEADS).cast("int")


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, key: every conversation as the bytes of its turns' keys, its
    first turns replaced by those of its group's first conversation."""
    # structs compare field by field, NULL first
    own = (turns.where(F.col("conv_id").isNotNull())
           .select("conv_id", F.struct("turn", turn_key(F.col("role"), F.col("text")).alias("k")).alias("t"))
           .groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list("t")), lambda t: t["k"]).alias("keys")))
    own = own.select("conv_id", "keys", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("donor"),
                     heads(F.col("conv_id")).alias("h"))
    donors = own.where("conv_id = donor").select("donor", F.slice("keys", 1, HEADS - 1).alias("first"))
    first = F.coalesce(F.col("first"), F.array().cast("array<string>"))
    rest = F.filter("keys", lambda _, i: i >= F.col("h"))
    return own.join(donors, "donor", "left").select(
        "conv_id", F.unhex(F.array_join(F.concat(F.slice(first, F.lit(1), F.col("h")), rest), "")).alias("key"))


def ends(members: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """seq, ends_sha256 of ``members`` (seq, conv_id): the digest of the ids of
    each sequence, ascending, joined by commas."""

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(seq, ids[a], ",".join(map(str, ids[a:a + chunk])))
                   for seq, group in pdf.groupby("seq", sort=False)
                   for ids in [group["conv_id"].tolist()] for a in range(0, len(ids), chunk)]
            yield pd.DataFrame(out, columns=["seq", "first", "ids"])

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for pdf in batches:
            out = []
            for seq, ids in zip(pdf["seq"], pdf["ids"]):
                if seq == now:
                    state.update(b"," + ids.encode())
                    continue
                if now is not None:
                    out.append((now, state.hexdigest()))
                now, state = seq, hashlib.sha256(ids.encode())
            yield pd.DataFrame(out, columns=["seq", "ends_sha256"])
        if now is not None:
            yield pd.DataFrame([(now, state.hexdigest())], columns=["seq", "ends_sha256"])

    chunks = (members.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
              .mapInPandas(texts, "seq string, first long, ids string"))
    return (chunks.repartition("seq").sortWithinPartitions("seq", "first")
            .mapInPandas(digests, "seq string, ends_sha256 string"))


def sequences(convs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """key, n, low, ends_sha256: the distinct sequences of ``convs`` (conv_id,
    key), which is read more than once."""
    seq = F.sha2("key", 256).alias("seq")
    count = convs.groupBy("key").agg(F.count("*").alias("n"), F.min("conv_id").alias("low")).select("*", seq)
    return count.join(ends(convs.select(seq, "conv_id"), chunk), "seq").select("key", "n", "low", "ends_sha256")


# ---------------------------------------------------------------- one block

class Known:
    """What is known of a node: members, the least of them, and of what hangs
    on it and is closed: children, leaves, saved tokens; the digest of its ends."""

    __slots__ = ("n", "low", "children", "leaves", "saved", "ends")

    def __init__(self, n: int = 0, low: int = NONE, children: int = 0, leaves: int = 0, saved: int = 0,
                 ends: str | None = None):
        self.n, self.low, self.children, self.leaves, self.saved, self.ends = n, low, children, leaves, saved, ends

    def add(self, other: Known) -> None:
        self.n += other.n
        self.low = min(self.low, other.low)
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.ends = self.ends or other.ends


def _turns_shared(a: bytes, b: bytes) -> int:
    return radix.common(a, b, 0, min(len(a), len(b))) // WIDTH


def _prefix_id(key: bytes, depth: int) -> str:
    return hashlib.sha256(key[:depth * WIDTH]).hexdigest()


PATH = ["n", "low", "children", "leaves", "saved", "ends"]
NODES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
         "node", "parent"]
LEVEL = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string, node string, parent string, key binary, top int, n array<long>, "
         "low array<long>, children array<long>, leaves array<long>, saved array<long>, ends array<string>")


def block_nodes(items: list[tuple[bytes, int, list[Known]]], whole: bool, name: bool
                ) -> tuple[list[list], list[tuple[bytes, int, list[Known]]]]:
    """The closed nodes of a block of ``items`` in order: (key, depth of the
    first entry, what is known of the nodes on its path from there on), and the
    two outer paths with what is known of theirs. ``whole``: the block is all
    there is, so every node is closed. ``name``: nodes get their ids, for the
    children that were closed before them."""
    root = radix.Node(b"", 0)
    for key, top, path in items:
        node = root
        for depth, known in enumerate(path, top):
            node = radix.insert(node, key, depth * WIDTH)
            if node.value is None:
                node.value = Known()
            node.value.add(known)
    first, last = items[0][0], items[-1][0]
    shared = _turns_shared(first, last)
    outer = [] if whole else [(first, 0, [Known() for _ in range(len(first) // WIDTH + 1)])]
    if not whole and len(items) > 1:
        outer.append((last, shared + 1, [Known() for _ in range(len(last) // WIDTH - shared)]))
    rows: list[list] = []
    hanging: dict[int, tuple[Known, list[int]]] = {}     # by branch: what its closed tops add up to, and their rows

    for node, above in radix.bottom_up(root):
        sums, tops = hanging.pop(id(node), (Known(), []))
        # turn depths within this node's own path, the deepest first
        start = above.end if above is not None else -1
        on_first = -1 if whole else _turns_shared(node.key[:node.end], first)
        on_last = -1 if whole else _turns_shared(node.key[:node.end], last)
        for depth in range(node.end // WIDTH, max(start, -1) // WIDTH, -1):
            if depth * WIDTH == node.end and node.value is not None:
                sums.add(node.value)
            if depth <= on_first or depth <= on_last:     # open: kept on an outer path, nothing is passed up
                spot = outer[0][2][depth] if depth <= on_first else outer[1][2][depth - shared - 1]
                spot.add(sums)
                pending = _prefix_id(node.key, depth) if tops else None
                for i in tops:
                    rows[i][9] = pending
                sums, tops = Known(), []
                continue
            words = int.from_bytes(node.key[depth * WIDTH - WIDTH + DIGEST:depth * WIDTH], "big") if depth else 0
            leaves, saved = sums.leaves if sums.children else 1, sums.saved + (sums.n - 1) * words
            for i in tops:
                rows[i][2] = sums.low
            rows.append([sums.low, depth, None, sums.n, sums.children, leaves, saved, sums.ends or EMPTY,
                         _prefix_id(node.key, depth) if name else None, None])
            sums, tops = Known(sums.n, sums.low, 1, leaves, saved), [len(rows) - 1]
        if above is not None:
            if id(above) in hanging:
                hanging[id(above)][0].add(sums)
                hanging[id(above)][1].extend(tops)
            else:
                hanging[id(above)] = sums, tops
    return rows, outer


# ------------------------------------------------------------------- levels

def _blocks(batches: Iterator[pd.DataFrame], read, alone: bool, most: int) -> Iterator[list]:
    block, size = [], 0
    for pdf in batches:
        for item in read(pdf):
            block.append(item)
            size += len(item[0])
            if not alone and (len(block) >= most or size >= BLOCK_BYTES and len(block) > 2):
                yield block
                block, size = [], 0
    if block:
        yield block


def _sequence_items(pdf: pd.DataFrame) -> Iterator[tuple]:
    for key, n, low, digest in zip(pdf["key"], pdf["n"], pdf["low"], pdf["ends_sha256"]):
        yield bytes(key), len(key) // WIDTH, [Known(n, low, ends=digest)]


def _path_items(pdf: pd.DataFrame) -> Iterator[tuple]:
    for key, top, *path in zip(pdf["key"], pdf["top"], *[pdf[c] for c in PATH]):
        yield bytes(key), top, [Known(*map(int, x[:5]), x[5]) for x in zip(*path)]


def _level(items: DataFrame, paths: bool, whole: bool, most: int) -> DataFrame:
    """Closed nodes and outer paths (with a key) of the blocks of ``items``."""
    read = _path_items if paths else _sequence_items

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in _blocks(batches, read, whole, most):
            rows, outer = block_nodes(block, whole, paths)
            blank = [None] * (2 + len(PATH))
            out = [[*row, *blank] for row in rows]
            out += [[*[None] * len(NODES), key, top, *[[getattr(k, c) for k in path] for c in PATH]]
                    for key, top, path in outer]
            # object first: a column with None and numbers would turn floating
            pdf = pd.DataFrame(out, columns=[c.split()[0] for c in LEVEL.split(", ")], dtype=object)
            numbers = [c.split()[0] for c in LEVEL.split(", ") if c.endswith((" long", " int"))]
            yield pdf.astype(dict.fromkeys(numbers, "Int64"))

    ordered = items.coalesce(1) if whole else items.repartitionByRange("key")
    return ordered.sortWithinPartitions("key").mapInPandas(work, LEVEL)


def prefix_trie(turns: DataFrame, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256: one row for each distinct prefix of the rebuilt
    conversations of ``turns`` (conv_id, turn, role, text)."""
    items = materialize(sequences(materialize(rebuilt(turns), "conversations"), chunk), "sequences")
    levels, before, whole = [], None, False
    while not whole:
        left, size = items.agg(F.count("*"), F.coalesce(F.sum(F.length("key")), F.lit(0))).first()
        whole = left <= block and size <= BLOCK_BYTES or before is not None and left > LEAST_GAIN * before
        level = materialize(_level(items, bool(levels), whole, block), "trie-level")
        items, before = level.where("key IS NOT NULL").select("key", "top", *PATH), left
        levels.append(level.where("key IS NULL").select(*NODES))
    nodes, later = levels[0], levels[-1]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    for level in levels[1:-1]:
        later = later.unionByName(level)
    # children that were closed before their parent
    parents = later.select(F.col("node").alias("parent"), F.col("conv_id").alias("found"))
    found = (nodes.where("parent IS NOT NULL").drop("parent_conv_id").join(parents, "parent")
             .withColumnRenamed("found", "parent_conv_id"))
    return nodes.where("parent IS NULL").select(*NODES[:8]).unionByName(found.select(*NODES[:8]))
