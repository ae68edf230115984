"""Token counts by byte-pair merging, without identifiers (operator 12).

The count of a text is the number of its initial symbols less the number of
merges. A segment's symbols form a linked list over its characters (a symbol
is known by its first place, its link is the place behind it); a heap holds
the adjacent pairs whose union is a piece, by rank and place. The lowest rank
is popped, the pair joined, and the two pairs that the new symbol forms with
its neighbours are pushed; an entry that no longer describes a pair is passed
over. A character outside the vocabulary stands for its UTF-8 bytes, one
symbol each, and never merges.

Texts are cut before they are merged, at places that no merge can cross:
every symbol is a piece, so two characters that stand side by side in no piece
are never joined. Those cuts (before a blank, around characters that are in no
longer piece, and between letters and other characters where the vocabulary
allows it) leave words, whose counts a worker remembers. The memory is bounded
by ``REMEMBERED`` words; the words beyond are merged anew, with equal result.

The work is a projection: no shuffle, no state, so hot keys and lost executors
cost nothing but the rows of a task.

Defined cases: a NULL text counts as empty and has 0 tokens; strings that
spell special tokens are ordinary text; very long words take n log n steps;
repeated rows and any other columns pass through. The operator replaces input
columns named n_bytes, n_tokens or over_limit.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
LIMIT = 4096              # over_limit: more tokens than this
REMEMBERED = 1 << 20      # words whose counts a worker keeps
BLANK = "▁"          # the vocabulary's sign for a blank
PROBES = ("", " ", "  two  blanks ", "Tabs\tand\nlines", "<s> 12,345.67 </s>", "naïve 日本 \U0001f600  \u0000",
          "x" * 50 + " " * 70, BLANK + "a")


def merges(word: str, ranks: dict[str, int]) -> int:
    """The number of merges in ``word``; ``ranks`` has the rank of every piece
    of two characters or more, the lowest first."""
    n = len(word)
    rank = ranks.get
    heap = [(r << 32) | i for i in range(n - 1) if (r := rank(word[i:i + 2])) is not None]
    if not heap:
        return 0
    heapify(heap)
    after = list(range(1, n + 1))        # where the symbol that starts here ends; 0 if none starts here
    before = list(range(-1, n))          # the start of the symbol ahead
    done = 0
    while heap:
        entry = heappop(heap)
        i = entry & 0xFFFFFFFF
        j = after[i]
        if j == 0 or j == n:
            continue
        end = after[j]
        if rank(word[i:end]) != entry >> 32:
            continue
        after[i], after[j] = end, 0
        done += 1
        if end < n:
            before[end] = i
            if (r := rank(word[i:after[end]])) is not None:
                heappush(heap, (r << 32) | i)
        h = before[i]
        if h >= 0 and (r := rank(word[h:end])) is not None:
            heappush(heap, (r << 32) | h)
    return done


class Counter:
    """Counts tokens with the vocabulary of one sentencepiece model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [i for i in range(len(model))
                  if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        pieces = {model.id_to_piece(i): model.get_score(i) for i in normal}
        levels = {s: k for k, s in enumerate(sorted({s for p, s in pieces.items() if len(p) > 1}, reverse=True))}
        self.ranks = {p: levels[s] for p, s in pieces.items() if len(p) > 1}
        self.single = {p for p in pieces if len(p) == 1}
        joined = {c for p in self.ranks for c in p} - {BLANK}
        if not joined <= self.single | {BLANK} or any(BLANK in p.lstrip(BLANK) for p in self.ranks):
            raise ValueError("a vocabulary whose pieces start with their blanks and whose characters are pieces is needed")
        # letters and others are cut apart if no piece joins them
        letters = {c for c in joined if c.isalpha()}
        mixed = any((a in letters) != (b in letters) for p in self.ranks for a, b in zip(p, p[1:])
                    if BLANK not in (a, b))
        groups = [joined] if mixed else [letters, joined - letters]
        one = lambda cs: "[" + "".join(map(re.escape, sorted(cs))) + "]"
        self.cut = re.compile("|".join([f"{BLANK}*{one(g)}+" for g in groups if g]
                                       + [f"{BLANK}+", f"[^{BLANK}{one(joined)[1:-1]}]+"])).findall
        self.known: dict[str, int] = {}
        if any(self.count(t) != len(model.encode(t)) for t in PROBES):
            raise ValueError("a byte-pair model with byte fallback, a leading blank and unchanged text is needed")

    def word(self, word: str) -> int:
        symbols = sum(1 if c in self.single else len(c.encode()) for c in word)
        n = symbols - merges(word, self.ranks)
        if len(self.known) < REMEMBERED:
            self.known[word] = n
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        known, total, new = self.known.get, 0, []
        found = self.cut(BLANK + text.replace(" ", BLANK))
        for w, n in zip(found, map(known, found)):
            if n is None:
                new.append(w)
            else:
                total += n
        return total + sum(map(self.word, new))


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One for each worker, kept over its tasks."""
    return Counter(path)


def token_counts(docs: DataFrame, path: str, column: str = "text", limit: int = LIMIT) -> DataFrame:
    """``docs`` with n_bytes (UTF-8 bytes of the text), n_tokens and over_limit
    (more than ``limit`` tokens); ``path`` is the model file, on every node."""

    @F.pandas_udf("long")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = counter(path).count
        for texts in batches:
            yield pd.Series([count(t) for t in texts], dtype="int64")

    text = F.coalesce(F.col(f"`{column}`"), F.lit(""))
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("n_bytes", "n_tokens", "over_limit")]
    counted = docs.select(*kept, F.octet_length(text).cast("long").alias("n_bytes"), n_tokens(text).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
