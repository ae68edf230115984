"""Quality rules (operator 10): a threshold table compiled into one Spark
projection of length, symbol, stop-word, case and line ratios.

Everything is a built-in expression; there are no user functions and no
shuffle, so a document of any length is judged in the task that reads it.

Defined cases: NULL and blank texts have no words, all counts 0, and fail the
base rule; a text without letters has an upper-case ratio of 0; repeated rows
are judged alike; an empty table gives an empty result. Columns of the input
that share a name with an added one are replaced by the added one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltgrid.llm.common import SPACE_CHARS, words

SYMBOLS = "#*$%&|<>"

# Common words of the four languages of the corpus; a table of your own may
# replace it.
STOP_WORDS = {
    "en": "the of and to a in is that it for was on with as be by this are at from".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im nicht dem ein eine als".split(),
    "fr": "de la le et les des en un du une que pour est par qui dans avec sur pas au".split(),
    "es": "de la que el en y los se del las un por con no su una para es al lo".split(),
}


@dataclass(frozen=True)
class Rule:
    """A document breaks the rule if ``numerator`` is below ``least`` times
    ``denominator`` or above ``most`` times it."""

    name: str
    numerator: str
    denominator: str | None = None
    least: float | None = None
    most: float | None = None

    def broken(self) -> Column:
        base = F.col(self.denominator).cast("double") if self.denominator else F.lit(1.0)
        parts = []
        if self.least is not None:
            parts.append(F.col(self.numerator) < F.lit(self.least) * base)
        if self.most is not None:
            parts.append(F.col(self.numerator) > F.lit(self.most) * base)
        out = parts[0]
        for p in parts[1:]:
            out = out | p
        return out


BASE_RULES = (
    Rule("too_few_words", "n_words", least=20),
    Rule("repeated_windows", "n_repeat_words", "n_words", most=0.30),
)

RULES = (
    Rule("symbols", "n_symbols", "n_words", most=0.10),
    Rule("word_length", "word_chars", "n_words", least=2.0, most=15.0),
    Rule("upper_case", "n_upper", "n_letters", most=0.50),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", most=0.50),
    Rule("stop_words", "n_stop_words", least=2),
)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for the row."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(ws: Column, window: int) -> Column:
    """Words that lie in a ``window``-word run found twice or more.

    A cheap test on 64-bit hashes of the runs finds the documents that may
    repeat a run at all; only for those are the runs themselves sorted, so
    the count is exact."""
    n = F.size(ws) - (window - 1)
    pairs = _let(F.transform(ws, lambda w: F.xxhash64(w)),
                 lambda h: F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1))))
    fours = _let(pairs, lambda h: F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 2))))
    runs = _let(fours, lambda h: F.transform(F.slice(h, F.lit(1), n),
                                             lambda x, i: F.xxhash64(x, F.get(h, i + 4))))
    if window != 8:
        runs = F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice(ws, i, window)))
    may_repeat = _let(runs, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    ordered = F.sort_array(F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.struct(F.array_join(F.slice(ws, i, window), " ").alias("run"), i.alias("at"))))
    same = lambda s, i, x: F.get(s, i)["run"].eqNullSafe(x["run"])
    at = _let(ordered, lambda s: F.transform(
        F.filter(s, lambda x, i: same(s, i - 1, x) | same(s, i + 1, x)), lambda x: x["at"]))
    covered = _let(F.sort_array(at), lambda p: F.aggregate(
        F.transform(p, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(p, i + 1) - x, F.lit(window)))),
        F.lit(0), lambda a, x: a + x))
    return F.when(n < 2, F.lit(0)).when(may_repeat, covered).otherwise(F.lit(0)).cast("long")


def measures(docs: DataFrame, text: str = "text", window: int = 8,
             stop_words: dict[str, list[str]] | None = None) -> DataFrame:
    """``docs`` with the counts that the rules read."""
    t = F.coalesce(F.col(text), F.lit(""))
    stops = sorted({w for ws in (stop_words or STOP_WORDS).values() for w in ws})
    cut = lambda chars: F.length(t) - F.length(F.translate(t, chars, ""))
    ws = F.col("__llm_words")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    letters = F.regexp_replace(t, r"\P{L}+", "")
    return (docs.withColumn("__llm_words", words(F.col(text)))
            .withColumns({"__llm_lines": lines, "__llm_letters": letters})
            .withColumns({
                "n_words": F.size(ws).cast("long"),
                "word_chars": (F.length(t) - cut(SPACE_CHARS)).cast("long"),
                "n_symbols": cut(SYMBOLS).cast("long"),
                "n_lines": F.size("__llm_lines").cast("long"),
                "n_dup_lines": (F.size("__llm_lines") - F.size(F.array_distinct("__llm_lines"))).cast("long"),
                "n_letters": F.length("__llm_letters").cast("long"),
                "n_upper": F.length(F.regexp_replace("__llm_letters", r"\P{Lu}+", "")).cast("long"),
                "n_stop_words": F.size(F.filter(ws, lambda w: F.lower(w).isin(stops))).cast("long"),
                "n_repeat_words": _repeat_words(ws, window),
            }).drop("__llm_words", "__llm_lines", "__llm_letters"))


MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_letters", "n_upper",
            "n_stop_words", "n_repeat_words"]


def judge(docs: DataFrame, text: str = "text", base: tuple[Rule, ...] = BASE_RULES,
          rules: tuple[Rule, ...] = RULES, **options) -> DataFrame:
    """``docs`` with the measures, ``base_failed``, ``broken_rules`` (names, in
    table order) and ``kept``."""
    names = lambda table: F.filter(
        F.array(*[F.when(r.broken(), F.lit(r.name)) for r in table]), lambda x: x.isNotNull())
    return (measures(docs, text, **options)
            .withColumns({"base_failed": F.size(names(base)) > 0, "broken_rules": names(base + rules)})
            .withColumn("kept", F.size("broken_rules") == 0))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that break no rule, with the input's columns (an input
    column named like a measure comes back as a measure otherwise, so the
    verdict is taken from a copy of the text alone)."""
    cols = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__llm_row"),
                      F.col(text).alias("__llm_text"))
    # a filter would be pushed below the projection, with each measure spelled out again for every rule
    # that reads it; a row repeated once or not at all is not
    kept = F.explode(F.array_repeat("__llm_row", F.col("kept").cast("int"))).alias("row")
    return judge(row, "__llm_text").select(kept).select(*[F.col("row").getField(c).alias(c) for c in cols])
