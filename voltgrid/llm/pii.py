"""Personal data (operator 9): regular expressions propose spans, validators
confirm them, words nearby adjust the score.

Kinds email, ip, card and phone follow fixed patterns and are kept whenever
their check passes; iban (mod 97), ssn (area and group rules) and secret (a
long token next to a word such as key or token) are kept from a score of
``min_score`` on. Documents are independent rows; the scan of a text is linear
in its length: spans are parsed from maximal runs, so no pattern backtracks
over a long run again and again.

Defined cases: NULL and empty texts have no spans; offsets are code points,
end exclusive; of equal starts the kinds keep the order of KINDS; repeated rows
give repeated results; an empty table gives an empty result. The operator
replaces an input column named pii.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Kinds in their order, patterns and context words.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "secret")
BASE_KINDS = KINDS[:4]
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
SECRET = re.compile(r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{20,}+")
CONTEXT = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "payment"), "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "account", "bank"), "ssn": ("ssn", "social", "security"),
    "secret": ("token", "key", "secret", "password", "passwd", "api"),
}
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.4, "secret": 0.2}
WINDOW = 32               # code points on either side that count as near
MIN_SCORE = 0.5

SPAN = T.StructType([T.StructField("kind", T.StringType(), False), T.StructField("start", T.IntegerType(), False),
                     T.StructField("end", T.IntegerType(), False), T.StructField("score", T.DoubleType(), False)])


def luhn(digits: str) -> bool:
    total = 0
    for k, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        d = d * 2 if k % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(code: str) -> bool:
    moved = code[4:] + code[:4]
    return int("".join(str(int(ch, 36)) for ch in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ back over the run before it; the leftmost match starts
    where that run, or what an earlier match has left of it, starts."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and (ch := text[start - 1]) < "\x80" and (ch.isalnum() or ch in "._%+-"):
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Groups of four in runs of digits with single dots between."""
    for m in DOTTED.finditer(text):
        parts, at = m.group().split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, at + size
            at += size + 1


def _digits(s: str) -> str:
    return "".join(ch for ch in s if "0" <= ch <= "9")


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if 14 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 10 <= len(_digits(m.group())) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """The scan goes on behind a confirmed span; behind the first group of
    one that isn't."""
    m = IBAN.search(text)
    while m:
        code = m.group().replace(" ", "")
        # words that follow after blanks may have been taken along: cut at blanks
        end = m.end()
        while end >= 0 and not (15 <= len(code) <= 34 and mod97(code)):
            end = text.rfind(" ", m.start(), end)
            code = text[m.start():end].replace(" ", "") if end >= 0 else ""
        if end >= 0:
            yield m.start(), end
        group = text.find(" ", m.start(), m.end())
        m = IBAN.search(text, end if end >= 0 else group if group >= 0 else m.end())


def _ssns(text: str) -> Iterator[tuple[int, int]]:
    for m in SSN.finditer(text):
        area, group, serial = m.groups()
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


def _secrets(text: str) -> Iterator[tuple[int, int]]:
    for m in SECRET.finditer(text):
        s = m.group()
        if sum(ch.isdigit() for ch in s) >= 4 and sum(ch.isalpha() for ch in s) >= 4:
            yield m.span()


def _score(kind: str, text: str, start: int, end: int) -> float:
    near = (text[max(0, start - WINDOW):start] + " " + text[end:end + WINDOW]).lower()
    words = set(re.findall(r"[a-z]+", near))
    hits = sum(1 for w in CONTEXT[kind] if w in words)
    return min(1.0, PRIOR[kind] + 0.4 * hits) if hits else PRIOR[kind]


def find_spans(text: str | None, min_score: float = MIN_SCORE) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score), by start and then kind."""
    if not text:
        return []
    has_digit = re.search("[0-9]", text) is not None
    finders = [("email", _emails)] if "@" in text else []
    if has_digit:
        finders += [("ip", _ips), ("card", _cards), ("iban", _ibans), ("ssn", _ssns), ("secret", _secrets)]
        finders += [("phone", _phones)] if "+" in text else []
    out = []
    for kind, finder in finders:
        for start, end in finder(text):
            score = _score(kind, text, start, end)
            if kind in BASE_KINDS or score >= min_score:
                out.append((kind, start, end, score))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def detect(docs: DataFrame, text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` with pii array<struct<kind, start, end, score>>."""

    @F.pandas_udf(T.ArrayType(SPAN))
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "start": a, "end": b, "score": s}
                           for k, a, b, s in find_spans(t, min_score)] for t in texts])

    return docs.withColumn("pii", spans(F.col(text)))


def joined(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end of the spans of some kinds, comma-joined."""
    return F.array_join(F.transform(F.filter(spans, lambda s: s["kind"].isin(list(kinds))), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """The text with each span (the first of those that overlap) replaced by
    its kind in brackets."""
    out, at = [], 0
    for kind, start, end, _ in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
            at = end
    return "".join([*out, text[at:]])
