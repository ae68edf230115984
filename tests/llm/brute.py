"""Plain single-machine versions of the operators' contracts, for the tests."""

from __future__ import annotations

import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def tokens(rows, path, end=0):
    """{position in ascending doc_id order: (doc_id, start, n, crc)}"""
    from tokenizers import Tokenizer
    tok, at, out = Tokenizer.from_file(path), 0, []
    for d, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tok.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((d, at, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        at += len(ids)
    return out


def _luhn(d):
    s = 0
    for k, c in enumerate(d[::-1]):
        x = int(c) * (1 + k % 2)
        s += x // 10 + x % 10
    return s % 10 == 0


def base_pii(text):
    """[(kind, start, end)] by start and kind."""
    text = text or ""
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((0, "email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            found.append((1, "ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 14 <= len(digits(m.group())) <= 19 and _luhn(digits(m.group())):
            found.append((2, "card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(digits(m.group())) <= 15:
            found.append((3, "phone", *m.span()))
    return [(k, a, b) for _, k, a, b in sorted(found, key=lambda f: (f[2], f[0]))]


def pii_digest(text):
    spans = base_pii(text)
    line = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    return [sum(k == x for k, _, _ in spans) for x in ("email", "ip", "card", "phone")], hashlib.sha256(line.encode()).hexdigest()


def quality(text):
    ws, text = words(text), text or ""
    lines = [x for x in text.split("\n") if WORD.search(x)]
    runs = [tuple(ws[i:i + 8]) for i in range(len(ws) - 7)]
    twice = {r for r in runs if runs.count(r) > 1} if len(runs) < 400 else _twice(runs)
    covered = {j for i, r in enumerate(runs) if r in twice for j in range(i, i + 8)}
    return {"n_words": len(ws), "word_chars": sum(map(len, ws)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "base_failed": len(ws) < 20 or 100 * len(covered) > 30 * len(ws)}


def _twice(runs):
    seen, out = set(), set()
    for r in runs:
        (out if r in seen else seen).add(r)
    return out


def shingles(text):
    ws = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words(text)]
    if len(ws) < 5:
        return {tuple(ws)} if ws else set()
    return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)}


def near_duplicates(rows):
    """{row number: smallest doc_id reachable} over [(doc_id, text)], all pairs
    that share a shingle, 100 * intersection >= 85 * union."""
    sets = [shingles(t) for _, t in rows]
    where = {}
    for k, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(k)
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k, s in enumerate(sets):
        shared = {}
        for x in s:
            for j in where[x]:
                if j < k:
                    shared[j] = shared.get(j, 0) + 1
        for j, n in shared.items():
            if 100 * n >= 85 * (len(s) + len(sets[j]) - n):
                parent[root(k)] = root(j)
    least = {}
    for k, (d, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), d), d)
    return [least[root(k)] for k in range(len(rows))], [len(s) for s in sets]


def repeated_bytes(texts, width=200):
    """For each text: (n_bytes, n_removed, n_spans, sha256 of what remains)."""
    data = [(t or "").encode() for t in texts]
    count = {}
    for d in data:
        for i in range(len(d) - width + 1):
            key = d[i:i + width]
            count[key] = count.get(key, 0) + 1
    out = []
    for d in data:
        cover = bytearray(len(d))
        for i in range(len(d) - width + 1):
            if count[d[i:i + width]] > 1:
                cover[i:i + width] = b"\x01" * width
        kept = bytes(b for b, c in zip(d, cover) if not c)
        spans = sum(1 for i, c in enumerate(cover) if c and (i == 0 or not cover[i - 1]))
        out.append((len(d), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    return out
