"""Plain, slow versions of the corpus queries' contracts, row by row."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np

KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def pii(text: str | None) -> tuple[list[int], str]:
    spans = []
    for k, kind in enumerate(KINDS):
        for m in re.finditer(PATTERNS[kind], text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else False,
                  "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                spans.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    spans.sort()
    joined = ",".join(s for _, _, s in spans)
    return [sum(k == i for _, k, _ in spans) for i in range(4)], hashlib.sha256(joined.encode()).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text: str | None, k: int) -> set[tuple[str, ...]]:
    w = words(lower(text or ""))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components(n: dict[int, int], links: list[tuple[int, int]]) -> dict[int, int]:
    root = {i: i for i in n}

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in root}


def near_duplicates(rows: list[tuple[int, str | None]], k: int = 4, pct: int = 80) -> dict[int, tuple[int, int]]:
    sets = {i: shingles(t, k) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:]
             if sets[a] and sets[b] and 100 * min(len(sets[a]), len(sets[b])) >= pct * max(len(sets[a]), len(sets[b]))
             and 100 * len(sets[a] & sets[b]) >= pct * len(sets[a] | sets[b])]
    comp = components({i: 0 for i in ids}, links)
    return {i: (len(sets[i]), comp[i]) for i in ids}


def quality(text: str | None) -> dict[str, int]:
    w = words(text)
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    inside = set()
    for i in range(len(w) - 7):
        if grams[tuple(w[i:i + 8])] > 1:
            inside |= set(range(i, i + 8))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
            "n_dup_lines": dup, "n_repeat_words": len(inside)}


PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def licenses(text: str | None) -> tuple:
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    at = [(i, label) for p, label in PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    starts = [i for i, _ in at]
    return (len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at})))


def targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, free, out = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total >= 2 * sizes[s]}
        if not over:
            out.update({s: left * weight[s] / total for s in free})
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
        left -= sum(2.0 * sizes[s] for s in over)
        free -= over
    return out


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())
