"""The operators' plain parts, text by text in Python."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

LOWER = {c: c + 32 for c in range(65, 91)}


def crc(data: str | bytes) -> int:
    return zlib.crc32(data.encode() if isinstance(data, str) else data)


def shingles(text: str | None, n: int) -> frozenset:
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(w) < n:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1))


def classes(rows: list[tuple], n: int, percent: int) -> dict:
    """row number -> (size, class, links) for (doc_id, text) rows."""
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))
    links: Counter = Counter()

    def find(k: int) -> int:
        while root[k] != k:
            k = root[k]
        return k

    holders = defaultdict(list)
    for k, s in enumerate(sets):
        near = {j for x in s for j in holders[x]}
        for j in near:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                links[k] += 1
                links[j] += 1
                a, b = find(k), find(j)
                root[max(a, b)] = min(a, b)
        for x in s:
            holders[x].append(k)
    names = defaultdict(list)
    for k, (d, _) in enumerate(rows):
        names[find(k)].append(d)
    least = {r: min((d for d in ds if d is not None), default=None) for r, ds in names.items()}
    return {k: (len(sets[k]), least[find(k)] if sets[k] else rows[k][0], links[k]) for k in range(len(rows))}


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def license_base(text: str | None) -> tuple:
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        places += [(k, label) for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
    at = [k for k, _ in places]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def rule_counts(text: str | None) -> tuple:
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(zip(w, w[1:], w[2:]))
    again = {k + j for k, x in enumerate(zip(w, w[1:], w[2:])) if seen[x] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again)


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def personal(text: str | None) -> dict[str, list[tuple[int, int]]]:
    t = text or ""

    def digits(s: str) -> str:
        return re.sub("[^0-9]", "", s)

    def luhn(d: str) -> bool:
        return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(d[::-1])) % 10 == 0

    return {
        "email": [m.span() for m in EMAIL.finditer(t)],
        "ip": [m.span() for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(t) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))],
        "phone": [m.span() for m in PHONE.finditer(t) if 9 <= len(digits(m[0])) <= 15],
    }
