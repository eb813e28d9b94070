"""Runs by definition: every period, every maximal stretch."""

from __future__ import annotations

import hashlib
import re
import zlib
from fractions import Fraction


def smallest_period(w: list) -> int:
    return next(q for q in range(1, len(w) + 1) if all(w[i] == w[i + q] for i in range(len(w) - q)))


def runs(w: list) -> list[tuple[int, int, int]]:
    found = []
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i < len(w) - q:
            end = i
            while end < len(w) - q and w[end] == w[end + q]:
                end += 1
            if end > i and end - i + q >= max(24, 3 * q) and smallest_period(w[i : end + q]) == q:
                found.append((i, end - i + q, q))
            i = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id, w: list) -> list:
    if doc_id is None or not w or zlib.crc32(str(doc_id).encode()) % 10:
        return w
    g = zlib.crc32(str(doc_id).encode()) // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]


def row(doc_id, text) -> tuple:
    w = planted(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    found = runs(w)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else None
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(found), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())
