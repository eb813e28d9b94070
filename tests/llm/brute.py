"""Plain versions of the operators: loops over lists, written from their definitions."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import xxhash


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def contamination(docs, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    wins = {}
    for item, text in items:
        w = word.findall(lower(text))
        for i in range(max(len(w) - 12, 1 if w else 0)):
            wins.setdefault(tuple(w[i : i + 13]), set()).add(item)
    lengths = {len(w) for w in wins}
    out = []
    for doc, text in docs:
        w = word.findall(lower(text))
        hit, ids = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                found = wins.get(tuple(w[i : i + n]))
                if found:
                    hit.update(range(i, i + n))
                    ids |= found
        ids.discard(None)
        digest = hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(ids), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def judged(url, rules):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = lower(re.match(r"[^/?#]*", rest)[0])
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
    fits = []
    for verdict, h, p in rules:
        if None not in (verdict, h, p) and (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(h + p), len(h), h + p, verdict))
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def rooted(n, linked):
    """Component numbers of 0..n-1 under a link test of two indexes."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def simhash_components(docs):
    prints = [fingerprint(t) for _, t in docs]
    roots = rooted(len(docs), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    low = {}
    for (doc, _), r in zip(docs, roots):
        if doc is not None:
            low[r] = min(doc, low.get(r, doc))
    return [(d, f"{p:016x}", low.get(r)) for (d, _), p, r in zip(docs, prints, roots)]


def unrepeated(docs, window=200):
    data = [(t or "").encode() for _, t in docs]
    seen = Counter(d[i : i + window] for d in data for i in range(len(d) - window + 1))
    out = []
    for (doc, _), d in zip(docs, data):
        gone = bytearray(len(d))
        for i in range(len(d) - window + 1):
            if seen[d[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        spans = sum(1 for i in range(len(d)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(d, gone) if not g)
        out.append((doc, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    text = text or ""
    found = {k: [] for k in ("email", "ip", "card", "phone")}
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found["email"].append(m.span())
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found["ip"].append(m.span())
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[ -]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found["card"].append(m.span())
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub(r"\D", "", m[0], flags=re.A)) <= 15:
            found["phone"].append(m.span())
    return found


def pii(docs):
    out = []
    for doc, text in docs:
        found = base_spans(text)
        digest = ",".join(f"{k}:{a}:{b}" for k, s in found.items() for a, b in s)
        out.append((doc, *map(len, found.values()), hashlib.sha256(digest.encode()).hexdigest()))
    return out


def token_rows(docs, encode):
    out, start = [], 0
    for doc, text in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0, d[1] or "")):
        ids = [*encode(text or ""), 0]
        crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        out.append((doc, start, len(ids), crc))
        start += len(ids)
    return out


def targets(sizes, weights=(5, 2, 1), most=3):
    """Targets per source by resharing the excess until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = float(sum(sizes.values())), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in order if s not in full)
        goal = {s: most * sizes[s] if s in full else rest * weight[s] / open_weight for s in order}
        above = {s for s in order if goal[s] > most * sizes[s]}
        if not above:
            return goal
        full |= above
        if len(full) == len(order):
            return {s: float(most * sizes[s]) for s in order}


def cosine_links(rows, bound=0.95):
    """(vec_id, n_links, component_id, kept)."""
    from math import isfinite, sqrt

    def good(v):
        return v is not None and len(v) > 0 and all(x is not None and isfinite(x) for x in v) and any(v)

    ok = [good(v) for _, v in rows]
    norm = [sqrt(sum(float(x) ** 2 for x in v)) if g else 0 for (_, v), g in zip(rows, ok)]
    links = [0] * len(rows)

    def linked(i, j):
        a, b = rows[i][1], rows[j][1]
        if not (ok[i] and ok[j]) or len(a) != len(b):
            return False
        hit = sum(float(x) * float(y) for x, y in zip(a, b)) / norm[i] / norm[j] >= bound
        links[i] += hit
        links[j] += hit
        return hit

    roots = rooted(len(rows), linked)
    low = {}
    for (vec, _), r in zip(rows, roots):
        if vec is not None:
            low[r] = min(vec, low.get(r, vec))
    return [(v, n, low.get(r), v is not None and v == low.get(r)) for (v, _), n, r in zip(rows, links, roots)]
