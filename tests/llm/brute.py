"""Plain single-machine versions of the training-data operators, for comparison."""

import hashlib
import re
import zlib


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def ngrams(text, n=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def repeated_words(rows, window=13):
    least = {}
    for i, t in rows:
        w = words(t)
        for s in range(len(w) - window + 1):
            k = tuple(w[s : s + window])
            if i is not None:
                least[k] = min(least.get(k, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if i is not None and least[tuple(w[s : s + window])] < i:
                gone[s : s + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def repeated_bytes(rows, width=50):
    least = {}
    for i, t in rows:
        b = (t or "").encode()
        for s in range(len(b) - width + 1):
            k = b[s : s + width]
            if i is not None:
                least[k] = min(least.get(k, i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - width + 1):
            if i is not None and least[b[s : s + width]] < i:
                gone[s : s + width] = b"\1" * width
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def jaccard(rows, threshold=0.8, n=5):
    """(id, class, group, n_ngrams, links) by comparing all sets."""
    sets = [ngrams(t, n) for _, t in rows]
    live = [x for x in range(len(rows)) if rows[x][0] is not None]
    links = {x: [] for x in live}
    by_gram = {}
    for x in live:
        for g in sets[x] or [None]:
            by_gram.setdefault(g, []).append(x)
    for x in live:
        common = {}
        for g in sets[x] or [None]:
            for y in by_gram[g]:
                common[y] = common.get(y, 0) + 1
        for y, c in common.items():
            union = (len(sets[x]) or 1) + (len(sets[y]) or 1) - c
            if y != x and c / union >= threshold - 1e-12:
                links[x].append(y)
    group = {x: x for x in live}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for x in live:
        for y in links[x]:
            a, b = root(x), root(y)
            if a != b:
                group[max(a, b)] = min(a, b)
    least = {}
    for x in live:
        r = root(x)
        least[r] = min(least.get(r, rows[x][0]), rows[x][0])
    cls = {}
    for x in live:
        cls[sets[x]] = min(cls.get(sets[x], rows[x][0]), rows[x][0])
    return [(i, cls[sets[x]], least[root(x)], len(sets[x]), len(links[x])) if i is not None else (i, None, None, len(sets[x]), 0) for x, (i, _) in enumerate(rows)]


def shard(rows, shards=8):
    r = sorted(((i is not None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t in rows))
    total, b, out, slots = sum(x[3] for x in r), 0, [], [0] * shards
    for ok, i, c, s in r:
        k = min(shards - 1, shards * (2 * b + s) // (2 * total))
        out.append((i if ok else None, s, c, k, slots[k]))
        slots[k] += 1
        b += s
    return out
