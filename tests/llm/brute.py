"""Plain versions of the contracts, for small inputs."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def near_dups(rows):
    sets = []
    for _, t in rows:
        w = lower(t).encode().split()
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 85 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for a in range(len(rows)):
        groups[find(a)].append(a)
    out = []
    for members in groups.values():
        ids = [rows[m][0] for m in members if rows[m][0] is not None]
        least = min(ids) if ids else None
        out += [(rows[m][0], len(sets[m]), least, rows[m][0] == least) for m in members]
    return out


def repeats(rows, length=100):
    """``rows`` in order of (id, place)."""
    seen, out = set(), []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            if s in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(s)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def hits(rows, items, n=10):
    windows = collections.defaultdict(set)
    for item, t in items:
        w = WORD.findall(lower(t))
        if w:
            for k in range(max(1, len(w) - n + 1)):
                windows[tuple(w[k : k + n])].add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for i, t in rows:
        w = WORD.findall(lower(t))
        hit, found = set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[tuple(w[k : k + size])]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out
