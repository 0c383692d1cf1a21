"""Plain versions of the operators' results, row by row."""

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
KINDS = ("email", "ip", "card", "phone")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def repeated_windows(rows, window):
    """[(id, n_words, n_removed, sha of kept)] of [(id, text)]."""
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    seen = Counter(tuple(w[k:k + window]) for _, w in words for k in range(len(w) - window + 1))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k:k + window])] > 1:
                gone[k:k + window] = [True] * window
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def base_quality(text):
    words, text = WORD.findall(text or ""), text or ""
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    seen = Counter(windows)
    again = {k + d for k, x in enumerate(windows) if seen[x] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(again), len(words) < 50 or 100 * len(again) > 50 * len(words))


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def lines(rows, min_chars=10):
    owner = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(line_key(x)) >= min_chars:
                owner[line_key(x)] = min(owner.get(line_key(x), i), i)
    out = []
    for i, t in rows:
        all_ = (t or "").split("\n")
        kept = [x for x in all_ if owner.get(line_key(x), i) == i]
        out.append((i, len(all_), len(all_) - len(kept), sha("\n".join(kept))))
    return out


def fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k:k + 4]).encode(), 42) for k in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(fps, bits=4):
    """fps: [(id, fingerprint)] -> {position: smallest id reachable}."""
    root = list(range(len(fps)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a][1] ^ fps[b][1]).bit_count() <= bits and top(a) != top(b):
                root[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(fps):
        least[top(k)] = min(least.get(top(k), i), i)
    return [least[top(k)] for k in range(len(fps))]


def personal(text):
    found, text = [], text or ""
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()][::-1]
        if 12 <= len(d) <= 19 and sum(c if k % 2 == 0 else 2 * c - 9 * (2 * c > 9) for k, c in enumerate(d)) % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append((m.start(), 3, m.end()))
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """{source: words} -> {source: target} by filling level by level."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level >= most * sizes[s]}
        if not full:
            return out | {s: weight[s] * level for s in free}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        free -= full
    return out
