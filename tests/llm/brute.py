"""Plain versions of the contracts, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def repeats(rows, length):
    """(id, bytes, removed, spans, sha256) by counting every string."""
    data = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(b[p : p + length] for _, b in data for p in range(len(b) - length + 1))
    out = []
    for i, b in data:
        hit = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if counts[b[p : p + length]] > 1:
                hit[p : p + length] = b"\x01" * length
        spans = sum(1 for k, h in enumerate(hit) if h and (k == 0 or not hit[k - 1]))
        kept = bytes(x for x, h in zip(b, hit, strict=True) if not h)
        out.append((i, len(b), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def leaks(docs, items, window=10):
    """(id, words, hit words, item ids) by comparing every window."""
    split = lambda t: ITEM_WORD.findall((t or "").translate(FOLD))
    windows = defaultdict(set)
    for item, text in items:
        ws = split(text)
        m = min(window, len(ws))
        for p in range(len(ws) - m + 1 if m else 0):
            windows[tuple(ws[p : p + m])].add("" if item is None else str(item))
    out = []
    for i, text in docs:
        ws, hit, found = split(text), set(), set()
        for m in {len(w) for w in windows}:
            for p in range(len(ws) - m + 1):
                if tuple(ws[p : p + m]) in windows:
                    hit |= set(range(p, p + m))
                    found |= windows[tuple(ws[p : p + m])]
        out.append((i, len(ws), len(hit), sorted(found)))
    return sorted(out, key=repr)


def measures(text):
    ws = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    grams = Counter(zip(ws, ws[1:], ws[2:], strict=False))
    covered = {p + k for p in range(len(ws) - 2) if grams[tuple(ws[p : p + 3])] > 1 for k in range(3)}
    return (
        len(ws),
        sum(map(len, ws)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )


def shingles(text):
    ws = WORD.findall((text or "").translate(FOLD))
    return {tuple(ws[p : p + 5]) for p in range(max(1, len(ws) - 4))} if ws else set()


def components(rows):
    """(id, shingles, component, kept) by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[a + 1 :]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return sorted((i, len(x), find(i), find(i) == i) for i, x in sets)
