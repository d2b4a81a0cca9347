"""Plain Python versions of the text operators, for small inputs."""

import hashlib
import re
from collections import defaultdict
from itertools import combinations

LOWER = {k: k + 32 for k in range(65, 91)}


def spaced(text, lower=False):
    t = (text or "").translate(LOWER) if lower else (text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", t)


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_id(rows):
    """One text for each id: the greatest; null ids are one id, the first."""
    out = {}
    for i, t in rows:
        if i not in out or (t is not None and (out[i] is None or t.encode() > out[i].encode())):
            out[i] = t
    return sorted(out.items(), key=lambda x: (x[0] is not None, x[0] or 0))


def substring_dedup(rows, size):
    docs = [(i, spaced(t)) for i, t in by_id(rows)]
    seen, gone = set(), defaultdict(set)
    for i, w in docs:
        for k in range(len(w) - size + 1):
            key = tuple(w[k: k + size])
            if key in seen:
                gone[i].update(range(k, k + size))
            seen.add(key)
    return {i: (len(w), len(gone[i]), " ".join(x for k, x in enumerate(w) if k not in gone[i]))
            for i, w in docs}


def line_dedup(rows, run):
    seen, out = set(), {}
    for i, t in by_id(rows):
        lines = t.split("\n") if t else []
        at = [k for k, x in enumerate(lines) if x.strip(" ")]
        gone = set()
        for k in range(len(at) - run + 1):
            key = tuple(lines[x].strip(" ") for x in at[k: k + run])
            if key in seen:
                gone.update(at[k: k + run])
            seen.add(key)
        out[i] = (len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


def shingles(text, k=4):
    w = spaced(text, lower=True)
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[x: x + k]) for x in range(len(w) - k + 1)}


def components(rows):
    sets = [(i, shingles(t)) for i, t in by_id(rows)]
    top = {i: i for i, _ in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for (a, x), (b, y) in combinations(sets, 2):
        if x and y and 100 * len(x & y) >= 85 * len(x | y):
            p, q = find(a), find(b)
            if p != q:
                low, high = sorted((p, q), key=lambda v: (v is not None, v or 0))
                top[high] = low
    return {i: (len(s), find(i)) for i, s in sets}


def contamination(rows, items, size=10):
    windows = defaultdict(set)
    for item, t in items:
        w = alnum(t)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[k: k + size])].add("null" if item is None else str(item))
    lengths = sorted({len(w) for w in windows})
    out = {}
    for i, t in by_id(rows):
        w, hit, ids = alnum(t), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                found = windows.get(tuple(w[k: k + n]))
                if found:
                    hit.update(range(k, k + n))
                    ids |= found
        out[i] = (len(w), len(hit), sorted(ids))
    return out


def viterbi(word, score, unknown, longest):
    """Codes of the best path: the greatest sum, of equals the longest last piece."""
    best = [(0.0, [])]
    for e in range(1, len(word) + 1):
        found = None
        for s in range(max(0, e - longest), e):
            piece = word[s:e]
            if piece in score:
                i, x = score[piece]
                code = i
            elif e - s == 1:
                code, x = (1 << 24) + ord(piece), unknown
            else:
                continue
            total = best[s][0] + x
            if found is None or total > found[0]:
                found = (total, [*best[s][1], code])
        best.append(found)
    return best[-1][1]


def merkle_leaves(text):
    """The leaves of a text by paragraph, character by character."""
    import zlib
    out = []
    for line in text.splitlines(keepends=True):
        # words: white space, the rest, white space; white space after a word belongs to it
        words, k = [], 0
        while k < len(line):
            e = k
            while e < len(line) and line[e].isspace():
                e += 1
            while e < len(line) and not line[e].isspace():
                e += 1
            while e < len(line) and line[e].isspace():
                e += 1
            words.append(line[k:e])
            k = e
        parts = []
        for w in words:
            if len(w) <= 15:
                parts.append(w)
                continue
            held = ""
            for i, c in enumerate(w):
                if len(held) >= 4 and (len(held) == 15 or zlib.crc32(w[i - 3: i].encode()) % 8 == 0):
                    parts.append(held)
                    held = ""
                held += c
            parts.append(held)
        leaves, held = [], []
        for p in parts:
            held.append(p)
            if len(held) == 4 or p.rstrip()[-1:] in (".", "!", "?") and p.rstrip():
                leaves.append("".join(held))
                held = []
        out.append(leaves + (["".join(held)] if held else []))
    return out


def merkle_likeness(a, b):
    """Bytes in common leaves over the bytes of the longer text; 1 for equal texts."""
    from collections import Counter
    x, y = (Counter(leaf for p in merkle_leaves(t) for leaf in p) for t in (a, b))
    common = sum(n * len(leaf.encode()) for leaf, n in (x & y).items())
    return 1.0 if a == b else common / max(len(a.encode()), len(b.encode()), 1)
