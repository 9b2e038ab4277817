"""Plain versions of the operators, row by row, for small inputs."""

import hashlib
import re
from collections import defaultdict

import xxhash

SPACES = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def line_dedup(docs, n=3):
    seen, gone = set(), defaultdict(set)
    for key, (i, t) in sorted(enumerate(docs), key=lambda x: (x[1][0] is not None, x[1][0] or 0)):
        lines = t.split("\n") if t is not None else []
        for p in range(len(lines) - n + 1):
            w = tuple(lines[p : p + n])
            if any(x.strip(" ") for x in w):
                if w in seen:
                    gone[key] |= set(range(p, p + n))
                seen.add(w)
    out = []
    for key, (i, t) in enumerate(docs):
        lines = t.split("\n") if t is not None else []
        out.append((i, len(lines), len(gone[key]), None if t is None else "\n".join(x for p, x in enumerate(lines) if p not in gone[key])))
    return out


def line_dedup_merged(docs):
    """Rows that agree in id and text count as one occurrence."""
    once = {r: line for r, line in zip(dict.fromkeys(docs), line_dedup(list(dict.fromkeys(docs))), strict=True)}
    return [once[d] for d in docs]


def fingerprint(text, n=3):
    words = [w.encode() for w in SPACES.findall(lower(text))]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(max(len(words) - n + 1, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps):
    """fps: [(id, fp)]; the least id reachable over links of at most two bits."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j][1]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(fps):
        least[find(i)].append(d)
    return [min((d for d in least[find(i)] if d is not None), default=None) for i in range(len(fps))]


def decontaminate(docs, items, n=13):
    windows = defaultdict(set)
    for i, t in items:
        w = ITEM_WORDS.findall(lower(t))
        for p in range(max(len(w) - n + 1, 1 if w else 0)):
            windows[tuple(w[p : p + n])].add(str(i))
    sizes, out = {len(w) for w in windows}, []
    for i, t in docs:
        w = ITEM_WORDS.findall(lower(t))
        hit, found = set(), set()
        for size in sizes:
            for p in range(len(w) - size + 1):
                if ids := windows.get(tuple(w[p : p + size])):
                    hit |= set(range(p, p + size))
                    found |= ids
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def substrings(docs, n=13):
    least = {}
    for i, t in docs:
        w = SPACES.findall(t or "")
        for p in range(len(w) - n + 1):
            if i is not None:
                k = tuple(w[p : p + n])
                least[k] = min(least.get(k, i), i)
    out = []
    for i, t in docs:
        w, gone = SPACES.findall(t or ""), set()
        for p in range(len(w) - n + 1):
            if i is not None and least[tuple(w[p : p + n])] < i:
                gone |= set(range(p, p + n))
        out.append((i, len(w), len(gone), sha(" ".join(x for p, x in enumerate(w) if p not in gone))))
    return out
