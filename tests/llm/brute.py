"""Plain versions of the operators, for small tables."""

import hashlib
import re

PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
NORMAL = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return PLAIN.findall(text or "")


def normal_words(text):
    return NORMAL.findall((text or "").translate(LOWER))


def shingle_set(text, length):
    words = plain_words((text or "").translate(LOWER))
    if words and len(words) < length:
        return {tuple(words)}
    return {tuple(words[i:i + length]) for i in range(len(words) - length + 1)}


def roots(nodes, links):
    """Smallest node reached from each node."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_duplicates(docs, length, percent):
    """docs: {id: text} -> {id: (n_shingles, component, kept)}."""
    sets = {i: shingle_set(t, length) for i, t in docs.items()}
    by_shingle = {}
    for i, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    common = {}
    for ids in by_shingle.values():
        for a in ids:
            for b in ids:
                if a < b:
                    common[a, b] = common.get((a, b), 0) + 1
    links = [(a, b) for (a, b), n in common.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    root = roots(docs, links)
    return {i: (len(sets[i]), root[i], root[i] == i) for i in docs}


def repeated_words(docs, window):
    """docs: {id: text} -> {id: (n_words, n_removed, digest of what is kept)}."""
    first, out, flags = {}, {}, {}
    for i in sorted(docs):
        words = plain_words(docs[i])
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            key = tuple(words[s:s + window])
            if key in first:
                gone[s:s + window] = [True] * window
            else:
                first[key] = (i, s)
        flags[i] = gone
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out[i] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out
