"""Plain-Python forms of what the operators compute, for small fixtures."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingle_set(text, n):
    w = words(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1)))


def components(ids, pairs):
    """Smallest reachable id of every id."""
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def jaccard_links(texts, n, num, den):
    """Index pairs of linked texts, every pair of equal-sized-enough sets tried."""
    sets = [shingle_set(t, n) for t in texts]
    order = sorted((i for i in range(len(sets)) if sets[i]), key=lambda i: len(sets[i]))
    out = []
    for x, i in enumerate(order):
        for j in order[x + 1:]:
            if num * len(sets[j]) > den * len(sets[i]):
                break
            inter = len(sets[i] & sets[j])
            if den * inter >= num * (len(sets[i]) + len(sets[j]) - inter):
                out.append((i, j))
    return out


def repeated_window_words(text, size=5):
    w = words(text)
    seen = {}
    for i in range(len(w) - size + 1):
        seen.setdefault(tuple(w[i:i + size]), []).append(i)
    return len({i + j for at in seen.values() if len(at) > 1 for i in at for j in range(size)})
