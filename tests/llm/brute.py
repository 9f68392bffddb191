"""Plain Python versions of the training-data operators, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import zlib

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return (text or "").translate(LOWER).encode().split()


def shingles(text):
    w = words(text)
    return [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def near_duplicate_components(rows):
    """{position: (set size, smallest id reachable)} of ``(id, text)`` rows."""
    sets = [frozenset(shingles(text)) for _, text in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            a, b = find(i), find(j)
            group[max(a, b)] = min(a, b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        root = find(i)
        if doc_id is not None:
            least[root] = min(least.get(root, doc_id), doc_id)
    return [(len(s), least.get(find(i))) for i, s in enumerate(sets)]


def leaks(docs, items):
    """{(doc, item): best similarity} of windows as long as the item."""
    found = {}
    for doc_id, text in docs:
        s = shingles(text)
        for item_id, item_text in items:
            item = shingles(item_text)
            if not s or not item:
                continue
            width, counts, best = min(len(item), len(s)), collections.Counter(item), 0.0
            for start in range(len(s) - width + 1):
                shared = (collections.Counter(s[start : start + width]) & counts).total()
                best = max(best, shared / (width + len(item) - shared))
            if best >= 0.8:
                found[doc_id, item_id] = best
    return found


def kt(zeros, ones):
    p = 1.0
    for i, n in enumerate([zeros, ones]):
        for k in range(n):
            p *= (k + 0.5) / ((zeros if i else 0) + k + 1)
    return p


class ContextTree:
    """Weights and predictions straight from the definition, one decision at a time."""

    def __init__(self, counts):
        self.counts = collections.defaultdict(lambda: [0, 0])
        self.children = collections.defaultdict(set)
        for word, n in counts.items():
            if n:
                for path, bit in self.decisions(word):
                    for node in path:
                        self.counts[node][bit] += n
                    for up, down in itertools.pairwise(path):
                        self.children[up].add(down)

    @staticmethod
    def decisions(word):
        symbols = [*word, 0]
        for i, s in enumerate(symbols):
            near = [0, 0, *symbols[:i]]
            contexts = [(), (near[-1],), (near[-2], near[-1])] + ([("word", *symbols[:i])] if i >= 2 else [])
            for k in range(8):
                prefix = (1 << k) | (s >> (8 - k))
                yield [(c, prefix) for c in contexts], (s >> (7 - k)) & 1

    def weight(self, node):
        own = kt(*self.counts[node])
        below = self.children.get(node)
        return 0.5 * own + 0.5 * math.prod(self.weight(c) for c in below) if below else own

    def one(self, path):
        zeros, ones = self.counts.get(path[0], (0, 0))
        estimate = (ones + 0.5) / (zeros + ones + 1)
        if len(path) == 1 or path[1] not in self.counts:
            return estimate
        stop = 0.5 * kt(zeros, ones) / self.weight(path[0])
        return stop * estimate + (1 - stop) * self.one(path[1:])

    def log10(self, word):
        return sum(math.log10(p if bit else 1 - p) for path, bit in self.decisions(word) for p in [self.one(path)])


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _tree(leaves):
    """Root and, per leaf, the runs of siblings (with the leaf's place) up to it."""
    ways, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for i, k in enumerate(at):
            first = k - k % 16
            ways[i].append((k - first, level[first:k] + level[k + 1 : first + 16]))
        level = [_h("".join(level[i : i + 16])) for i in range(0, len(level), 16)]
        at = [k // 16 for k in at]
    return level[0], ways


def merkle(rows):
    """Rows of the manifest query from ``(doc_id, source, lang, n_chars, text)``, as a sorted list."""

    def leaf(values):
        return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    sources = collections.defaultdict(list)
    for r in rows:
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
        text = r[4].translate(LOWER) if hit and r[4] is not None else r[4]
        sources[r[1]].append(((r[0] is not None, r[0] or 0, leaf(r)), r[0], leaf(r), leaf([*r[:4], text])))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        sources[name].sort(key=lambda x: x[0])
        trees.append(_tree([x[2] for x in sources[name]]))
    root, upper = _tree([t[0] for t in trees]) if trees else (None, [])
    found = []
    for name, (subroot, ways), above in zip(names, trees, upper, strict=True):
        for (_, doc_id, own, other), way in zip(sources[name], ways, strict=True):
            folded = other
            for k, others in way + above:
                folded = _h("".join(others[:k]) + folded + "".join(others[k:]))
            proof = _h("".join("".join(others) for _, others in way + above))
            found.append((doc_id, own, subroot, root, proof, folded, folded == root))
    return sorted(found, key=repr)
