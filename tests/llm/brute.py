"""Plain versions of what the operators compute, for small inputs."""

from __future__ import annotations

import math
from collections import Counter, defaultdict


def components(links, nodes):
    """Smallest node that each node reaches."""
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def discounts(counts):
    n = Counter(counts)
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    found = [i - (i + 1) * y * n[i + 1] / n[i] if n[i] else 0.0 for i in (1, 2, 3)]
    return [0.0] + [min(max(d, 0.05), i - 0.01) for i, d in enumerate(found, 1)]


class KneserNey:
    """Interpolated modified Kneser-Ney model over lists of tokens."""

    def __init__(self, texts, order):
        self.order = order
        grams = Counter()
        for text in texts:
            padded = ["<s>"] * (order - 1) + text
            grams.update(tuple(padded[i : i + order]) for i in range(len(text)))
        self.counts = {order: grams}
        for n in range(order - 1, 0, -1):
            lower = Counter()
            for gram, count in self.counts[n + 1].items():
                lower[gram[1:]] += count if gram[:2] == ("<s>", "<s>") else 1
            self.counts[n] = lower
        self.cut = {n: discounts(c.values()) for n, c in self.counts.items()}
        self.after = {}
        for n, grams in self.counts.items():
            sums = defaultdict(lambda: [0, 0.0])
            for gram, count in grams.items():
                sums[gram[:-1]][0] += count
                sums[gram[:-1]][1] += self.cut[n][min(count, 3)]
            self.after[n] = dict(sums)
        self.kinds = len(self.counts[1])

    def p(self, gram):
        n = len(gram)
        if n == 0:
            return 1 / (self.kinds + 1)
        total, cut = self.after[n].get(gram[:-1], (0, 0))
        lower = self.p(gram[1:])
        if not total:
            return lower
        count = self.counts[n].get(gram, 0)
        return (count - self.cut[n][min(count, 3)]) / total + cut / total * lower

    def log10(self, text):
        padded = ["<s>"] * (self.order - 1) + text
        return sum(math.log10(self.p(tuple(padded[i : i + self.order]))) for i in range(len(text)))
