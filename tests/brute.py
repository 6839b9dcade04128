"""Plain Python counts to compare with, straight from the definitions."""

import random
from collections import Counter


def multigraph(seed, nodes=9, edges=60):
    rng = random.Random(seed)
    return [(rng.randrange(nodes), rng.randrange(nodes)) for _ in range(edges)]


def hub_graph(fans=300, others=60):
    """Node 0 holds far more than a third of all edge ends."""
    edges = [(i, 0) for i in range(1, fans)] + [(0, i) for i in range(5, fans, 3)]
    edges += [(i, i % 7 + 1) for i in range(8, others)]
    edges += [(i % 7 + 1, i + 1) for i in range(8, others)]
    return edges + edges[: fans // 4]


def path2(edges, keep_returns):
    pairs = Counter()
    for x, y in edges:
        for y2, z in edges:
            if y == y2 and (keep_returns or x != z):
                pairs[x, z] += 1
    return pairs


def walks(edges, mode):
    copies = Counter(edges)
    hits = 0
    for (a, b), m1 in copies.items():
        for (b2, c), m2 in copies.items():
            m3 = copies.get((c, a), 0)
            if b2 != b or not m3:
                continue
            if mode == "all":
                hits += m1 * m2 * m3
            elif mode == "semi":
                hits += m1 * m2 if c != a else 0
            else:
                hits += m1
    return hits


def triangles(edges):
    simple = {(a, b) for a, b in edges if a != b}
    return walks(sorted(simple), "all") // 3


def ranks(edges, iterations, damping=0.85):
    links = set(edges)
    nodes = sorted({v for e in links for v in e})
    outs = Counter(a for a, _ in links)
    n = len(nodes)
    rank = dict.fromkeys(nodes, 1.0 / n)
    held = []
    for _ in range(iterations):
        dangling = sum(r for v, r in rank.items() if v not in outs)
        held.append(dangling)
        got = dict.fromkeys(nodes, 0.0)
        for a, b in links:
            got[b] += rank[a] / outs[a]
        rank = {
            v: (1 - damping) / n + damping * (got[v] + dangling / n) for v in nodes
        }
    return rank, held
