"""SimHash near-duplicates and the Gray-order index against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from edgeloom.llm import simhash

SCHEMA = "doc_id BIGINT, text STRING, fp STRING, copy INT, key INT"
BLANKS = " \t\n\x0b\x0c\r"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in BLANKS:
        low = low.replace(blank, " ")
    return [w for w in low.split(" ") if w]


def fingerprint(text, size):
    w = words(text)
    if not w:
        return 0
    n = max(1, len(w) - size + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + size]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def components(rows, size, most):
    """rows: (key, fingerprint). Least key each can reach."""
    fps = sorted({f for _, f in rows})
    label = {f: f for f in fps}

    def root(f):
        while label[f] != f:
            f = label[f]
        return f

    values = np.array(fps, np.uint64)
    for i, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(values ^ np.uint64(f)) <= most):
            a, b = root(f), root(fps[j])
            label[max(a, b)] = min(a, b)
    least = {}
    for key, f in rows:
        if key is not None:
            least[root(f)] = min(key, least.get(root(f), key))
    return sorted(((key, f, least.get(root(f))) for key, f in rows), key=str)


def docs_of(seed):
    draw = random.Random(seed)
    bag = [f"w{i}" for i in range(300)] + ["Ärger", "ÉTÉ", " x", "a b"]
    rows = [(1, None), (2, ""), (3, BLANKS), (4, "One two"), (5, "one\ttwo"), (6, "one two three FOUR five")]
    base = [draw.choice(bag) for _ in range(400)]
    for i in range(7, 120):
        copy = list(base)
        for _ in range(draw.randint(0, 12)):
            copy[draw.randrange(len(copy))] = f"n{draw.randint(0, 999)}"
        rows.append((i, draw.choice(BLANKS).join(copy)))
    rows += [(i, " ".join(draw.choice(bag) for _ in range(draw.randint(1, 90)))) for i in range(120, 300)]
    rows += [(300, "Long words " * 60_000), (None, "one two"), (4, "One two"), (None, "alone in the world"), (301, "x" * 10**6)]
    return rows


@pytest.mark.parametrize("size,most", [(4, 4), (5, 3), (2, 9)])
def test_near_duplicates_equal_brute_force(spark, size, most):
    rows = docs_of(size)
    docs = spark.createDataFrame([(i, t, "f", 1, 2) for i, t in rows], SCHEMA)
    got = simhash.near_duplicates(docs, size=size, most=most).collect()
    want = components([(i, fingerprint(t, size)) for i, t in rows], size, most)
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=str) == want


def crowd(seed, n):
    """Fingerprints that share blocks of bits: balls around centers, and even ones."""
    draw = random.Random(seed)
    centers = [draw.getrandbits(64) for _ in range(3)]
    found = set()
    while len(found) < n:
        f = draw.choice(centers)
        for _ in range(draw.randint(0, 14)):
            f ^= 1 << draw.choice([*range(10), *range(40, 64)])
        found.add(f)
    return sorted(found | {draw.getrandbits(64) for _ in range(n)})


@pytest.mark.parametrize("most", [2, 4])
def test_large_buckets_are_cut_and_lose_no_link(spark, monkeypatch, most):
    monkeypatch.setattr(simhash, "LEAF", 32)
    fps = crowd(most, 3000)
    table = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp BIGINT")
    sent = []
    whole = simhash._leaf_pairs
    monkeypatch.setattr(simhash, "_leaf_pairs", lambda *a: sent.append(whole(*a)) or sent[-1])
    pairs = [(r.a % 2**64, r.b % 2**64) for r in simhash.links(table, most).collect()]
    label = {f: f for f in fps}

    def root(f):
        while label[f] != f:
            f = label[f]
        return f

    for a, b in pairs:
        x, y = root(a), root(b)
        label[max(x, y)] = min(x, y)
    want = components([(f, f) for f in fps], 0, most)
    assert sorted(((f, f, root(f)) for f in fps), key=str) == want
    n = sent[0].count()
    leaves = sent[0].select("copy", "bucket", F.col("x_no").alias("n")).distinct().count()
    assert 0 < n < leaves * leaves / 4


@pytest.mark.parametrize("blocks,most", [(5, 4), (6, 4), (4, 2), (8, 4)])
def test_any_link_meets_in_one_layout(blocks, most):
    draw = random.Random(blocks)
    ways = simhash.layouts(blocks, most)
    assert all(sorted(s for s, _ in w) == sorted(s for s, _ in ways[0]) and sum(n for _, n in w) == 64 for w in ways)
    for _ in range(300):
        a = draw.getrandbits(64)
        b = a
        for bit in draw.sample(range(64), most):
            b ^= 1 << bit
        both = np.array([a, b], np.uint64)
        meets = []
        for way in ways:
            x, y = (int(v) for v in simhash.arrange(both, way))
            assert (x ^ y).bit_count() == most
            meets.append(x >> (64 - sum(n for _, n in way[: blocks - most])) == y >> (64 - sum(n for _, n in way[: blocks - most])))
        assert any(meets)


def test_gray_rank_is_the_place_in_the_gray_code():
    n = np.arange(4096, dtype=np.uint64)
    assert (simhash.gray_rank(n ^ (n >> np.uint64(1))) == n).all()


def test_nodes_prune_no_near_pair():
    fps = np.array(crowd(7, 400), np.uint64)
    fps = fps[np.argsort(simhash.gray_rank(fps))]
    for most in (0, 3, 6):
        i, j = simhash.near_pairs(fps, fps, most)
        want = np.argwhere(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= most)
        assert {(a, b) for a, b in zip(i, j)} == {(a, b) for a, b in want}


def test_more_fingerprints_take_more_blocks():
    assert [simhash.blocks_for(n, 4) for n in (0, 10**6, 10**8, 10**10, 10**13)] == [5, 5, 6, 7, 8]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(docs).collect() == []
