"""Clustering with ns-bounds against Lloyd's rounds by hand."""

import hashlib
import math
import random

import numpy as np
import pytest

from edgeloom.llm import centroids

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, cluster STRING, v INT, key INT"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "c", 1, 2) for i, v in rows], SCHEMA)


def lloyd(rows, dims, k, rounds, scale=256, salt="2:"):
    kept = [
        (i, [math.floor(scale * x) for x in np.array(v, np.float32).tolist()])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    name = lambda r: hashlib.sha256((salt + ("" if r[0] is None else str(r[0]))).encode()).hexdigest()
    center = [v for _, v in sorted(kept, key=lambda r: (name(r), r[1]))[:k]]

    def assign():
        far = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in center] for _, v in kept]
        return [(d.index(min(d)), min(d)) for d in far]

    for _ in range(rounds):
        found = assign()
        for c in range(len(center)):
            mine = [v for (_, v), (label, _) in zip(kept, found) if label == c]
            if mine:
                center[c] = [sum(x) // len(mine) for x in zip(*mine)]
    found, inertia = assign(), {}
    for label, d in found:
        inertia[label] = inertia.get(label, 0) + d
    text = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in center]
    return sorted(
        (
            (i, label, d, inertia[label], sum(inertia.values()), text[label])
            for (i, _), (label, d) in zip(kept, found)
        ),
        key=str,
    )


def rows_of(kind, dims):
    draw = random.Random(kind)
    if kind == "blobs":
        middle = [[draw.uniform(-1, 1) for _ in range(dims)] for _ in range(9)]
        rows = [[m + draw.gauss(0, 0.1) for m in draw.choice(middle)] for _ in range(700)]
    elif kind == "grid":  # many ties
        rows = [[draw.choice([-0.01, 0.0, 0.01]) for _ in range(dims)] for _ in range(500)]
    else:
        rows = [[draw.uniform(-30000, 30000) for _ in range(dims)] for _ in range(300)]
    hot = [rows[0]] * 200
    odd = [None, [], [0.1] * (dims + 1), [0.1] * (dims - 1) + [None], [float("nan")] * dims]
    odd += [[float("inf")] + [0.0] * (dims - 1)]
    named = list(enumerate(rows + hot)) + [(None, v) for v in odd + rows[1:3]]
    return named + [(5, rows[5]), (5, rows[6])] + [(10**6 + i, v) for i, v in enumerate(odd)]


@pytest.mark.parametrize(
    "kind,dims,k,rounds",
    [("blobs", 6, 19, 5), ("grid", 6, 19, 5), ("large", 6, 19, 3), ("grid", 3, 8, 2), ("blobs", 2, 1, 1), ("grid", 4, 30, 0)],
)
def test_equals_lloyd(spark, kind, dims, k, rounds):
    rows = rows_of(kind, dims)
    got = centroids.cluster(vectors(spark, rows), dims=dims, k=k, rounds=rounds)
    assert sorted(map(tuple, got.collect()), key=str) == lloyd(rows, dims, k, rounds)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, None)]
    got = centroids.cluster(vectors(spark, rows), dims=2, k=40, rounds=3)
    assert sorted(map(tuple, got.collect()), key=str) == lloyd(rows, 2, 40, 3)
    assert centroids.cluster(vectors(spark, rows[2:]), dims=2).collect() == []
    with pytest.raises(ValueError, match="component"):
        centroids.cluster(vectors(spark, [(1, [1e9, 0.0])]), dims=2)


def test_bounds_hold_and_save_distances():
    """Each stored bound stays below the true distances, and far fewer than all are taken."""
    draw = np.random.default_rng(4)
    middle = draw.integers(-3000, 3000, (32, 16))
    x = (middle[draw.integers(0, 32, 20_000)] + draw.normal(0, 300, (20_000, 16))).astype(np.int64)
    history = x[draw.choice(len(x), 32, replace=False)][None]
    state, taken = centroids.Round(history, False).first(x), []
    for _ in range(12):
        new = [x[state["cluster"] == c].sum(0) // max(1, (state["cluster"] == c).sum()) for c in range(32)]
        history = np.concatenate([history, np.array(new)[None]])
        step = centroids.Round(history, False)
        state = step.next(x, state)
        true = centroids.squared(x, history[-1])
        assert (state["cluster"] == true.argmin(1)).all()
        others = np.sqrt(true.astype(float))
        others[np.arange(len(x)), state["cluster"]] = np.inf
        now = state["low"] - step.group_moved[state["low_at"], np.arange(step.n_groups)[None, :]]
        for g in range(step.n_groups):
            assert (now[:, g] <= others[:, step.group == g].min(1)).all()
        taken.append(state["scanned"].mean() / 32)
    assert min(taken) < 0.1 and taken[-1] < 0.5


def test_bounds_go_by_total_displacement():
    """A centroid that came back to its place loosens nothing, whatever its way."""
    home, away = np.array([[0, 0], [100, 0]]), np.array([[40, 0], [60, 0]])
    assert (centroids.displacement(np.array([home, away, home]))[0] == 0).all()
    assert (centroids.displacement(np.array([home, away, home]))[1] > 39).all()


def test_whole_numbers_too_large_for_floats():
    x = np.array([[2**26, -(2**26)], [3, 4]])
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, c)) for c in x] for r in x]
    assert centroids.squared(x, x).tolist() == want
