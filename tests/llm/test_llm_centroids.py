import collections
import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tickspan.llm import centroids as CC

KIND = "vec_id long, embedding array<float>, cluster string, v int, id string"


def brute(rows, k=40, rounds=5, dims=64, scale=256):
    """Everything evaluated in every round, in Python integers."""
    kept = [(i, tuple(math.floor(scale * x) for x in e)) for i, e in rows
            if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [list(v) for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents)) for _, v in kept]
    for _ in range(rounds):
        got = assign()
        for j in range(len(cents)):
            own = [v for (_, v), (_, c) in zip(kept, got) if c == j]
            if own:
                cents[j] = [sum(x) // len(own) for x in zip(*own)]
    got = assign()
    per = collections.Counter()
    for d, j in got:
        per[j] += d
    return collections.Counter((i, j, d, per[j], sum(per.values()), hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest())
                               for (i, _), (d, j) in zip(kept, got))


def floats(rng, n, dims, spread=1.0):
    centers = rng.normal(0, spread, (7, dims))
    return [np.float32(centers[i % 7] + rng.normal(0, 0.2, dims)).tolist() for i in range(n)]


def test_odd_vectors_ties_and_repeats_are_brute_force(spark):
    rng = np.random.default_rng(3)
    good = floats(rng, 150, 64)
    rows = [(i, e) for i, e in enumerate(good)] + [(5, good[5])] * 3 + [(None, good[9]), (None, good[10]), (900, [0.0] * 64)]
    rows += [(1000 + i, good[0]) for i in range(60)]
    rows += [(2001, None), (2002, []), (2003, good[0][:63]), (2004, good[0] + [1.0]), (2005, good[0][:63] + [None]),
             (2006, good[0][:63] + [float("nan")]), (2007, good[0][:63] + [float("-inf")])]
    df = spark.createDataFrame([(i, e, "x", 1, "y") for i, e in rows], KIND).repartition(3)
    got = CC.clusters(df)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert collections.Counter(map(tuple, got.collect())) == brute(rows)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(i, e) for i, e in enumerate(floats(np.random.default_rng(1), 5, 64))]
    df = spark.createDataFrame([(i, e, "x", 1, "y") for i, e in rows], KIND)
    assert collections.Counter(map(tuple, CC.clusters(df).collect())) == brute(rows)
    assert CC.clusters(df.limit(0)).collect() == []
    assert CC.clusters(df.where("vec_id > 100")).columns[0] == "vec_id"


def test_large_components_are_exact_and_too_large_ones_an_error(spark):
    rng = np.random.default_rng(5)
    rows = [(i, np.float32(rng.normal(0, 90_000, 4)).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = CC.clusters(df, k=6, dims=4, rounds=3)
    assert collections.Counter(map(tuple, got.collect())) == brute(rows, 6, 3, 4)
    bad = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond"):
        CC.clusters(bad, dims=2).collect()


def run_rounds(x, k, rounds, n_groups):
    """Rounds in one task, checked each time against all distances."""
    c = x[:k].copy()
    history = c[None]
    groups = np.array_split(np.arange(len(c)), min(len(c), n_groups))
    n, g = len(x), len(groups)
    state = (np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros((n, g)), np.zeros((n, g), np.int64))
    work = []
    for now in range(rounds):
        state, done = CC.assigned(x, state, history, now, groups)
        d = ((x[:, None] - history[now][None]) ** 2).sum(2)
        assert np.array_equal(state[0], d.argmin(1))
        drift = CC.moved(history, now)
        for j, members in enumerate(groups):
            others = np.where(members[None] == state[0][:, None], np.iinfo(np.int64).max, d[:, members]).min(1)
            assert (state[3][:, j] - drift[state[4][:, j]][:, members].max(1) <= np.sqrt(others.astype(float)) + 1e-6).all()
        work.append(int(done.sum()))
        means = [x[state[0] == j].sum(0) // max(1, (state[0] == j).sum()) if (state[0] == j).any() else history[-1][j] for j in range(len(c))]
        history = np.concatenate((history, np.array(means)[None]))
    return work


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 40), st.integers(1, 9), st.integers(1, 5), st.sampled_from([1, 3, 50]))
def test_bounds_hold_and_assignments_are_exact(seed, n, k, n_groups, spread):
    rng = np.random.default_rng(seed)
    run_rounds(rng.integers(-spread, spread + 1, (n, 2)), min(k, n), 8, n_groups)


def test_bounds_save_most_distances():
    rng = np.random.default_rng(0)
    x = (rng.normal(0, 300, (20, 16))[rng.integers(0, 20, 3000)] + rng.normal(0, 20, (3000, 16))).astype(np.int64)
    work = run_rounds(x, 20, 10, 5)
    assert work[0] == 3000 * 20 and work[-1] < 0.2 * work[0]


def test_displacement_is_of_the_total_not_summed():
    there = np.array([[[0, 0]], [[30, 40]], [[0, 0]]])
    assert CC.moved(there, 2).tolist() == [[0.0], [50.0], [0.0]]
