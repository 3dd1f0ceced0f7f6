import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from tickspan.llm import common, simhash as S


def brute_fp(text, k=3):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = [x for x in re.split("[\x20\x09-\x0d]+", text) if x]
    shingles = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_classes(rows, radius=3):
    fps = np.array([brute_fp(t) for _, t in rows], np.uint64)
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= radius) + i + 1:
            up[find(int(j))] = find(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d if d is not None else -1, f"{int(fps[i]):016x}", least.get(find(i))) for i, (d, _) in enumerate(rows))


@settings(max_examples=80, deadline=None)
@given(st.one_of(st.none(), st.text(alphabet="aBcÉß \t\n\x0b\x1c\xa0", max_size=60)))
def test_fingerprint_is_the_definition(text):
    assert S.simhash(text) == brute_fp(text)


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_links_connect_what_all_pairs_connect(spark, radius):
    rnd = random.Random(radius)
    fps = set()
    for _ in range(60):
        x = rnd.getrandbits(64)
        for _ in range(6):
            fps.add(x)
            for b in rnd.sample(range(64), rnd.randint(1, radius + 2)):
                x ^= 1 << b
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = S.links(spark.createDataFrame([(f,) for f in signed], "_fp long"), radius)
    roots = {r.node: r.root for r in common.connected_components(edges).collect()}
    up = {f: f for f in signed}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= radius:
                x, y = sorted((find(signed[i]), find(signed[j])))
                up[y] = x
    assert {f: roots.get(f, f) for f in signed} == {f: find(f) for f in signed}


def test_a_bucket_is_met_in_bounded_memory():
    """Variants are made and met in a few times the room of what a bucket holds by default."""
    masks, weights = S.ball(3)
    small = int((weights <= 1).sum())
    rnd = np.random.default_rng(1)
    fps = rnd.integers(0, 1 << 63, 2 * S.PER_BUCKET // (len(masks) + small), np.uint64)
    fps[1::2] = fps[::2][:len(fps) // 2] ^ np.uint64(5)
    tracemalloc.start()
    try:
        made = [S.packed_variants(fps[i:i + S.AT_ONCE], masks, small, 1) for i in range(0, len(fps), S.AT_ONCE)]
        one = S.packed_variants(fps[:S.AT_ONCE], masks, small, 64)
        packed = pa.chunked_array([b.column(1) for b in made])
        pairs = S.meetings(packed, masks, weights, 3)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(one) == 64 and sum(map(len, one.column(1).to_pylist())) % S.entry_of(masks).itemsize == 0
    assert {frozenset(p) for p in pairs.tolist()} >= {frozenset(p) for p in zip(fps[::2].tolist(), fps[1::2].tolist())}
    assert peak < 120e6


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    got = {r.node: r.root for r in common.connected_components(
        spark.createDataFrame(chain + star + [(7, 7)], "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}


def stored_files(monkeypatch):
    """Files of every checkpoint of the components from here on."""
    files, keep = [], common.cut_lineage

    def kept(df, *args):
        out = keep(df, *args)
        files.append(out.rdd.getNumPartitions())
        return out
    monkeypatch.setattr(common, "cut_lineage", kept)
    return files


def test_components_of_few_edges_take_few_files(spark, monkeypatch):
    """As many tasks as hold the edges, not as the shuffle has; a task that holds them all needs no round."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    want = {i: 0 for i in range(301)}
    files = stored_files(monkeypatch)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for partitions, most in (1, 1), (16, 16 + 4):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            del files[:]
            assert {r.node: r.root for r in common.connected_components(edges).collect()} == want
            assert sum(files) <= most
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("at_once", [1, 2, 7, 50])
def test_components_when_tasks_hold_few_nodes(spark, monkeypatch, at_once):
    monkeypatch.setattr(common, "ROWS_AT_ONCE", at_once)
    rnd = random.Random(at_once)
    edges = [(rnd.randrange(-60, 60), rnd.randrange(-60, 60)) for _ in range(70)]
    edges += [(i, i + 1) for i in range(100, 140)] + [(300, 300 + i) for i in range(1, 30)] + [(None, 5), (400, 400), edges[0]]
    least = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}
    for _ in least:
        for a, b in edges:
            if a in least and b in least:
                least[a] = least[b] = min(least[a], least[b])
    got = common.connected_components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()
    assert sorted(tuple(r) for r in got) == sorted(least.items())


def corpus():
    rnd = random.Random(3)
    words = ["w%d" % i for i in range(300)]
    rows = []
    for i in range(60):
        t = [rnd.choice(words) for _ in range(rnd.choice([1, 2, 3, 40, 400]))]
        rows.append((i, " ".join(t)))
        near = list(t)
        near[rnd.randrange(len(near))] = "zz"
        rows.append((100 + i, " ".join(near).upper()))
    return rows + [(500, None), (501, ""), (502, " \n"), (503, "a"), (503, "a"), (None, "a"), (None, "lonely words here now"),
                   (1, rows[0][1]), (504, "long " * 30000)]


def test_near_duplicates_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, fingerprint string, _fp long")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.fingerprint, r.component_id)
                 for r in S.near_duplicates(docs).collect())
    assert got == brute_classes(rows)


def test_one_of_each_group_stays(spark):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, component_id string")
    kept = S.one_of_each(docs)
    assert kept.columns == docs.columns
    want = {(f, c) for _, f, c in brute_classes(rows)}
    names = {c for _, c in want}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in got if x is not None) == sorted(x for x in names if x is not None)
    assert got.count(None) == 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(docs).collect() == [] and S.one_of_each(docs).collect() == []
