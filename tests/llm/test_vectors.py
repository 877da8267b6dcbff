"""Centroid clustering and exact top-k search against brute force."""

import hashlib
import os
import random
import sys
from collections import Counter, defaultdict
from math import floor, isfinite

import duckdb
import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from orbis.llm import centroid_clusters as K, queries, topk_search as T  # noqa: E402

SF = "/root/testdata/sf0.01"
CLASHING = "own int, ids int, v int, h int, cluster int, moved int, score int, rank int"


def table(spark, rows, kind="long"):
    wide = [(i, v, 0, *[7] * 8) for i, v in rows]
    return spark.createDataFrame(wide, f"vec_id {kind}, embedding array<float>, label int, {CLASHING}").repartition(5)


def odd(dim=64):
    """Rows that take no part in clustering."""
    return [(901, None), (902, [None] * dim), (903, [0.5] * (dim - 1)), (904, []),
            (905, [float("nan")] + [0.0] * (dim - 1)), (906, [float("inf")] + [0.0] * (dim - 1)),
            (907, [0.1] * (dim - 1) + [float("-inf")]), (908, [0.5] * (dim + 1))]


def f32(x):
    return float(np.float32(x))


def clusters_brute(rows, k=16, rounds=3, dim=64):
    kept = [(i, [max(-K.LIMIT, min(K.LIMIT, floor(64 * f32(x)))) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    cs = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min((far(v, c), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        cs = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(cs)]
    last = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, d, j in last:
        inertia[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return Counter((i, j, d, inertia[j], sum(inertia.values()), digest[j]) for i, d, j in last)


def mixed(seed, n=400):
    r = random.Random(seed)
    centres = [[r.uniform(-1, 1) for _ in range(64)] for _ in range(9)]
    rows = [(i, [x + r.gauss(0, 0.2) for x in r.choice(centres)]) for i in range(n)]
    rows += [(1000 + i, rows[3][1]) for i in range(150)]                   # one vector, very often
    rows += [rows[0], rows[0], (None, [0.25] * 64), (None, [0.5] * 64)]
    return rows + odd()


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_against_brute_force(spark, seed):
    rows = mixed(seed)
    got = K.cluster_report(table(spark, rows))
    assert Counter(tuple(r) for r in got.collect()) == clusters_brute(rows)


def test_clusters_edge_cases(spark):
    for rows in ([], odd(), [(5, [0.5] * 64)], [(i, [float(i % 3)] * 64) for i in range(40)],
                 [(1, [3e38] * 64), (2, [-3e38] * 64), (3, [70_000.0] * 64), (4, [0.0] * 64)]):
        got = K.cluster_report(table(spark, rows))
        assert Counter(tuple(r) for r in got.collect()) == clusters_brute(rows)
        assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_only_expired_vectors_are_scanned(monkeypatch):
    r = np.random.default_rng(5)
    c = r.integers(-300, 300, (8, 64))
    v = np.concatenate([x + r.integers(-5, 6, (100, 64)) for x in c])
    scanned = []
    scan = K.scan
    monkeypatch.setattr(K, "scan", lambda v, c: scanned.append(len(v)) or scan(v, c))
    block = K.Block.new(v, 8)
    block.round(c, np.zeros(8))
    again = K.Block.load({**block.columns(), "vectors": v.astype("<i2").tobytes(), "dtype": "<i2"}, 64)
    assert again.round(c, np.full(8, 1.0)) == {} and scanned == [800]
    again.round(c, np.full(8, 1e9))
    assert scanned == [800, 800]


def test_queries_against_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    for name, n in (("op13_centroid_clusters", 500), ("op11_topk_search", 50)):
        df = queries.QUERIES[name](spark, SF)
        want = con.sql(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
        got = [tuple(r) for r in df.collect()]
        assert len(got) == n and Counter(got) == Counter(want)


# ------------------------------------------------------------------ top-k

def top_brute(rows, k=10):
    kept = [(n, i, [max(-T.LIMIT, min(T.LIMIT, floor(1024 * f32(x)))) for x in v]) for n, (i, v) in enumerate(rows)
            if v is not None and all(x is not None and isfinite(x) for x in v)]
    out = Counter()
    for n, i, q in kept:
        if i is None or i % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(q, v)), j is None, j or 0, j) for m, j, v in kept if m != n]
        out.update((i, r, j, -s) for r, (s, _, _, j) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1))
    return out


@pytest.mark.parametrize("seed,shard", [(1, 4096), (2, 40)])
def test_top_k_against_brute_force(spark, seed, shard):
    rows = mixed(seed, 600) + [(2000 + i, [0.5] * 64) for i in range(20)] + [(2000, [0.5] * 64), (None, None)]
    got = T.top_k(table(spark, rows), T.F.col("vec_id") % 100 == 0, shard=shard)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert Counter(tuple(r) for r in got.collect()) == top_brute(rows)


def test_top_k_edge_cases(spark):
    for rows in ([], odd(), [(100, [0.5, 1.0])], [(100, [0.5, -1.0]), (7, [2.0]), (8, []), (200, []), (9, [1.0, 1.0, 4.0])],
                 [(0, [3e38] * 64), (1, [-3e38] * 64), (2, [70_000.0] * 64), (3, [0.0] * 64)],
                 [(1, [0.5]), (2, [0.25])]):
        got = T.top_k(table(spark, rows), T.F.col("vec_id") % 100 == 0)
        assert Counter(tuple(r) for r in got.collect()) == top_brute(rows)


def test_cover_tree_and_pruning(monkeypatch):
    r = np.random.default_rng(3)
    centres = r.normal(0, 1, (40, 16)) * 1000
    x = np.rint(np.concatenate([c + r.normal(0, 20, (100, 16)) for c in centres])).astype(np.int64)
    x[500:700] = x[500]
    order, nodes = T.build(x, 64)
    assert sorted(order.tolist()) == list(range(len(x)))
    tree = T.CoverTree(x[order], nodes)
    for n in range(len(tree.lo)):
        own = tree.points[tree.lo[n]:tree.hi[n]].astype(float)
        assert np.sqrt(((own - own[0]) ** 2).sum(axis=1)).max() <= tree.radius[n]
        if tree.children[n]:
            c = range(tree.child[n], tree.child[n] + tree.children[n])
            assert [tree.lo[c[0]], *[tree.hi[i] for i in c]] == [tree.lo[n], *[tree.lo[i] for i in c[1:]], tree.hi[n]]
        else:
            assert len(own) <= 64 or tree.radius[n] == 0
    q_order, q_nodes = T.build(x[::10], 16)
    q = T.CoverTree(x[::10][q_order], q_nodes)
    best, seen = T.Best(400, 10), []
    offer = T.Best.offer
    monkeypatch.setattr(T.Best, "offer", lambda self, f, s, *a: seen.append(s.size) or offer(self, f, s, *a))
    T.search(q, tree, best, np.arange(400) + 10_000, np.arange(4000), np.zeros(4000, bool), order)
    assert sum(seen) < 0.5 * 400 * 4000
    scores = q.points @ tree.points.T
    for i in range(400):
        want = sorted(zip((-scores[i]).tolist(), order.tolist()))[:10]
        assert list(zip((-best.found[i][0]).tolist(), best.found[i][2].tolist())) == want
