r"""Exact top-k search by inner product with two cover trees (operator 11).

Queries and data are indexed the same way.  Every vector goes to its nearest pivot (a bounded
sample of the rows, which bears on speed alone), rows are range-partitioned by (pivot, distance), and
each run of up to ``SHARD`` neighbours becomes one cover tree: a node has a centre that is
one of its vectors and a measured covering radius; its children's centres are picked
farthest first, until all lie within half the radius or there are ``FANOUT`` of them.

*Search.*  No inner product between two nodes exceeds
``<a, b> + |a| s + |b| r + r s`` (centres a, b, radii r, s).  A pair of nodes is dropped when that is
below the worst kth score of the queries in its query node; else both are
opened, best pairs first, down to leaves, whose vectors are multiplied exactly.  Equal scores are
never dropped, so ties come out right.

*On Spark.*  Blocks meet in two passes.  In the first each query shard searches the data shard with the best bound, which gives
every query a kth score; in the second it meets only data shards whose bound reaches the worst of
these.  Shard pairs are picked on centres and radii alone; vectors are joined to the pairs left, and each
pair is one row of a task.  A query's candidates, at most k for each shard pair,
meet in a ranked window that Spark cuts to k before the shuffle.

Defined results: vectors that are null or hold a null or non-finite component take no part; a
shorter vector counts as filled up with zeros (an empty one scores 0); components are held as integers up to
``LIMIT`` in size (a larger one counts as that, so that scores of up to 2,048 components fit a long);
a null id is no query, and a candidate after all other ids of its score; rows that repeat an id are
queries and candidates of their own, each left out of its own answer only; an empty table, or one
without queries, gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orbis.llm.centroid_clusters import finite, whole
from orbis.llm.common import limit_batches, ship, shuffle_width, written

ship(__name__)

K = 10
SCALE = 1024
LIMIT = 1 << 26
PIVOTS = 64                  # rows of the sample that orders the table
SHARD = 4096
LEAF = 64
QUERY_LEAF = 16
FANOUT = 8
OPEN = 8                     # data nodes that a query leaf opens at a time
SLACK = 1e-9


class CoverTree:
    """Vectors in tree order; node n owns the vectors lo[n]:hi[n], the first is its centre."""

    def __init__(self, points: np.ndarray, arrays: dict[str, np.ndarray]):
        self.points = points
        self.lo, self.hi, self.child, self.children = (arrays[c] for c in ("lo", "hi", "child", "children"))
        self.radius = arrays["radius"]
        self.centre = points[self.lo].astype(np.float64)
        self.norm = np.sqrt((self.centre ** 2).sum(axis=1))

    def opened(self, nodes: np.ndarray) -> np.ndarray:
        """The children of ``nodes``."""
        return np.concatenate([np.arange(c, c + n) for c, n in zip(self.child[nodes], self.children[nodes])])


def build(points: np.ndarray, leaf: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """(order of the points, node arrays) of a cover tree."""
    x = points.astype(np.float64)
    order = np.arange(len(x))
    lo, hi, child, children, radius = [0], [len(x)], [0], [0], [0.0]
    todo = [0]
    while todo:
        n = todo.pop()
        own = order[lo[n]:hi[n]]
        p = x[own]
        near = np.sqrt(((p - p[0]) ** 2).sum(axis=1))
        radius[n] = float(near.max()) * (1 + SLACK)
        if len(own) <= leaf or not near.any():
            continue
        half, of, firsts = near.max() / 2, np.zeros(len(own), np.int64), [0]
        while len(firsts) < FANOUT and near.max() > half:
            far = int(near.argmax())
            d = np.sqrt(((p - p[far]) ** 2).sum(axis=1))
            of[d < near] = len(firsts)
            near = np.minimum(near, d)
            firsts.append(far)
        first = np.ones(len(own), np.int64)
        first[firsts] = 0                                        # a child's centre comes first
        by = np.lexsort((first, of))
        order[lo[n]:hi[n]] = own[by]
        ends = lo[n] + np.cumsum(np.bincount(of, minlength=len(firsts)))
        child[n], children[n] = len(lo), len(firsts)
        todo += range(len(lo), len(lo) + len(firsts))
        lo += [lo[n], *ends[:-1].tolist()]
        hi += ends.tolist()
        child += [0] * len(firsts)
        children += [0] * len(firsts)
        radius += [0.0] * len(firsts)
    return order, {"lo": np.array(lo, "<i4"), "hi": np.array(hi, "<i4"), "child": np.array(child, "<i4"),
                   "children": np.array(children, "<i4"), "radius": np.array(radius, "<f8")}


class Best:
    """The k best (score, id) of each query so far; ids ascend within a score, null ids last."""

    def __init__(self, n: int, k: int, kth: np.ndarray | None = None):
        self.k = k
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [
            (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in range(n)]
        self.kth = np.full(n, -np.inf) if kth is None else kth.copy()

    def offer(self, first: int, scores: np.ndarray, null: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        """``scores`` of the queries from ``first`` on; ``own`` marks a query's own row."""
        good = (scores >= self.kth[first:first + len(scores), None]) & ~own
        for i in np.flatnonzero(good.any(axis=1)).tolist():
            at = np.flatnonzero(good[i])
            s, n, v = self.found[first + i]
            s, n, v = np.r_[s, scores[i, at]], np.r_[n, null[at]], np.r_[v, ids[at]]
            by = np.lexsort((v, n, -s))[:self.k]
            self.found[first + i] = s[by], n[by], v[by]
            if len(by) == self.k:
                self.kth[first + i] = max(self.kth[first + i], s[by[-1]])


def bounds(q: CoverTree, node: int, d: CoverTree, nodes: np.ndarray) -> np.ndarray:
    """No inner product between the query node and each data node is larger."""
    a, r = q.norm[node], q.radius[node]
    b, s = d.norm[nodes], d.radius[nodes]
    return d.centre[nodes] @ q.centre[node] + a * s + b * r + r * s + SLACK * ((a + r) * (b + s) + 1)


def search(q: CoverTree, d: CoverTree, best: Best, q_uid: np.ndarray, d_uid: np.ndarray, null: np.ndarray,
           ids: np.ndarray) -> None:
    """Dual-tree search; what it finds goes to ``best``."""
    most = max(np.abs(q.points).max(initial=0), 1) * max(np.abs(d.points).max(initial=0), 1) * q.points.shape[1]
    kind = np.float64 if most < 1 << 52 else np.int64          # both exact
    qx, dx = q.points.astype(kind), d.points.astype(kind)

    def leaf(node: int, nodes: np.ndarray) -> None:
        lo, hi = q.lo[node], q.hi[node]
        at = bounds(q, node, d, nodes)
        while True:
            good = at >= best.kth[lo:hi].min()
            nodes, at = nodes[good], at[good]
            if not len(nodes):
                return
            by = np.argsort(-at, kind="stable")
            now, nodes, at = nodes[by[:OPEN]], nodes[by[OPEN:]], at[by[OPEN:]]
            ends = now[d.children[now] == 0]
            if len(ends):
                rows = np.concatenate([np.arange(a, b) for a, b in zip(d.lo[ends], d.hi[ends])])
                scores = (qx[lo:hi] @ dx[rows].T).astype(np.int64)
                best.offer(lo, scores, null[rows], ids[rows], q_uid[lo:hi, None] == d_uid[None, rows])
            inner = now[d.children[now] > 0]
            if len(inner):
                more = d.opened(inner)
                nodes, at = np.r_[nodes, more], np.r_[at, bounds(q, node, d, more)]

    todo = [(0, np.zeros(1, np.int64))]
    while todo:
        node, nodes = todo.pop()
        nodes = nodes[bounds(q, node, d, nodes) >= best.kth[q.lo[node]:q.hi[node]].min()]
        if not len(nodes):
            continue
        if not q.children[node]:
            leaf(node, nodes)
            continue
        inner = nodes[d.children[nodes] > 0]
        nodes = np.r_[nodes[d.children[nodes] == 0], d.opened(inner)] if len(inner) else nodes
        todo += [(c, nodes) for c in range(q.child[node], q.child[node] + q.children[node])]


_NODES = [("lo", "<i4"), ("hi", "<i4"), ("child", "<i4"), ("children", "<i4"), ("radius", "<f8")]
_TREE_SCHEMA = ("shard string, centre array<double>, norm double, reach double, dtype string, points binary, uids binary, "
                "nulls binary, ids binary, " + ", ".join(f"{c} binary" for c, _ in _NODES))


def _load(row: dict, dim: int) -> tuple[CoverTree, np.ndarray, np.ndarray, np.ndarray]:
    tree = CoverTree(np.frombuffer(row["points"], row["dtype"]).reshape(-1, dim).astype(np.int64),
                     {c: np.frombuffer(row[c], t) for c, t in _NODES})
    return (tree, np.frombuffer(row["uids"], "<i8"), np.frombuffer(row["nulls"], bool),
            np.frombuffer(row["ids"], "<i8"))


def _placed(pivots: np.ndarray, dim: int):
    """mapInArrow (vec_id, v, query, uid): vectors as bytes, with nearest pivot and distance to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.column(1)
            size = rows.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            v = np.zeros((b.num_rows, dim), np.int64)
            v[np.repeat(np.arange(b.num_rows), size),
              np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = rows.flatten().to_numpy()
            x = v.astype(np.float64)
            d = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * (x @ pivots.T)
            near = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), b.column(3), pa.array(near.astype(np.int32)),
                 pa.array(np.sqrt(np.maximum(d[np.arange(len(d)), near], 0))),
                 pa.array([r.tobytes() for r in v.astype("<i4")], pa.binary())],
                names=["vec_id", "query", "uid", "pivot", "far", "v"])
    return run


def _trees(dim: int, leaf: int, shard: int):
    """mapInArrow over sorted rows: one cover tree for each run of up to ``shard`` rows."""
    def tree(rows: pa.Table, name: str) -> pa.RecordBatch:
        v = np.frombuffer(b"".join(rows.column("v").to_pylist()), "<i4").reshape(-1, dim)
        order, nodes = build(v, leaf)
        v = v[order]
        most = int(np.abs(v.astype(np.int64)).max(initial=0))
        dtype = "<i1" if most < 128 else "<i2" if most < 1 << 15 else "<i4"
        ids = rows.column("vec_id")
        null = ids.is_null().to_numpy()[order]
        centre = v[0].astype(np.float64)
        values = [name, centre.tolist(), float(np.sqrt((centre ** 2).sum())), float(nodes["radius"][0]), dtype,
                  v.astype(dtype).tobytes(), rows.column("uid").to_numpy()[order].astype("<i8").tobytes(),
                  null.tobytes(), ids.fill_null(0).to_numpy()[order].astype("<i8").tobytes(),
                  *[nodes[c].astype(t).tobytes() for c, t in _NODES]]
        types = [pa.string(), pa.list_(pa.float64()), pa.float64(), pa.float64(), pa.string(), *[pa.binary()] * 9]
        return pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in zip(values, types)],
            names=["shard", "centre", "norm", "reach", "dtype", "points", "uids", "nulls", "ids",
                   *[c for c, _ in _NODES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, n, held = TaskContext.get().partitionId(), 0, None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            while held.num_rows >= shard:
                yield tree(held.slice(0, shard), f"{part}-{n}")
                held, n = held.slice(shard), n + 1
        if held is not None and held.num_rows:
            yield tree(held, f"{part}-{n}")
    return run


def _searched(dim: int, k: int):
    """mapInArrow over (query tree, data tree, kth): the candidates of each query, and its kth score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row in b.to_pylist():
                q, q_uid, _, q_ids = _load(row["q"], dim)
                d, d_uid, null, ids = _load(row["d"], dim)
                best = Best(len(q_uid), k, np.frombuffer(row["kth"], "<f8") if row["kth"] else None)
                search(q, d, best, q_uid, d_uid, null, ids)
                out.append({"shard": row["q"]["shard"], "kth": best.kth.astype("<f8").tobytes(),
                            "low": float(best.kth.min()), "found": [
                    {"uid": u, "query_id": i, "scores": s.tolist(),
                     "ids": [None if z else x for x, z in zip(v.tolist(), n.tolist())]}
                    for u, i, (s, n, v) in zip(q_uid.tolist(), q_ids.tolist(), best.found) if len(s)]})
            found = pa.list_(pa.struct([("uid", pa.int64()), ("query_id", pa.int64()),
                                        ("scores", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64()))]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["shard"] for r in out], pa.string()), pa.array([r["kth"] for r in out], pa.binary()),
                 pa.array([r["low"] for r in out], pa.float64()), pa.array([r["found"] for r in out], found)],
                names=["shard", "kth", "low", "found"])
    return run


_FOUND = ("shard string, kth binary, low double, "
          "found array<struct<uid long, query_id long, scores array<long>, ids array<long>>>")


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
          k: int = K, scale: int = SCALE, shard: int = SHARD) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best other rows of each row for
    which ``is_query`` holds.  Ids must be integers."""
    spark = vectors.sparkSession
    limit_batches(spark)
    v = F.col(vector_col)
    base = written(vectors.where(finite(v)).select(
        F.col(id_col).cast("long").alias("vec_id"), whole(v, scale, LIMIT).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("query"), F.monotonically_increasing_id().alias("uid")), "op11-rows")
    dim = max(base.agg(F.max(F.size("v"))).first()[0] or 0, 1)
    picked = base.orderBy(F.xxhash64("v"), "uid").limit(PIVOTS).select("v").collect()     # at most PIVOTS rows
    pivots = np.array([list(r.v) + [0] * (dim - len(r.v)) for r in picked], np.float64).reshape(-1, dim)
    out = "query_id long, rank int, vec_id long, score long"
    if not len(pivots):
        return spark.createDataFrame([], out)
    placed = base.mapInArrow(_placed(pivots, dim),
                             "vec_id long, query boolean, uid long, pivot int, far double, v binary")
    order = ["pivot", "far", "uid"]

    def indexed(rows: DataFrame, leaf: int, name: str) -> DataFrame:
        dealt = rows.repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order)
        return written(dealt.select("vec_id", "uid", "v").mapInArrow(_trees(dim, leaf, shard), _TREE_SCHEMA), name)
    data = indexed(placed, LEAF, "op11-data")
    queries = indexed(placed.where("query"), QUERY_LEAF, "op11-queries")

    # pairs of shards, by their roots alone
    q = queries.select(F.col("shard").alias("qs"), F.col("centre").alias("qc"), F.col("norm").alias("qn"),
                       F.col("reach").alias("qr"))
    d = data.select(F.col("shard").alias("ds"), F.col("centre").alias("dc"), F.col("norm").alias("dn"),
                    F.col("reach").alias("dr"))
    bound = _dot("qc", "dc") + F.expr("qn * dr + dn * qr + qr * dr") \
        + SLACK * (F.expr("(qn + qr) * (dn + dr)") + 1)
    pairs = written(q.join(d, F.lit(True)).select("qs", "ds", bound.alias("bound")), "op11-pairs")

    def searched(wanted: DataFrame) -> DataFrame:
        whole_q = queries.select(F.struct("*").alias("q"))
        whole_d = data.select(F.struct("*").alias("d"))
        rows = wanted.join(whole_d, F.col("ds") == F.col("d.shard")).join(whole_q, F.col("qs") == F.col("q.shard"))
        return written(rows.select("q", "d", "kth").mapInArrow(_searched(dim, k), _FOUND), "op11-found")
    start = pairs.groupBy("qs").agg(F.max_by("ds", F.struct("bound", "ds")).alias("ds"))
    first = searched(start.withColumn("kth", F.lit(None).cast("binary")))
    known = first.select(F.col("shard").alias("s"), "kth", "low")
    rest = pairs.join(start, ["qs", "ds"], "left_anti").join(known, F.col("qs") == F.col("s")) \
        .where(F.col("bound") >= F.col("low")).select("qs", "ds", "kth")
    found = first.unionAll(searched(rest)).select(F.explode("found").alias("f")).select(
        "f.uid", "f.query_id", F.explode(F.arrays_zip("f.scores", "f.ids")).alias("x")) \
        .select("uid", "query_id", F.col("x.ids").alias("vec_id"), F.col("x.scores").alias("score"))
    ranked = Window.partitionBy("uid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
