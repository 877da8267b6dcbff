r"""Centroid clustering with heap-ordered bounds (operator 13).

Lloyd's rounds on integer vectors.  When a vector is scanned, its distance to its own
centroid (upper) and to the nearest other one (lower) leave a gap.  Every round a gap shrinks by
no more than the drift of its own centroid plus the largest drift of the others, which is the
same for all vectors of a cluster: each cluster keeps one accumulated drift and a heap of its
vectors, keyed by gap + the accumulated drift at the time of the scan.  A round looks
at the top of each heap, pops only vectors whose gap is used up, and rescans those exactly;
nobody else is touched.  Distances are exact integers, so ties go to the smaller number;
gaps are floating point and are shortened by more than their rounding.

*On Spark.*  Vectors lie in blocks (one row of a written table: ids, integers, heaps); a round maps
over the blocks where they lie, without a shuffle, and writes them again.  Only what moved
is summed (map-side, one row per cluster); the driver holds k centroids and k sums.
The table of a round is removed when the next one is written.

Defined results: vectors that are null, have another length than ``dim``, or hold a null or
non-finite component are left out; components are held as integers up to ``LIMIT`` in
size (a larger one counts as that: squared distances beyond would not fit a long); a null id is
hashed as an empty one and is returned as null; repeated rows are vectors of their own; seeds with equal hashes
are ordered by their components; with fewer vectors than k there are fewer centroids;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbis.llm.common import discard, limit_batches, ship, written

ship(__name__)

K = 16
ROUNDS = 3
SCALE = 64
DIM = 64
LIMIT = 1 << 27
FLOAT_LIMIT = 1 << 22           # up to here sums of products of 64 integers are exact in a double
BLOCK = 2048
SLACK = 1e-9                    # shortens gaps and lengthens drifts by more than rounding


def finite(vector: Column) -> Column:
    """No component is null, infinite or not a number (null for a null vector)."""
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def whole(vector: Column, scale: int, limit: int) -> Column:
    """floor(scale * x) of each component, no larger than ``limit`` in size."""
    return F.transform(vector, lambda x: F.floor(F.greatest(F.lit(-float(limit)), F.least(
        F.lit(float(limit)), x.cast("double") * scale))))


def distances(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors (rows of ``v``) to centroids."""
    if max(np.abs(v).max(initial=0), np.abs(c).max(initial=0)) <= FLOAT_LIMIT:
        a, b = v.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    return np.stack([((v - x) ** 2).sum(axis=1) for x in c], axis=1)


def scan(v: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each vector and the gap to the second nearest, rounded down."""
    d = distances(v, c)
    own = d.argmin(axis=1)                        # the first of equals
    upper = np.sqrt(d[np.arange(len(v)), own].astype(np.float64))
    d[np.arange(len(v)), own] = np.iinfo(np.int64).max
    lower = np.sqrt(d.min(axis=1).astype(np.float64)) if len(c) > 1 else np.full(len(v), np.inf)
    return own.astype(np.int32), lower * (1 - SLACK) - upper * (1 + SLACK) - SLACK


class Block:
    """Vectors, their clusters, and one heap of (key, vector) per cluster."""

    def __init__(self, v: np.ndarray, own: np.ndarray, heaps: list[list[tuple[float, int]]]):
        self.v, self.own, self.heaps = v, own, heaps

    @classmethod
    def new(cls, v: np.ndarray, k: int) -> Block:
        """Nothing is known yet: all vectors are popped by the first round."""
        heaps = [[(-np.inf, i) for i in range(len(v))]] + [[] for _ in range(k - 1)]
        return cls(v, np.full(len(v), -1, np.int32), heaps)

    def round(self, c: np.ndarray, drift: np.ndarray) -> dict[int, tuple[int, np.ndarray]]:
        """Rescans expired vectors; returns what clusters won and lost: (number, sum)."""
        popped = []
        for j, heap in enumerate(self.heaps):
            while heap and heap[0][0] <= drift[j]:
                popped.append(heappop(heap)[1])
        if not popped:
            return {}
        at = np.array(popped)
        before = self.own[at]
        after, gap = scan(self.v[at], c)
        self.own[at] = after
        for key, j, i in zip((gap + drift[after]).tolist(), after.tolist(), popped):
            heappush(self.heaps[j], (key, i))
        moved: dict[int, tuple[int, np.ndarray]] = {}
        for sign, side in ((1, after), (-1, before)):
            for j in np.unique(side[(before != after) & (side >= 0)]).tolist():
                rows = self.v[at[(before != after) & (side == j)]]
                n, total = moved.get(j, (0, 0))
                moved[j] = (n + sign * len(rows), total + sign * rows.sum(axis=0))
        return moved

    @classmethod
    def load(cls, row: dict, dim: int) -> Block:
        v = np.frombuffer(row["vectors"], row["dtype"]).reshape(-1, dim).astype(np.int64)
        keys, members = np.frombuffer(row["keys"], "<f8").tolist(), np.frombuffer(row["members"], "<i4").tolist()
        ends = np.cumsum(row["sizes"]).tolist()
        heaps = [list(zip(keys[a:b], members[a:b])) for a, b in zip([0, *ends], ends)]
        return cls(v, np.frombuffer(row["own"], "<i4").copy(), heaps)

    def columns(self) -> dict:
        """As stored; a heap is stored in its own order, so it need not be built again."""
        flat = [x for heap in self.heaps for x in heap]
        return {"own": self.own.astype("<i4").tobytes(), "sizes": [len(h) for h in self.heaps],
                "keys": np.array([x for x, _ in flat], "<f8").tobytes(),
                "members": np.array([i for _, i in flat], "<i4").tobytes()}


def _moved_rows(moved: dict[int, tuple[int, np.ndarray]]) -> list[dict]:
    return [{"cluster": j, "n": n, "sums": total.tolist()} for j, (n, total) in sorted(moved.items())]


_MOVED = pa.list_(pa.struct([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]))
_STATE = [("dtype", pa.string()), ("vectors", pa.binary()), ("own", pa.binary()), ("sizes", pa.list_(pa.int32())),
          ("keys", pa.binary()), ("members", pa.binary()), ("moved", _MOVED)]
_SCHEMA = ("ids array<{kind}>, dtype string, vectors binary, own binary, sizes array<int>, keys binary, "
           "members binary, moved array<struct<cluster int, n long, sums array<long>>>")


def _batch(ids: pa.Array, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([ids, *[pa.array([r[c] for r in rows], t) for c, t in _STATE]],
                                      names=["ids", *[c for c, _ in _STATE]])


def _first(c: np.ndarray, dim: int):
    """mapInArrow (vec_id, components): blocks after their first assignment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drift = np.zeros(len(c))
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                own = b.slice(at, BLOCK)
                v = own.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                most = int(np.abs(v).max(initial=0))
                dtype = "<i1" if most < 128 else "<i2" if most < 1 << 15 else "<i4"
                block = Block.new(v, len(c))
                moved = block.round(c, drift)
                ids = pa.ListArray.from_arrays(pa.array([0, own.num_rows], pa.int32()), own.column(0))
                yield _batch(ids, [{"dtype": dtype, "vectors": v.astype(dtype).tobytes(), **block.columns(),
                                    "moved": _moved_rows(moved)}])
    return run


def _next(c: np.ndarray, drift: np.ndarray, dim: int):
    """mapInArrow over blocks: one more assignment.  A block in which no gap has
    expired is handed on as it is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.drop_columns(["ids"]).to_pylist()
            for row in rows:
                block = Block.load(row, dim)
                moved = block.round(c, drift)
                row |= {**block.columns(), "moved": _moved_rows(moved)}
            yield _batch(b.column("ids"), rows)
    return run


def _rows(c: np.ndarray, dim: int):
    """mapInArrow over blocks: vec_id, cluster, distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, far = [], []
            for row in b.drop_columns(["ids"]).to_pylist():
                block = Block.load(row, dim)
                own.append(block.own)
                far.append(((block.v - c[block.own]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [b.column("ids").flatten(), pa.array(np.concatenate(own) if own else [], pa.int32()),
                 pa.array(np.concatenate(far) if far else [], pa.int64())], names=["vec_id", "cluster", "distance"])
    return run


class Centroids:
    """k centroids with the exact sums and numbers of their vectors, and accumulated drifts."""

    def __init__(self, at: np.ndarray):
        self.at, self.drift = at, np.zeros(len(at))
        self.n = [0] * len(at)
        self.sums = [[0] * at.shape[1] for _ in at]

    def take(self, blocks: DataFrame) -> None:
        """Adds up what moved; at most one row per cluster comes to the driver."""
        dim = self.at.shape[1]
        x = blocks.select(F.explode("moved").alias("m")).select("m.*")
        for r in x.groupBy("cluster").agg(F.sum("n"), *[F.sum(F.get("sums", i)) for i in range(dim)]).collect():
            self.n[r[0]] += r[1]
            self.sums[r[0]] = [a + b for a, b in zip(self.sums[r[0]], r[2:])]

    def move(self) -> None:
        """Every centroid with vectors goes to the floor of their mean."""
        new = np.array([[s // n for s in own] if n else x.tolist()
                        for own, n, x in zip(self.sums, self.n, self.at)], np.int64)
        drift = np.sqrt(((new - self.at) ** 2).sum(axis=1).astype(np.float64))
        others = [max([0.0, *np.delete(drift, j)]) for j in range(len(drift))]
        self.drift += (drift + others) * (1 + SLACK)
        self.at = new

    def digests(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, x.tolist())).encode()).hexdigest() for x in self.at]


def seeds(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors (vec_id, v) with the smallest SHA-256 of ``salt:vec_id``, in that order."""
    name = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = vectors.select("v", F.sha2(name, 256).alias("h")).orderBy("h", "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
            rounds: int = ROUNDS, scale: int = SCALE, dim: int = DIM, salt: str = "1"
            ) -> tuple[DataFrame, Centroids]:
    """``(rows, centroids)``: rows has one row per vector (vec_id, cluster, distance: squared,
    to the final centroid)."""
    spark = vectors.sparkSession
    limit_batches(spark)
    v = F.col(vector_col)
    own = vectors.where((F.size(v) == dim) & finite(v)).select(F.col(id_col).alias("vec_id"),
                                                               whole(v, scale, LIMIT).alias("v"))
    kind = dict(own.dtypes)["vec_id"]
    c = Centroids(seeds(own, k, salt).reshape(-1, dim))
    if not len(c.at):
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long"), c
    blocks = written(own.mapInArrow(_first(c.at, dim), _SCHEMA.format(kind=kind)), "op13-blocks")
    for _ in range(rounds):
        c.take(blocks)
        c.move()
        before, blocks = blocks, written(blocks.mapInArrow(_next(c.at, c.drift.copy(), dim),
                                                           _SCHEMA.format(kind=kind)), "op13-blocks")
        discard(before)
    rows = written(blocks.mapInArrow(_rows(c.at, dim), f"vec_id {kind}, cluster int, distance long"), "op13-rows")
    discard(blocks)
    return rows, c


def cluster_report(vectors: DataFrame, **options) -> DataFrame:
    """The rows of ``cluster`` with cluster_inertia, inertia and centroid_sha256.  Sums that do not
    fit a long are null."""
    rows, c = cluster(vectors, **options)
    sums = dict(rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())  # k rows
    own = [int(sums.get(j, 0)) for j in range(len(c.at))]
    fits = lambda x: F.lit(x if x < 1 << 63 else None).cast("long")
    pick = lambda xs, kind: F.get(F.array(*xs).cast(f"array<{kind}>"), F.col("cluster"))
    return rows.select("vec_id", "cluster", "distance", pick(map(fits, own), "bigint").alias("cluster_inertia"),
                       fits(sum(own)).alias("inertia"), pick(map(F.lit, c.digests()), "string").alias("centroid_sha256"))
