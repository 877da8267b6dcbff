"""Clusters and heat of the pages' point layers; keyed lookups that skip row groups."""

import math
import random
import tempfile
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from orbis.operators import lookup as LK
from orbis.operators import spatial as SP
from orbis.sinks import tables as K


def points(spark, rows):
    return spark.createDataFrame([((x, y),) for x, y in rows], "centroid struct<x:double,y:double>").repartition(4)


def px(x, y, zoom):
    world = 256 * 2 ** zoom
    lat = math.radians(y)
    return round((x + 180) / 360 * world, 6), round((0.5 - math.log(math.tan(lat) + 1 / math.cos(lat)) / (2 * math.pi)) * world, 6)


def some_points(seed):
    r = random.Random(seed)
    rows = [(r.uniform(5, 20), r.uniform(40, 52)) for _ in range(300)]
    for _ in range(5):
        cx, cy = r.uniform(5, 20), r.uniform(40, 52)
        rows += [(cx + r.gauss(0, 0.1), cy + r.gauss(0, 0.1)) for _ in range(60)]
    return rows + [(10.0, 45.0)] * 500                          # one place holds a third of all


def cells_of(rows, zoom, size):
    cells = defaultdict(list)
    for x, y in rows:
        a, b = px(x, y, zoom)
        cells[math.floor(a / size), math.floor(b / size)].append((a, b))
    return cells


@pytest.mark.parametrize("seed", [1, 2])
def test_radius_clusters_against_brute_force(spark, seed):
    rows, radius = some_points(seed), 50
    got = {(r.zoom, r.gx, r.gy): (r.n, r.n_cells) for r in
           SP.radius_clusters(points(spark, rows), [4, 7], radius).collect()}
    want = Counter(), Counter()
    for zoom in (4, 7):
        cells = cells_of(rows, zoom, radius)
        mean = {c: (sum(a for a, _ in v) / len(v), sum(b for _, b in v) / len(v)) for c, v in cells.items()}
        around = lambda c: [(c[0] + i, c[1] + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
        rank = lambda c: (-len(cells[c]), c)
        heads = {c for c in cells if min((x for x in around(c) if x in cells), key=rank) == c}
        for c in cells:
            near = [h for h in around(c) if h in heads and math.dist(mean[c], mean[h]) <= radius]
            to = (zoom, *min(near, key=rank, default=c))
            want[0][to] += len(cells[c])
            want[1][to] += 1
    assert got == {k: (want[0][k], want[1][k]) for k in want[0]}
    assert sum(n for (z, _, _), (n, _) in got.items() if z == 4) == len(rows)      # every point once


def test_points_across_a_cell_edge_join_one_cluster(spark):
    step = 360 / (256 * 2 ** 4)                                # one pixel at zoom 4
    edge = 50 * step * math.floor((10 + 180) / (50 * step)) - 180
    rows = [(edge - step, 45.0)] * 3 + [(edge + step, 45.0)] * 4 + [(edge + 45 * step, 45.0)]
    got = sorted((r.n, r.n_cells) for r in SP.radius_clusters(points(spark, rows), [4], 50).collect())
    assert got == [(8, 2)]


def test_heat_surface_against_brute_force(spark):
    rows = some_points(3)
    kernel = SP.heat_kernel(10, 4)
    assert (0, 0, 1.0) in kernel and all(math.hypot(i * 4, j * 4) < 10 for i, j, _ in kernel)
    want = defaultdict(float)
    for (a, b), own in cells_of(rows, 6, 4).items():
        for i, j, w in kernel:
            want[a + i, b + j] += len(own) * w
    got = {(r.gx, r.gy): r.heat for r in SP.heat_surface(points(spark, rows), [6], 10, 4).collect()}
    assert got.keys() == want.keys() and all(got[c] == pytest.approx(want[c]) for c in want)


# ------------------------------------------------------------------ keyed lookups

def rows_read(df):
    """Rows that the scans of an executed query returned."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan
    total, todo = 0, [plan]
    while todo:
        p = todo.pop()
        if p.nodeName().startswith("Scan parquet"):
            total += p.metrics().get("numOutputRows").get().value()
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return total


def test_short_id_lists_skip_row_groups(spark):
    base = tempfile.mkdtemp(prefix="orbis-ids-")
    for kind in "nw":
        # ids in no order over the files, as an ingest leaves them
        rows = spark.range(200_000).select(F.concat(F.lit(kind), F.col("id").cast("string")).alias("id"), F.col("id").alias("v"),
                                           F.xxhash64("id").alias("noise")).repartition(4, F.col("noise"))
        K.write_kind(rows, f"{base}/g", kind)
    g = spark.read.parquet(f"{base}/g")
    for ids in (["n17"], ["n17", "w199999", "n4444", "x1"], [f"w{i * 7}" for i in range(40)]):
        df = LK.get_geometries(g, ids)
        assert sorted(r.id for r in df.collect()) == sorted(i for i in ids if i[0] in "nw")
        assert rows_read(df) < 400_000 * 0.9
    assert rows_read(LK.get_geometries(g, ["n17"])) < 50_000
    assert LK.get_geometries(g, ["w200001", None]).count() == 0 and LK.get_geometries(g, []).count() == 0
    many = [f"n{i}" for i in range(1200)]
    assert LK.get_geometries(g, many).count() == 1200
