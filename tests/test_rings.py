"""V3 ring stitching on small hand-written relations (FIXTURES.md §4)."""

import pytest
from pyspark.sql import functions as F

from orbis.operators.rings import stitch_rings

T = "rel_id long, pos long, parts array<struct<t:string,pts:array<struct<x:double,y:double>>>>"


def run(spark, rows):
    df = spark.createDataFrame(rows, T)
    return {r.osm_id: r for r in stitch_rings(df).collect()}


def ring(*pts):
    return list(pts)


def test_closed_way_is_a_ring(spark):
    sq = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]
    out = run(spark, [(1, 0, [("pl", sq)])])
    assert [p.t for p in out[1].parts] == ["pl"]


def test_half_rings_one_reversed(spark):
    a = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0)]
    b = [(0.0, 0.0), (0.0, 2.0), (2.0, 2.0)]          # runs the other way
    out = run(spark, [(2, 0, [("ls", a)]), (2, 1, [("ls", b)])])
    pts = out[2].parts[0].pts
    assert len(pts) == 5 and (pts[0].x, pts[0].y) == (pts[-1].x, pts[-1].y)


def test_shell_with_hole(spark):
    shell = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]
    hole = [(2.0, 2.0), (4.0, 2.0), (4.0, 4.0), (2.0, 4.0), (2.0, 2.0)]
    out = run(spark, [(3, 0, [("pl", hole)]), (3, 1, [("pl", shell)])])
    assert [p.t for p in out[3].parts] == ["pl", "h"]
    assert out[3].parts[0].pts[1].x == 10.0


def test_open_chain_dropped(spark):
    out = run(spark, [(4, 0, [("ls", [(0.0, 0.0), (1.0, 0.0)])]),
                      (4, 1, [("ls", [(1.0, 0.0), (1.0, 1.0)])])])
    assert 4 not in out


def test_largest_shell_wins_o3(spark):
    small = [(20.0, 20.0), (21.0, 20.0), (21.0, 21.0), (20.0, 20.0)]
    big = [(0.0, 0.0), (5.0, 0.0), (5.0, 5.0), (0.0, 0.0)]
    out = run(spark, [(5, 0, [("pl", small)]), (5, 1, [("pl", big)])])
    assert out[5].parts[0].pts[1].x == 5.0


def test_hole_centroid_and_wkt(spark):
    from orbis.functions import geometry as GM
    shell = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    hole = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)]
    df = spark.createDataFrame([([("pl", shell), ("h", hole)],)],
                               "parts array<struct<t:string,pts:array<struct<x:double,y:double>>>>")
    r = df.select(GM.centroid("parts").alias("c"), GM.wkt(F.lit("pl"), "parts").alias("w")).first()
    # L-shape: area 12, centroid (7/3, 7/3)
    assert (r.c.x, r.c.y) == pytest.approx((7 / 3, 7 / 3))
    assert r.w == "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (0 0, 2 0, 2 2, 0 2, 0 0))"


# ------------------------------------------------------------------ faces

def areas(lines):
    from orbis.operators.rings import faces
    out = []
    for shell, holes in faces([[tuple(map(float, p)) for p in ln] for ln in lines]):
        size = [abs(sum(x0 * y1 - x1 * y0 for (x0, y0), (x1, y1) in zip(r, r[1:]))) / 2 for r in (shell, *holes)]
        out.append((size[0], size[0] - sum(size[1:])))
    return out


def turned(lines):
    """Other member orders and line directions."""
    import itertools
    for k, order in enumerate(itertools.islice(itertools.permutations(lines), 0, None, 7)):
        yield [ln[::-1] if (k + i) % 2 else ln for i, ln in enumerate(order)]


def test_square_with_diagonal_has_two_faces():
    lines = [[(0, 0), (4, 0)], [(4, 0), (4, 4)], [(4, 4), (0, 4)], [(0, 4), (0, 0)], [(0, 0), (4, 4)]]
    for own in turned(lines):
        assert areas(own) == [(8, 8), (8, 8)]


def test_boxes_that_share_an_edge():
    from orbis.operators.rings import faces
    lines = [[(0, 0), (1, 0)], [(1, 0), (1, 1)], [(1, 1), (0, 1), (0, 0)], [(1, 0), (4, 0), (4, 1), (1, 1)]]
    for own in turned(lines):
        assert areas(own) == [(3, 3), (1, 1)]
        assert faces([list(ln) for ln in own])[0][0] == [(1, 0), (4, 0), (4, 1), (1, 1), (1, 0)]


def test_dangles_bridges_and_touching_rings():
    square = [[(0, 0), (9, 0)], [(9, 0), (9, 9), (0, 9), (0, 0)]]
    inner = [[(0, 0), (2, 1)], [(2, 1), (2, 2), (1, 2)], [(1, 2), (0, 0)]]         # touches a corner from inside
    apart = [[(5, 4), (6, 4), (6, 5), (5, 4)]]
    bridge = [[(9, 0), (20, 0)], [(20, 0), (22, 0), (22, 2)], [(22, 2), (20, 0)], [(22, 2), (30, 9)]]
    for own in (square + inner + apart + bridge, (square + inner + apart + bridge)[::-1]):
        assert areas(own) == [(81, 78.5), (2, 2), (2, 2), (0.5, 0.5)]
    assert areas(square + square[::-1] + [square[0][::-1]]) == [(81, 81)]          # repeated lines count once
    assert areas(bridge[:1] + bridge[3:]) == []


def test_nested_rings_are_faces_with_holes():
    ring = lambda a, b: [(a, a), (b, a), (b, b), (a, b), (a, a)]
    assert areas([ring(0, 10), ring(2, 8), ring(4, 6)]) == [(100, 64), (36, 32), (4, 4)]


def test_random_streets_against_cell_counts():
    """Faces of a lattice with streets left out, against flood filling its cells."""
    import random
    r = random.Random(2)
    for _ in range(60):
        n = 5
        across = {(i, j) for i in range(n) for j in range(n + 1) if r.random() < 0.75}
        up = {(i, j) for i in range(n + 1) for j in range(n) if r.random() < 0.75}
        lines = [[(i, j), (i + 1, j)] for i, j in across] + [[(i, j), (i, j + 1)] for i, j in up]
        cells = {(i, j) for i in range(-1, n + 1) for j in range(-1, n + 1)}
        sizes = []
        while cells:
            todo, room = [next(iter(cells))], set()
            while todo:
                i, j = todo.pop()
                if (i, j) not in cells:
                    continue
                cells.discard((i, j))
                room.add((i, j))
                todo += [(i, j + 1)] * ((i, j + 1) not in across) + [(i, j - 1)] * ((i, j) not in across) \
                    + [(i + 1, j)] * ((i + 1, j) not in up) + [(i - 1, j)] * ((i, j) not in up)
            if not any(-1 in c or n in c for c in room):
                sizes.append(len(room))
        assert sorted(a for _, a in areas(lines)) == sorted(sizes)
