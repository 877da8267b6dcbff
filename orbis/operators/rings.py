"""The polygon faces of a relation's member lines.

A relation's lines form a planar graph: nodes are the lines' end points, edges the whole
lines (crossing lines are not split).  Every edge has two halves, one per direction; around a
node the halves are ordered by angle, and a half is followed by the one next
clockwise from its twin, so a walk keeps one face on its left.

* an edge with the same face on both sides bounds nothing: dangles and bridges go,
  and the walks are made again on what is left;
* a walk that meets a node twice is cut there, so every ring is simple in its nodes;
* rings that run counter-clockwise are shells (minimal faces), the others are the outer edges of
  connected pieces, seen from outside: each is a hole of the smallest shell around it;
* the result is the shell with the largest ring area, with its holes (ties: the smallest points) --
  deterministic and the same in any member order, not "first found" (Q7, O3).

A ring of one closed line keeps its points as they are; a ring of several lines starts at its
smallest point and runs counter-clockwise.  Repeated lines (also reversed ones) count once.

All of a relation's lines are one row (a relation is one geometry row in the end, at most
32,000 members).  A relation whose only line is closed stays in Catalyst; the rows of
the others go through one Arrow UDF, with no shuffle of their own.  Functions are pickled by
value: executors need not have this package.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbis.functions.common import col_of
from orbis.functions.geometry import PARTS_TYPE, part

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Point = tuple[float, float]
Ring = list[Point]
Half = tuple[int, bool]                      # line number, whether it runs backwards


def _area2(xs: np.ndarray, ys: np.ndarray) -> float:
    return float(np.dot(xs[:-1], ys[1:]) - np.dot(xs[1:], ys[:-1]))


def _signed(ring: Ring) -> float:
    """Twice the signed area, measured from the first point (exact for points on a grid)."""
    xy = np.array(ring) - np.array(ring[0])
    return _area2(xy[:, 0], xy[:, 1])


def _inside(px: float, py: float, xs: np.ndarray, ys: np.ndarray) -> bool:
    """Even-odd ray test of a point against a closed ring."""
    x0, y0, x1, y1 = xs[:-1], ys[:-1], xs[1:], ys[1:]
    crosses = (y0 > py) != (y1 > py)
    with np.errstate(divide="ignore", invalid="ignore"):
        xint = x0 + (py - y0) * (x1 - x0) / (y1 - y0)
    return bool(np.count_nonzero(crosses & (px < xint)) % 2)


def _on_edge(px: float, py: float, xs: np.ndarray, ys: np.ndarray) -> bool:
    x0, y0, x1, y1 = xs[:-1], ys[:-1], xs[1:], ys[1:]
    level = (x1 - x0) * (py - y0) - (y1 - y0) * (px - x0) == 0
    return bool((level & (np.minimum(x0, x1) <= px) & (px <= np.maximum(x0, x1))
                 & (np.minimum(y0, y1) <= py) & (py <= np.maximum(y0, y1))).any())


def _contains(outer: tuple[np.ndarray, np.ndarray], inner: tuple[np.ndarray, np.ndarray]) -> bool:
    """Is ``inner`` inside ``outer``?  Decided by the first vertex of ``inner`` that is
    not on ``outer`` (rings may touch), else by the middle of its first edge."""
    ox, oy = outer
    ix, iy = inner
    if ix.min() < ox.min() or ix.max() > ox.max() or iy.min() < oy.min() or iy.max() > oy.max():
        return False
    for x, y in zip(ix.tolist(), iy.tolist()):
        if not _on_edge(x, y, ox, oy):
            return _inside(x, y, ox, oy)
    return _inside((ix[0] + ix[1]) / 2, (iy[0] + iy[1]) / 2, ox, oy)


def _by_angle(d: Point, e: Point) -> int:
    """Order of two directions, counter-clockwise from the positive x axis."""
    upper = [(0 if (y > 0 or (y == 0 and x > 0)) else 1) for x, y in (d, e)]
    if upper[0] != upper[1]:
        return upper[0] - upper[1]
    cross = d[0] * e[1] - d[1] * e[0]
    return -1 if cross > 0 else 1 if cross < 0 else 0


class Lines:
    """Member lines as a planar graph of half-edges."""

    def __init__(self, lines: list[Ring]):
        self.lines = lines
        self.live = set(range(len(lines)))

    def points(self, half: Half) -> Ring:
        line = self.lines[half[0]]
        return line[::-1] if half[1] else line

    def followers(self) -> dict[Half, Half]:
        """The half that keeps the same face on its left: clockwise next to the twin."""
        star: dict[Point, list[Half]] = defaultdict(list)
        for i in sorted(self.live):
            for half in ((i, False), (i, True)):
                star[self.points(half)[0]].append(half)
        after: dict[Half, Half] = {}
        for at, out in star.items():
            def direction(half: Half) -> Point:
                to = self.points(half)[1]
                return to[0] - at[0], to[1] - at[1]
            out.sort(key=cmp_to_key(lambda a, b: _by_angle(direction(a), direction(b)) or (a > b) - (a < b)))
            for k, half in enumerate(out):
                after[half[0], not half[1]] = out[k - 1]
        return after

    def walks(self) -> list[list[Half]]:
        after, seen, out = self.followers(), set(), []
        for start in sorted(after):
            if start in seen:
                continue
            walk, half = [], start
            while half not in seen:
                seen.add(half)
                walk.append(half)
                half = after[half]
            out.append(walk)
        return out

    def drop_bridges(self) -> list[list[Half]]:
        """Walks without the edges that have one face on both sides."""
        walks = self.walks()
        face = {half: n for n, walk in enumerate(walks) for half in walk}
        both = {i for i in self.live if face[i, False] == face[i, True]}
        if both:
            self.live -= both
            walks = self.walks()
        return walks

    def rings(self) -> list[list[Half]]:
        """Walks cut wherever they meet a node again."""
        out = []
        for walk in self.drop_bridges():
            path: list[Half] = []
            at: dict[Point, int] = {}
            for half in walk:
                at[self.points(half)[0]] = len(path)
                path.append(half)
                end = self.points(half)[-1]
                if end in at:
                    out.append(path[at[end]:])
                    for gone in path[at[end]:]:
                        at.pop(self.points(gone)[0], None)
                    path = path[:len(path) - len(out[-1])]
        return out

    def ring_points(self, ring: list[Half]) -> tuple[Ring, bool]:
        """The ring as it is given out (see the head of this module), and whether the walk
        runs counter-clockwise.  Both walks along a ring give the same points."""
        if len(ring) == 1:
            line, back = self.lines[ring[0][0]], ring[0][1]
            return line, (_signed(line) >= 0) != back
        flat = [p for half in ring for p in self.points(half)[:-1]]
        first = flat.index(min(flat))
        flat = flat[first:] + flat[:first]
        other = [flat[0], *flat[:0:-1]]
        left = min(flat, other)                      # one of the two, whichever way the walk runs
        positive = _signed([*left, left[0]]) >= 0
        out = left if positive else (other if left is flat else flat)
        return [*out, out[0]], out is flat


def _clean(xs: list[float], ys: list[float]) -> Ring:
    """Points of a line; of a line that is not closed, without points that repeat the one before."""
    pts = list(zip(map(float, xs), map(float, ys)))
    if len(pts) >= 2 and pts[0] == pts[-1]:
        return pts if len(pts) >= 4 else []
    pts = [p for i, p in enumerate(pts) if i == 0 or p != pts[i - 1]]
    return pts if len(pts) >= 2 else []


def faces(lines: list[Ring]) -> list[tuple[Ring, list[Ring]]]:
    """Every polygon that the lines enclose: (shell, holes), the largest shell first."""
    once = {min(tuple(ln), tuple(ln[::-1])): ln for ln in sorted(lines)}
    graph = Lines([once[k] for k in sorted(once)])
    shells, outer = [], []
    for ring in graph.rings():
        points, left = graph.ring_points(ring)
        if len(points) >= 4:
            (shells if left else outer).append((abs(_signed(points)), points))
    shells.sort(key=lambda s: (-s[0], s[1]))
    arrays = [tuple(np.array(ring).T) for _, ring in shells]
    holes: list[list[Ring]] = [[] for _ in shells]
    for area, ring in sorted(outer, key=lambda o: o[1]):
        own = tuple(np.array(ring).T)
        around = [k for k, (a, _) in enumerate(shells) if a > area and _contains(arrays[k], own)]
        if around:
            holes[min(around, key=lambda k: (shells[k][0], shells[k][1]))].append(ring)
    return [(ring, own) for (_, ring), own in zip(shells, holes)]


def largest_face(lines: list[tuple[list[float], list[float]]]) -> tuple[Ring, list[Ring]] | None:
    """O3: the face with the largest shell, or none."""
    found = faces([ln for ln in (_clean(xs, ys) for xs, ys in lines) if ln])
    return found[0] if found else None


def _faces_of(rows: pa.Array) -> pa.Array:
    """Arrow UDF: lists of lines -> rings of the largest face (shell, then holes), null if none."""
    out = []
    for lines in rows.to_pylist():
        face = largest_face([(ln["xs"], ln["ys"]) for ln in lines]) if lines is not None else None
        out.append(None if face is None else [[{"x": x, "y": y} for x, y in ring] for ring in (face[0], *face[1])])
    return pa.array(out, pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))


def polygon_parts(parts) -> Column:
    """V3: the parts of a relation's members -> polygon parts (shell, then its holes), null where no
    ring closes.  Points are not linework; one closed line is a ring as it is, without Python."""
    lines = F.filter(col_of(parts), lambda p: p["t"] != "p")
    one = F.get(lines, 0)["pts"]
    closed = (F.size(lines) == 1) & (F.size(one) >= 4) & (F.get(one, 0) == F.element_at(one, -1))
    open_ = F.when((F.size(lines) > 0) & ~closed, F.transform(lines, lambda p: F.struct(
        F.transform(p["pts"], lambda q: q["x"]).alias("xs"), F.transform(p["pts"], lambda q: q["y"]).alias("ys"))))
    # a call that may give other rows the next time is made once: Spark would push a filter on the result below
    # the projection, and trace every face once for the filter and once for the rows
    rings = F.arrow_udf(_faces_of, "array<array<struct<x:double,y:double>>>").asNondeterministic()(open_)
    made = F.transform(rings, lambda r, i: F.struct(F.when(i == 0, "pl").otherwise("h").alias("t"), r.alias("pts")))
    return F.when(closed, F.array(part("pl", one))).otherwise(made).cast(PARTS_TYPE)


def stitch_rings(resolved: DataFrame) -> DataFrame:
    """``resolved`` members ``(rel_id, pos, parts)`` -> ``(osm_id, class, parts)`` with class ``pl``
    (shell then holes); relations that close no ring vanish."""
    own = resolved.groupBy("rel_id").agg(F.array_sort(F.collect_list(F.struct("pos", "parts"))).alias("ms"))
    return own.select(F.col("rel_id").alias("osm_id"), F.lit("pl").alias("class"),
                      polygon_parts(F.flatten(F.transform("ms", lambda m: m["parts"]))).alias("parts")) \
        .where(F.col("parts").isNotNull())
