"""Geometry as plain Spark columns.

A geometry is a class code plus a list of parts::

    parts array<struct<t string, pts array<struct<x double, y double>>>>

``t`` is ``p`` (point), ``ls`` (line), ``pl`` (polygon shell) or ``h`` (hole
of the shell before it).  Envelope, centroid, WKT and the box-contains test
are higher-order-function expressions over that array, so they run inside
the engine, with no geometry library and no Python.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbis.functions.codec import geojson_parts, type_name, wkt_to_geojson
from orbis.functions.common import col_of, let, memo_expr

PT_TYPE = "struct<x:double,y:double>"
PART_TYPE = f"struct<t:string,pts:array<{PT_TYPE}>>"
PARTS_TYPE = f"array<{PART_TYPE}>"
ENVELOPE_TYPE = "struct<minx:double,miny:double,maxx:double,maxy:double>"

# Geometry class codes (type name → code).
CLASS_CODES = {
    "GeometryCollection": "gc",
    "LineString": "ls",
    "Point": "p",
    "Polygon": "pl",
    "MultiLineString": "ml",
    "MultiPoint": "mp",
    "MultiPolygon": "mg",
    "LinearRing": "lr",
}


def class_code(type_name) -> Column:
    """geometry type name → class code, as a literal map lookup."""
    m = F.create_map(*[F.lit(v) for kv in CLASS_CODES.items() for v in kv])
    return F.try_element_at(m, col_of(type_name))


def point(x, y) -> Column:
    return F.struct(col_of(x).cast("double").alias("x"),
                    col_of(y).cast("double").alias("y"))


def part(t: str, pts) -> Column:
    return F.struct(F.lit(t).alias("t"), col_of(pts).alias("pts"))


def point_parts(x, y) -> Column:
    return F.array(part("p", F.array(point(x, y))))


# ---------------------------------------------------------------- WKT (F2, F8)

def fmt_num(c) -> Column:
    """Shortest text of a double, no trailing ``.0`` and no exponent
    (``12.0`` → ``12``, ``1.0E-4`` → ``0.0001``)."""
    c = col_of(c)
    s = c.cast("string")
    plain = F.when(s.endswith(".0"), F.left(s, F.char_length(s) - 2)).otherwise(s)
    # d.dddE±x: the same digits, with the point moved by x places
    exp = F.regexp_extract(s, r"E(-?[0-9]+)$", 1).try_cast("int")
    sign = F.regexp_extract(s, r"^(-?)", 1)
    digits = F.concat(F.regexp_extract(s, r"^-?([0-9])\.", 1),
                      F.regexp_replace(F.regexp_extract(s, r"\.([0-9]+)E", 1), r"0+$", ""))
    small = F.concat(F.lit("0."), F.call_function("repeat", F.lit("0"), -exp - F.lit(1)), digits)
    padded = F.rpad(digits, F.greatest(exp + F.lit(1), F.char_length(digits)), "0")
    tail = F.substr(padded, exp + F.lit(2))
    large = F.concat(F.left(padded, exp + F.lit(1)), F.when(tail == "", "").otherwise(F.concat(F.lit("."), tail)))
    return F.when(s.contains("E"), F.concat(sign, F.when(exp < 0, small).otherwise(large))).otherwise(plain)


def _coord(p) -> Column:
    return F.concat(fmt_num(p["x"]), F.lit(" "), fmt_num(p["y"]))


def _coords(pts) -> Column:
    return F.concat_ws(", ", F.transform(pts, _coord))


def _ring(pts) -> Column:
    return F.concat(F.lit("("), _coords(pts), F.lit(")"))


def _members_wkt(parts, point_open: str, point_close: str, line: str, polygon: str) -> Column:
    """Parts one after the other; holes stay with the shell before them."""
    def text(pt, i):
        last = F.coalesce(F.get(parts, i + 1)["t"], F.lit("")) != "h"
        before = F.when((i > 0) | (pt["t"] == "h"), ", ").otherwise("")
        ring = F.concat(F.when(pt["t"] == "pl", F.lit(f"{polygon}(")).otherwise(""), _ring(pt["pts"]),
                        F.when(last, ")").otherwise(""))
        return F.concat(before, F.when(pt["t"] == "p", F.concat(F.lit(point_open), _coord(F.get(pt["pts"], 0)), F.lit(point_close)))
                        .when(pt["t"] == "ls", F.concat(F.lit(line), _ring(pt["pts"]))).otherwise(ring))
    return F.array_join(F.transform(parts, text), "")


@memo_expr
def point_wkt(x, y) -> Column:
    """``POINT (x y)``."""
    return F.concat(F.lit("POINT ("), fmt_num(x), F.lit(" "), fmt_num(y), F.lit(")"))


@memo_expr
def wkt(cls, parts) -> Column:
    """F8 write: WKT of a geometry by class code (a polygon is its shell, then its holes); null
    for a class that its parts cannot have."""
    cls, parts = col_of(cls), col_of(parts)
    members = _members_wkt(parts, "POINT (", ")", "LINESTRING ", "POLYGON ")
    bare = _members_wkt(parts, "", "", "", "")

    def multi(name, text):
        return F.concat(F.lit(f"{name} ("), text, F.lit(")"))
    return (F.when(cls.isin("p", "ls", "pl"), members).when(cls == "gc", multi("GEOMETRYCOLLECTION", members))
            .when(cls == "mp", multi("MULTIPOINT", bare)).when(cls == "ml", multi("MULTILINESTRING", bare))
            .when(cls == "mg", multi("MULTIPOLYGON", bare)))


@memo_expr
def wkt_to_parts(text) -> Column:
    """F8 read: WKT → (class, parts).  POINT, LINESTRING and POLYGON have their own
    class; GEOMETRYCOLLECTION and the MULTI forms become a collection of their members, however
    deep these lie (a polygon's holes follow it).  EMPTY has no parts.  Any other text gives a
    null class and null parts."""
    own = F.create_map(*[F.lit(v) for kv in (("Point", "p"), ("LineString", "ls"), ("Polygon", "pl")) for v in kv])

    def read(json):
        cls = F.coalesce(F.try_element_at(own, type_name(text)), F.lit("gc"))
        return F.struct(F.when(json.isNotNull(), cls).alias("class"),
                        F.when(json.isNotNull(), geojson_parts(json)).cast(PARTS_TYPE).alias("parts"))
    return let(wkt_to_geojson(text), read)


@memo_expr
def read_wkt(text) -> Column:
    """F5 + F8 in one pass over a WKT text: ``struct<class, geojson, parts>`` with the class code of
    its own type; all null if it is no geometry."""
    def read(json):
        return F.struct(F.when(json.isNotNull(), class_code(type_name(text))).alias("class"), json.alias("geojson"),
                        F.when(json.isNotNull(), geojson_parts(json)).cast(PARTS_TYPE).alias("parts"))
    return let(wkt_to_geojson(text), read)


def wkt_class(text) -> Column:
    """the class code of a WKT text's type (the MULTI forms have codes of their own)."""
    return F.when(wkt_to_geojson(text).isNotNull(), class_code(type_name(text)))


# ---------------------------------------------------------- shape tests

def is_closed(pts) -> Column:
    """first point equals last point."""
    pts = col_of(pts)
    a, b = F.get(pts, 0), F.element_at(pts, -1)
    return (a["x"] == b["x"]) & (a["y"] == b["y"])


@memo_expr
def way_class(pts) -> Column:
    """closed with 4+ points → polygon, open with 2+ → line, else null
    (the way cannot be built and is dropped, P9)."""
    pts = col_of(pts)
    n = F.size(pts)
    closed = is_closed(pts)
    return F.when(closed & (n >= 4), F.lit("pl")).when(~closed & (n >= 2), F.lit("ls"))


# ---------------------------------------------------------------- envelope

@memo_expr
def envelope(parts) -> Column:
    """bounding box ``struct<minx,miny,maxx,maxy>``; null when empty."""
    def box(allp):
        xs = F.transform(allp, lambda q: q["x"])
        ys = F.transform(allp, lambda q: q["y"])
        return F.when(F.size(allp) > 0, F.struct(
            F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"),
            F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy")))
    return let(F.flatten(F.transform(col_of(parts), lambda p: p["pts"])), box)


def envelope_wkt(env) -> Column:
    """Envelope as WKT: a point for a point box, else the box polygon."""
    e = col_of(env)
    x0, y0, x1, y1 = e["minx"], e["miny"], e["maxx"], e["maxy"]

    def c(x, y):
        return F.concat(fmt_num(x), F.lit(" "), fmt_num(y))
    poly = F.concat(F.lit("POLYGON (("), F.concat_ws(", ", c(x0, y0), c(x0, y1), c(x1, y1),
                                                       c(x1, y0), c(x0, y0)), F.lit("))"))
    return F.when((x0 == x1) & (y0 == y1), F.concat(F.lit("POINT ("), c(x0, y0), F.lit(")"))) \
            .otherwise(poly)


# ---------------------------------------------------------------- centroid

_SUM_FIELDS = ("a", "cx", "cy", "len", "lx", "ly", "pn", "px", "py")


def _zero_sums() -> Column:
    return F.struct(*[F.lit(0.0).alias(n) for n in _SUM_FIELDS])


def _segments(pts: Column) -> Column:
    n = F.greatest(F.size(pts) - 1, F.lit(0))
    return F.zip_with(F.slice(pts, 1, n), F.slice(pts, 2, n),
                      lambda p, q: F.struct(p.alias("p"), q.alias("q")))


def _segment_sums(pts) -> Column:
    """Area, line sums of one part's segments (JTS-style centroid terms:
    triangle fan from the first point, length-weighted segment midpoints)."""
    b = F.get(pts, 0)

    # area and length of a segment are made once and read by all sums
    def terms(p, q):
        a2 = (p["x"] - b["x"]) * (q["y"] - b["y"]) - (q["x"] - b["x"]) * (p["y"] - b["y"])
        dx, dy = q["x"] - p["x"], q["y"] - p["y"]
        return F.struct(a2.alias("a"), F.sqrt(dx * dx + dy * dy).alias("len"),
                        (b["x"] + p["x"] + q["x"]).alias("fx"), (b["y"] + p["y"] + q["y"]).alias("fy"),
                        (p["x"] + q["x"]).alias("sx"), (p["y"] + q["y"]).alias("sy"))

    def step(acc, s):
        return F.struct(
            (acc["a"] + s["a"]).alias("a"),
            (acc["cx"] + s["a"] * s["fx"]).alias("cx"),
            (acc["cy"] + s["a"] * s["fy"]).alias("cy"),
            (acc["len"] + s["len"]).alias("len"),
            (acc["lx"] + s["len"] * s["sx"] / 2).alias("lx"),
            (acc["ly"] + s["len"] * s["sy"] / 2).alias("ly"))

    n = F.greatest(F.size(pts) - 1, F.lit(0))
    zero = F.struct(*[F.lit(0.0).alias(n) for n in ("a", "cx", "cy", "len", "lx", "ly")])
    return F.aggregate(F.zip_with(F.slice(pts, 1, n), F.slice(pts, 2, n), terms), zero, step)


def _normalised(e) -> Column:
    """Per-part sums with the area sign fixed: shells count positive, holes
    negative, whatever the ring direction; a point (or a line of length 0)
    contributes its first point."""
    s, t, b = e["s"], e["t"], e["b"]
    sign = (F.when(t == "pl", F.signum(s["a"])).when(t == "h", -F.signum(s["a"]))
            .otherwise(F.lit(0.0)))
    is_pt = (t == "p") | (s["len"] == 0)
    return F.struct(
        (sign * s["a"]).alias("a"), (sign * s["cx"]).alias("cx"), (sign * s["cy"]).alias("cy"),
        s["len"].alias("len"), s["lx"].alias("lx"), s["ly"].alias("ly"),
        F.when(is_pt, 1.0).otherwise(0.0).alias("pn"),
        F.when(is_pt, b["x"]).otherwise(0.0).alias("px"),
        F.when(is_pt, b["y"]).otherwise(0.0).alias("py"))


def _add(acc, s):
    return F.struct(*[(acc[n] + s[n]).alias(n) for n in _SUM_FIELDS])


def centroid_sums(parts) -> Column:
    """Summed centroid terms of a geometry ``struct<a,cx,cy,len,lx,ly,pn,px,py>``
    (each part's segment pass runs once)."""
    raw = F.transform(col_of(parts), lambda p: F.struct(
        p["t"].alias("t"), F.get(p["pts"], 0).alias("b"), _segment_sums(p["pts"]).alias("s")))
    return F.aggregate(F.transform(raw, _normalised), _zero_sums(), _add)


def centroid_of_sums(sums) -> Column:
    """F6 from summed terms: area-weighted if there is area, else
    length-weighted, else the mean of the points -- so a collection uses only
    its highest dimension.  Null for an empty geometry."""
    s = col_of(sums)
    x = (F.when(F.abs(s["a"]) > 0, s["cx"] / F.lit(3.0) / s["a"])
         .when(s["len"] > 0, s["lx"] / s["len"])
         .when(s["pn"] > 0, s["px"] / s["pn"]))
    y = (F.when(F.abs(s["a"]) > 0, s["cy"] / F.lit(3.0) / s["a"])
         .when(s["len"] > 0, s["ly"] / s["len"])
         .when(s["pn"] > 0, s["py"] / s["pn"]))
    return F.when(x.isNotNull(), F.struct(x.alias("x"), y.alias("y")))


@memo_expr
def centroid(parts) -> Column:
    """centroid of a geometry (its sums are bound once with ``let``)."""
    return let(centroid_sums(parts), centroid_of_sums)


def with_centroid(df: DataFrame, parts: str = "parts", out: str = "centroid") -> DataFrame:
    return df.withColumn(out, centroid(parts))


# ------------------------------------------------------- box contains

@memo_expr
def inner_sides(env, parts) -> Column:
    """What ``box_contains`` needs to know of a geometry whose envelope lies in the box: for each point and segment, on
    which sides of the envelope it lies (1 west, 2 east, 4 south, 8 north, added up; 0 for a polygon), as
    a set of these numbers in the bits of an int."""
    e = col_of(env)
    sides = (("x", "minx", 1), ("x", "maxx", 2), ("y", "miny", 4), ("y", "maxy", 8))

    def number(*ends):                      # an end that is not known may lie on a side
        on = lambda a, v: F.coalesce(functools.reduce(Column.__and__, [p[a] == e[v] for p in ends]), F.lit(True))
        known = lambda a: functools.reduce(Column.__or__, [p[a].isNotNull() for p in ends])
        n = functools.reduce(Column.__add__, [F.when(on(a, v), bit).otherwise(0) for a, v, bit in sides])
        return F.when(known("x") & known("y"), n)

    def of_part(pt):
        point = F.get(pt["pts"], 0)
        return (F.when(pt["t"] == "p", F.array(number(point)))
                .when(pt["t"] == "ls", F.transform(_segments(pt["pts"]), lambda s: number(s["p"], s["q"])))
                .when(pt["t"] == "pl", F.array(F.lit(0))).otherwise(F.array().cast("array<int>")))
    return F.aggregate(F.flatten(F.transform(col_of(parts), of_part)), F.lit(0), lambda acc, n: F.when(
        n.isNull(), acc).otherwise(acc.bitwiseOR(F.call_function("shiftleft", F.lit(1), n))))


def box_contains_sides(box, env: dict[str, Column], sides) -> Column:
    """F13 from the ``inner_sides`` of a geometry whose envelope (columns by name) lies in the closed box: some
    point or segment lies on none of the sides that envelope and box share."""
    b = col_of(box)
    shared = [(env["minx"] <= b["minx"], 1), (env["maxx"] >= b["maxx"], 2), (env["miny"] <= b["miny"], 4), (env["maxy"] >= b["maxy"], 8)]
    touched = functools.reduce(Column.__add__, [F.when(c, bit).otherwise(0) for c, bit in shared])
    free = F.array(*[F.lit(sum(1 << n for n in range(16) if not n & t)) for t in range(16)])
    return col_of(sides).bitwiseAND(F.get(free, touched)) != 0


@memo_expr
def box_contains(box, env, parts) -> Column:
    """the closed, axis-aligned ``box`` contains the geometry.

    The geometry's envelope lies inside the closed box, and some interior
    point of the geometry lies in the open box: a point strictly inside; a
    line with a segment not lying on one box edge; a polygon always (its
    interior is open); a collection when any member does."""
    b, e = col_of(box), col_of(env)
    x0, y0, x1, y1 = b["minx"], b["miny"], b["maxx"], b["maxy"]
    inside = (e["minx"] >= x0) & (e["maxx"] <= x1) & (e["miny"] >= y0) & (e["maxy"] <= y1)

    def on_edge(s):
        p, q = s["p"], s["q"]
        return (((p["x"] == x0) & (q["x"] == x0)) | ((p["x"] == x1) & (q["x"] == x1))
                | ((p["y"] == y0) & (q["y"] == y0)) | ((p["y"] == y1) & (q["y"] == y1)))

    def interior(pt):
        p0 = F.get(pt["pts"], 0)
        strict = (p0["x"] > x0) & (p0["x"] < x1) & (p0["y"] > y0) & (p0["y"] < y1)
        return (F.when(pt["t"] == "p", strict)
                .when(pt["t"] == "ls", F.exists(_segments(pt["pts"]), lambda s: ~on_edge(s)))
                .when(pt["t"] == "pl", F.lit(True))
                .otherwise(F.lit(False)))

    return e.isNotNull() & inside & F.exists(col_of(parts), interior)
