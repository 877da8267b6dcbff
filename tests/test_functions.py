"""Column functions against known values."""

import math

import pytest
from pyspark.sql import functions as F

from orbis.functions import geohash as GH
from orbis.functions import geometry as GM
from orbis.functions import measure as M
from orbis.functions import parse as P


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_geohash_published_value(spark):
    r = one(spark, GH.geohash(F.lit(10.40744), F.lit(57.64911)).alias("g"))
    assert r.g.startswith("u4pruydqqvj")
    assert len(r.g) == 12


def test_geohash_edges_clamp(spark):
    r = one(spark, GH.geohash(F.lit(180.0), F.lit(90.0)).alias("a"),
            GH.geohash(F.lit(-180.0), F.lit(-90.0)).alias("b"),
            GH.geohash(F.lit(12.0), F.lit(45.0), 5).alias("c"))
    assert r.a == "zzzzzzzzzzzz"
    assert r.b == "000000000000"
    assert len(r.c) == 5


def _box(x0, y0, x1, y1):
    return F.struct(F.lit(x0).alias("minx"), F.lit(y0).alias("miny"),
                    F.lit(x1).alias("maxx"), F.lit(y1).alias("maxy"))


def test_cover_lengths_from_survey(spark):
    r = one(spark, GH.cover(_box(8.61, 45.44, 8.611, 45.441)).alias("a"),
            GH.cover(_box(8.3, 45.2, 8.9, 45.7)).alias("b"))
    assert len(r.a) == 1 and len(r.a[0]) == 6
    assert sorted(r.b) == ["u0j", "u0n"]


def test_cover_contains_point_cells(spark):
    # every point inside a box has its cell under one of the box's cells
    pts = spark.range(200).select(
        (F.lit(8.0) + F.rand(1) * 2).alias("x"), (F.lit(45.0) + F.rand(2) * 1.5).alias("y"))
    cov = one(spark, GH.cover(_box(8.0, 45.0, 10.0, 46.5)).alias("c")).c
    cells = [r.g for r in pts.select(GH.geohash("x", "y").alias("g")).collect()]
    assert all(any(c.startswith(q) for q in cov) for c in cells)
    assert len(set(cov)) == len(cov)          # A10: no duplicate cells


@pytest.mark.parametrize("text,dbl,integer", [
    ("359,314", 359.314, 0), (":", 0.0, 0), ("", 0.0, 0), ("1 234,5", 0.0, 0),
    ("2010", 2010.0, 2010), ("abc", 0.0, 0), (None, 0.0, 0)])
def test_number_parsing_q24(spark, text, dbl, integer):
    df = spark.createDataFrame([(text,)], "s string")
    r = df.select(P.to_double("s").alias("d"), P.to_int("s").alias("i")).first()
    assert r.d == pytest.approx(dbl) and r.i == integer


def test_distance_and_clamp_q10(spark):
    r = one(spark, M.distance_km(F.lit(8.6196550), F.lit(45.4464036), F.lit(9.1905),
                                 F.lit(45.4668)).alias("d"),
            M.distance_km(F.lit(7.0), F.lit(45.0), F.lit(7.0), F.lit(45.0)).alias("z"))
    assert r.d == pytest.approx(44.6, abs=0.2)
    assert r.z == 0.0 and not math.isnan(r.z)


def test_buffer_box_q23(spark):
    r = one(spark, M.buffer_box(F.lit(10.0), F.lit(45.0), F.lit(1000)).alias("b"),
            M.buffer_box(F.lit(10.0), F.lit(90.0), F.lit(1000)).alias("p"))
    dy = 1000 / 6378137 * 180 / math.pi
    assert r.b.maxy - 45.0 == pytest.approx(dy)
    assert r.b.maxx - 10.0 == pytest.approx(dy / math.cos(math.radians(45.0)))
    assert math.isfinite(r.p.maxx)            # no blow-up at the pole


def test_wkt_and_number_text(spark):
    r = one(spark, GM.point_wkt(F.lit(12.0), F.lit(0.0001)).alias("w"))
    assert r.w == "POINT (12 0.0001)"


def test_relation_type_f17(spark):
    df = spark.createDataFrame([([("type", "route"), ("name", "x")],), ([("name", "y")],)],
                               "tags array<struct<key:string,value:string>>")
    got = [r.t for r in df.select(P.relation_type("tags").alias("t")).collect()]
    assert got == ["route", "unknown"]


def test_region_from_url_f21(spark):
    df = spark.createDataFrame(
        [("https://download.example/europe/italy/nord-ovest-latest.osm.pbf",)], "u string")
    r = df.select(P.region_from_url("u").alias("r"), P.url_parent("u").alias("p")).first()
    assert r.r == "nord-ovest"
    assert r.p == "https://download.example/europe/italy/"


def test_class_codes_f5(spark):
    r = one(spark, GM.class_code(F.lit("MultiPolygon")).alias("c"))
    assert r.c == "mg"


def _parts(spark, t, pts):
    df = spark.createDataFrame([(t, pts)], "t string, pts array<struct<x:double,y:double>>")
    return df.select(F.array(F.struct("t", "pts")).alias("parts"))


def test_centroid_polygon_line_point(spark):
    sq = _parts(spark, "pl", [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)])
    c = sq.select(GM.centroid("parts").alias("c")).first().c
    assert (c.x, c.y) == pytest.approx((1.0, 1.0))
    ln = _parts(spark, "ls", [(0.0, 0.0), (4.0, 0.0), (4.0, 2.0)])
    c = ln.select(GM.centroid("parts").alias("c")).first().c
    assert (c.x, c.y) == pytest.approx((8.0 / 3.0, 1.0 / 3.0))   # length-weighted midpoints
    pt = _parts(spark, "p", [(5.0, 6.0)])
    c = pt.select(GM.centroid("parts").alias("c")).first().c      # Q22
    assert (c.x, c.y) == (5.0, 6.0)


def test_box_contains_boundary_rule(spark):
    box = _box(0.0, 0.0, 10.0, 10.0)
    on_edge = _parts(spark, "ls", [(0.0, 2.0), (0.0, 8.0)])
    across = _parts(spark, "ls", [(0.0, 2.0), (5.0, 8.0)])
    pt_edge = _parts(spark, "p", [(10.0, 5.0)])
    out = _parts(spark, "pl", [(1.0, 1.0), (11.0, 1.0), (5.0, 5.0), (1.0, 1.0)])

    def test(df):
        return df.select(GM.box_contains(box, GM.envelope("parts"), "parts").alias("c")).first().c
    assert test(on_edge) is False
    assert test(across) is True
    assert test(pt_edge) is False
    assert test(out) is False


def test_wkt_read_roundtrip(spark):
    df = spark.createDataFrame([("POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))",),
                                ("LINESTRING (1 2, 3 4.5)",), ("POINT (7.5 8)",)], "w string")
    got = df.select(GM.wkt_to_parts("w").alias("g")).select(
        GM.wkt("g.class", "g.parts").alias("w2"), "g.class").collect()
    assert [r.w2 for r in got] == [r.w for r in df.collect()]
    assert [r["class"] for r in got] == ["pl", "ls", "p"]
