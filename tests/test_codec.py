"""WKT and GeoJSON texts: all types, nested, both ways."""

import json

import pytest
from pyspark.sql import functions as F

from orbis.functions import codec as C
from orbis.functions import geometry as GM

RING, HOLE = [[0, 0], [4, 0], [4, 4], [0, 0]], [[1, 1], [2, 1], [2, 2], [1, 1]]
PAIRS = [
    ("POINT (1 2)", {"type": "Point", "coordinates": [1, 2]}),
    ("POINT (-1.5 2.25E-7)", {"type": "Point", "coordinates": [-1.5, 2.25e-7]}),
    ("POINT (1 2 3)", {"type": "Point", "coordinates": [1, 2, 3]}),
    ("LINESTRING (0 0, 1 1)", {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}),
    ("POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))", {"type": "Polygon", "coordinates": [RING, HOLE]}),
    ("MULTIPOINT (1 2, 3 4)", {"type": "MultiPoint", "coordinates": [[1, 2], [3, 4]]}),
    ("MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))",
     {"type": "MultiLineString", "coordinates": [[[0, 0], [1, 1]], [[2, 2], [3, 3]]]}),
    ("MULTIPOLYGON (((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1)), ((0 0, 4 0, 4 4, 0 0)))",
     {"type": "MultiPolygon", "coordinates": [[RING, HOLE], [RING]]}),
    ("GEOMETRYCOLLECTION (MULTIPOINT (1 2, 3 4), GEOMETRYCOLLECTION (POINT (5 6), GEOMETRYCOLLECTION (LINESTRING (0 0, 1 1)), "
     "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 0)))), POINT EMPTY)",
     {"type": "GeometryCollection", "geometries": [
         {"type": "MultiPoint", "coordinates": [[1, 2], [3, 4]]},
         {"type": "GeometryCollection", "geometries": [
             {"type": "Point", "coordinates": [5, 6]},
             {"type": "GeometryCollection", "geometries": [{"type": "LineString", "coordinates": [[0, 0], [1, 1]]}]},
             {"type": "MultiPolygon", "coordinates": [[RING]]}]},
         {"type": "Point", "coordinates": []}]}),
    ("POINT EMPTY", {"type": "Point", "coordinates": []}),
    ("MULTIPOLYGON EMPTY", {"type": "MultiPolygon", "coordinates": []}),
    ("GEOMETRYCOLLECTION EMPTY", {"type": "GeometryCollection", "geometries": []}),
    ("SRID=4326;POINT (1 2)", {"type": "Point", "coordinates": [1, 2], "crs": {
        "type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::4326"}}}),
]


@pytest.fixture(scope="module")
def one(spark):
    def run(fn, values):
        df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
        return [r.o for r in df.select("i", fn("v").alias("o")).orderBy("i").collect()]
    return run


def test_wkt_to_geojson(one):
    got = one(C.wkt_to_geojson, [w for w, _ in PAIRS])
    assert [json.loads(x) for x in got] == [j for _, j in PAIRS]


def test_geojson_to_wkt(one):
    assert one(C.geojson_to_wkt, [json.dumps(j) for _, j in PAIRS]) == [w for w, _ in PAIRS]
    turned = [json.dumps(j, sort_keys=True, indent=2) for _, j in PAIRS]          # coordinates before type
    assert one(C.geojson_to_wkt, turned) == [w for w, _ in PAIRS]
    features = [json.dumps({"type": "Feature", "properties": {"id": 1}, "geometry": j}) for _, j in PAIRS[:8]]
    assert one(C.geojson_to_wkt, features) == [w for w, _ in PAIRS[:8]]


def test_other_spellings(one):
    texts = {"point(1 2)": [1, 2], "  Point  Z ( 1   2  3 ) ": [1, 2, 3], "POINT (+1 .5)": [1, 0.5],
             "POINT (-.5 1.)": [-0.5, 1.0], "POINT (007 1e3)": [7, 1000.0],
             "MULTIPOINT ((1 2), (3 4))": [[1, 2], [3, 4]], "multipoint((1 2),(3 4))": [[1, 2], [3, 4]],
             "LINESTRING(0 0,1 1)": [[0, 0], [1, 1]], "srid = 25832 ; POINT (1 2)": [1, 2]}
    got = one(C.wkt_to_geojson, list(texts))
    assert [json.loads(x)["coordinates"] for x in got] == list(texts.values())


def test_no_geometries(one):
    bad = ["", "CIRCLE (1 2)", "POINT (abc 1)", "POINT 1 2", "POINT (1 2", "POINT (1 2))", "POINT ()", "POINT (1)",
           "LINESTRING (0 0, (1 1))", "POLYGON (0 0, 1 1)", "MULTIPOLYGON ((0 0, 1 1))", "LINESTRING (0 0,, 1 1)",
           "GEOMETRYCOLLECTION (POINT (1 2), 3 4)", "GEOMETRYCOLLECTION ()", "POINT (1 2) POINT (3 4)",
           "XPOINT (1 2)", "POINT (1 2x)", None]
    assert one(C.wkt_to_geojson, bad) == [None] * len(bad)
    assert one(lambda v: GM.wkt_to_parts(v)["class"], bad) == [None] * len(bad)
    json_bad = ["", "{", '{"type":"Point"}', '{"type":"Circle","coordinates":[1,2]}', '{"type":"Point","coordinates":[[1,2]]}',
                '{"type":"Polygon","coordinates":[1,2]}', '{"type":"Point","coordinates":["a",2]}', "[1,2]", None]
    assert one(C.geojson_to_wkt, json_bad) == [None] * len(json_bad)


def test_parts_of_nested_collections(spark):
    text = "GEOMETRYCOLLECTION (MULTIPOINT (1 2, 3 4), GEOMETRYCOLLECTION (MULTIPOLYGON (((0 0, 4 0, 4 4, 0 0), " \
           "(1 1, 2 1, 2 2, 1 1)), ((8 8, 9 8, 9 9, 8 8))), LINESTRING (0 0, 1 1)))"
    r = spark.range(1).select(GM.wkt_to_parts(F.lit(text)).alias("p")).first().p
    assert r["class"] == "gc" and [p.t for p in r.parts] == ["p", "p", "pl", "h", "pl", "ls"]
    assert [(p.x, p.y) for p in r.parts[4].pts] == [(8, 8), (9, 8), (9, 9), (8, 8)]


def test_classes_and_writing(one, spark):
    flat = [w for w, _ in PAIRS if "EMPTY" not in w and "COLLECTION" not in w and "SRID" not in w and "2 3)" not in w
            and "E-7" not in w]
    codes = one(GM.wkt_class, flat)
    assert codes == ["p", "ls", "pl", "mp", "ml", "mg"]
    df = spark.createDataFrame(list(zip(codes, flat)), "c string, v string")
    back = df.select("v", GM.wkt("c", GM.wkt_to_parts("v")["parts"]).alias("w")).collect()
    assert all(r.v == r.w for r in back)
    empty = spark.range(1).select(GM.wkt_to_parts(F.lit("POINT EMPTY")).alias("p")).first().p
    assert (empty["class"], empty.parts) == ("p", [])


def test_long_texts(one):
    points = ", ".join(f"{i} {i + 1}" for i in range(20_000))
    deep = "GEOMETRYCOLLECTION (" * 30 + "POINT (1 2)" + ")" * 30
    got = one(C.wkt_to_geojson, [f"LINESTRING ({points})", f"MULTIPOINT ({points})", deep])
    assert len(json.loads(got[0])["coordinates"]) == 20_000 and got[2].count("Collection") == 30
    assert one(C.geojson_to_wkt, got) == [f"LINESTRING ({points})", f"MULTIPOINT ({points})", deep]
