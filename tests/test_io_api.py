"""Readers, lookups and sinks not reached by the registered queries
(S2, S3, S6, S8, S9, F7 text, K1–K3, K5, K7)."""

import glob
import json
import tempfile

import pytest
from pyspark.sql import functions as F

from orbis.functions import geometry as GM
from orbis.operators import build as B
from orbis.operators import lookup as LK
from orbis.operators import statistics as ST
from orbis.sinks import export as EX
from orbis.sinks import tables as K
from orbis.sources import osm
from orbis.sources import stats as SS

TAGS = "array<struct<key:string,value:string>>"


def test_way_and_relation_readers(spark):
    base = tempfile.mkdtemp(prefix="orbis-raw-")
    ways = spark.createDataFrame(
        [(7, [(1, 10), (0, 11)], [("highway", "r")], 3)],
        f"id long, nodes array<struct<index:int,nodeId:long>>, tags {TAGS}, version int")
    rels = spark.createDataFrame(
        [(9, [(7, "outer", "Way"), (1, "", "Relation")], [("type", "route")])],
        f"id long, members array<struct<id:long,role:string,type:string>>, tags {TAGS}")
    ways.write.parquet(f"{base}/w.parquet")
    rels.write.parquet(f"{base}/r.parquet")
    w = osm.read_ways(spark, f"{base}/w.parquet")
    assert w.columns == ["id", "nodes", "tags"]            # extra columns never read
    refs = sorted(map(tuple, osm.way_refs(w).collect()))
    assert refs == [(7, 0, 11), (7, 1, 10)]
    m = osm.relation_members(osm.read_relations(spark, f"{base}/r.parquet")).collect()
    assert [(r.pos, r.member_id, r.member_type) for r in m] == [(0, 7, "Way"), (1, 1, "Relation")]
    assert osm.relation_tags(osm.read_relations(spark, f"{base}/r.parquet")).count() == 1


def test_names_reader_and_prefix(spark):
    base = tempfile.mkdtemp(prefix="orbis-names-")
    with open(f"{base}/name_to_id.csv", "w") as f:
        f.write("id,name\n3,Lund\n,Nowhere\n")
    names = ST.build_names(SS.read_names(spark, base)).collect()
    assert [(r.id, r.name) for r in names] == [("r3", "Lund")]


@pytest.fixture(scope="module")
def geoms(spark):
    raw = spark.createDataFrame([(1, 1.0, 2.0, [("amenity", "cafe")]),
                                 (2, 3.0, 4.0, [("amenity", "bar")])],
                                f"id long, longitude double, latitude double, tags {TAGS}")
    return B.build_nodes(raw)


def test_keyed_lookups(spark, geoms):
    assert [r.id for r in LK.get_geometries(geoms, ["n2", "n9"]).collect()] == ["n2"]
    ids = spark.createDataFrame([("n1",), ("n2",)], "id string")
    got = LK.get_filtered(geoms, ids, F.col("tags")["amenity"] == "cafe").collect()
    assert [r.id for r in got] == ["n1"]                    # Q18: filtered ids vanish


def test_geometry_sinks_roundtrip(spark, geoms):
    base = tempfile.mkdtemp(prefix="orbis-geo-")
    K.write_geometries(geoms, f"{base}/all")
    back = spark.read.parquet(f"{base}/all")
    assert back.where("kind = 'n'").count() == 2
    K.write_kind(geoms, f"{base}/bykind", "n")
    assert spark.read.parquet(f"{base}/bykind").select("kind").distinct().first().kind == "n"
    K.write_stats(spark.createDataFrame([("r1", 1.0)], "id string, value double"), f"{base}/s")
    assert spark.read.parquet(f"{base}/s").count() == 1


def test_envelope_text(spark):
    box = F.struct(F.lit(0.0).alias("minx"), F.lit(1.0).alias("miny"),
                   F.lit(2.0).alias("maxx"), F.lit(3.0).alias("maxy"))
    pt = F.struct(F.lit(5.0).alias("minx"), F.lit(6.0).alias("miny"),
                  F.lit(5.0).alias("maxx"), F.lit(6.0).alias("maxy"))
    r = spark.range(1).select(GM.envelope_wkt(box).alias("b"), GM.envelope_wkt(pt).alias("p")).first()
    assert r.b == "POLYGON ((0 1, 0 3, 2 3, 2 1, 0 1))"
    assert r.p == "POINT (5 6)"


def test_json_exports(spark):
    res = spark.createDataFrame([("r1", "Sevilla", 2010, 704.198)],
                                "city_id string, city string, year int, value double")
    line = json.loads(EX.stat_from_all_json(res, "pop", ">", 700.0, 2010).first().json)
    # the pages read the question by position
    assert line == {"_1": {"_1": "pop", "_2": ">", "_3": 700.0, "_4": 2010}, "_2": {"Sevilla": 704.198}}
    cmp = spark.createDataFrame([("Lund", [118.542, 0.0], "POINT (1 2)")],
                                "city string, values array<double>, wkt string")
    assert json.loads(EX.compare_json(cmp).first().json) == \
        {"Lund": {"_1": [118.542, 0.0], "_2": "POINT (1 2)"}}
    base = tempfile.mkdtemp(prefix="orbis-json-")
    EX.write_lines(EX.compare_json(cmp), f"{base}/out")
    assert spark.read.text(f"{base}/out").count() == 1


def joined(path):
    """Part files joined in name order, as a consumer would."""
    return "".join(open(f).read() for f in sorted(glob.glob(f"{path}/part-*")))


def test_one_document(spark):
    base = tempfile.mkdtemp(prefix="orbis-doc-")
    cities = {f"City {i:03d}": i / 10 for i in range(500)} | {'Quote " and \\': 1.5, "Köln": 2.0}
    res = spark.createDataFrame([(str(i), c, 2010, v) for i, (c, v) in enumerate(cities.items())],
                                "city_id string, city string, year int, value double").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        EX.write_stat_from_all(res, "pop", ">", 700.0, 2010, f"{base}/e5", f"{base}/e5-staged")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(glob.glob(f"{base}/e5/part-*")) > 1
    assert json.loads(joined(f"{base}/e5")) == {"_1": {"_1": "pop", "_2": ">", "_3": 700.0, "_4": 2010}, "_2": cities}
    one = spark.createDataFrame([(1, 8.5, 45.5, None)] * 3 + [(2, 9.0, 45.0, 3.5)], "id int, x double, y double, v double")
    EX.write_features(EX.point_features(one, "id", "x", "y", "v", True), f"{base}/geo", f"{base}/geo-staged")
    doc = json.loads(joined(f"{base}/geo"))
    assert doc["type"] == "FeatureCollection" and [f["properties"]["id"] for f in doc["features"]] == ["1", "1", "1", "2"]
    EX.write_features(EX.point_features(one.where("id > 9"), "id", "x", "y", "v", True), f"{base}/none", f"{base}/none-staged")
    assert json.loads(joined(f"{base}/none")) == {"type": "FeatureCollection", "features": []}
