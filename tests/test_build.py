"""Ingestion rules (FIXTURES.md §3 geometry cases, Q6, Q9, Q19, Q22)."""

import pytest
from pyspark.sql import functions as F

from orbis.operators import build as B

TAGS = "array<struct<key:string,value:string>>"


@pytest.fixture(scope="module")
def raw(spark):
    nodes = spark.createDataFrame([
        (1, 0.0, 0.0, [("amenity", "x")]), (2, 1.0, 0.0, []), (3, 1.0, 1.0, []),
        (4, 0.0, 1.0, []), (5, 9.0, 9.0, [("shop", "y")]), (6, 2.0, 2.0, []),
    ], f"id long, longitude double, latitude double, tags {TAGS}")
    refs = spark.createDataFrame([
        # way 10: closed square, 5 refs → polygon
        (10, 0, 1), (10, 1, 2), (10, 2, 3), (10, 3, 4), (10, 4, 1),
        # way 11: closed with 3 refs → dropped
        (11, 0, 1), (11, 1, 2), (11, 2, 1),
        # way 12: open line, node 99 missing → skipped, still a line
        (12, 0, 1), (12, 1, 99), (12, 2, 6),
        # way 13: one point → dropped
        (13, 0, 5),
        # way 5: a line, same number as node 5 (Q6)
        (5, 0, 2), (5, 1, 3),
    ], "way_id long, idx int, node_id long")
    way_tags = spark.createDataFrame([(10, [("building", "yes")]), (12, [("highway", "r")])],
                                     f"id long, tags {TAGS}")
    members = spark.createDataFrame([
        (100, 0, 5, "Way", "outer"), (100, 1, 5, "Node", "label"), (100, 2, 7, "Relation", ""),
        (101, 0, 10, "Way", "outer"),
        (102, 0, 12, "Way", ""),
    ], "rel_id long, pos long, member_id long, member_type string, role string")
    rel_tags = spark.createDataFrame([
        (100, [("type", "route")]), (101, [("type", "restriction")]), (102, [("name", "n")]),
    ], f"id long, tags {TAGS}")
    return nodes, refs, way_tags, members, rel_tags


def test_nodes_only_tagged_q19(raw):
    nodes = B.build_nodes(raw[0]).collect()
    assert sorted(r.id for r in nodes) == ["n1", "n5"]
    n1 = [r for r in nodes if r.id == "n1"][0]
    assert n1.wkt == "POINT (0 0)" and (n1.centroid.x, n1.centroid.y) == (0.0, 0.0)  # Q22
    assert n1.cover.L == 12 and n1.cover.c0 == n1.cover.c1 and n1.cover.r0 == n1.cover.r1


def test_way_classes(raw):
    nodes, refs, way_tags = raw[0], raw[1], raw[2]
    ways = {r.id: r for r in B.build_ways(refs, way_tags, nodes).collect()}
    assert sorted(ways) == ["w10", "w12", "w5"]
    assert ways["w10"]["class"] == "pl" and ways["w10"].tags == {"building": "yes"}
    assert ways["w10"].wkt == "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"
    assert (ways["w10"].centroid.x, ways["w10"].centroid.y) == pytest.approx((0.5, 0.5))
    assert ways["w12"].wkt == "LINESTRING (0 0, 2 2)"      # missing node skipped
    assert ways["w5"].tags == {}


def test_relations_typed_members_q6(raw):
    nodes, refs, way_tags, members, rel_tags = raw
    ways = B.build_ways(refs, way_tags, nodes)
    rels = {r.id: r for r in B.build_relations(members, rel_tags, nodes, ways).collect()}
    # 101 restriction dropped, 102 has no type ("unknown") dropped
    assert sorted(rels) == ["r100"]
    r = rels["r100"]
    # member way 5 is the line 2-3, member node 5 the point (9, 9); relation member ignored
    assert r.wkt == "GEOMETRYCOLLECTION (LINESTRING (1 0, 1 1), POINT (9 9))"
    assert r["class"] == "gc"
    # collection centroid uses its highest dimension: the line
    assert (r.centroid.x, r.centroid.y) == pytest.approx((1.0, 0.5))


def test_empty_collection_dropped_q9(spark, raw):
    nodes, refs, way_tags, _, _ = raw
    ways = B.build_ways(refs, way_tags, nodes)
    members = spark.createDataFrame([(200, 0, 999, "Way", "")],
                                    "rel_id long, pos long, member_id long, member_type string, role string")
    tags = spark.createDataFrame([(200, [("type", "site")])], f"id long, tags {TAGS}")
    assert B.build_relations(members, tags, nodes, ways).count() == 0


def test_index_and_grouped_index(raw):
    nodes, refs, way_tags = raw[0], raw[1], raw[2]
    g = B.build_nodes(nodes).unionByName(
        B.build_ways(refs, way_tags, nodes).select(*B.GEOMETRY_COLUMNS))
    flat = B.build_index(g)
    ids = {r.id for r in flat.collect()}
    assert "n2" not in ids and {"n1", "n5", "w10", "w12", "w5"} <= ids
    grouped = B.group_index(flat, chunks=4)
    back = grouped.select("cell", F.explode("ids").alias("id"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, flat.select("cell", "id").collect()))
    # (cell, chunk) is the key, whatever the size
    assert grouped.select("cell", "chunk").distinct().count() == grouped.count()
    assert grouped.where("chunk NOT BETWEEN 0 AND 3").count() == 0
