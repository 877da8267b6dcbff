"""Steps of the ingest and of keyed lookups that read, shuffle or compute a thing once."""

import pytest
from pyspark.sql import functions as F

from orbis.functions import geohash as GH
from orbis.operators import build as B
from orbis.operators import lookup as LK
from orbis.operators import statistics as ST
from orbis.sources import fixtures as FX
from orbis.sources import osm

TAGS = "array<struct<key:string,value:string>>"


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def lineitems(spark, tmp_path):
    """Ways of one, two and three distinct nodes, repeated and null nodes, a null way."""
    nodes = {0: [5, 3, 4], 1: [1, 2, 3], 3: [7, 7, 8], 6: [None, 2, 9, 4], 9: [None, None], 12: [1, 5, 5, 1, 3],
             15: [None, 4, 6], 18: [2], None: [1, 2, 3]}
    rows = [(k, p, n % 3, n, 1.0) for k, own in nodes.items() for n, p in enumerate(own)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    return nodes, str(tmp_path)


def test_ways_pass_one_shuffle_f11(spark, lineitems):
    nodes, path = lineitems
    refs = FX.way_refs(spark, path)
    got = {(r.way_id, r.idx, r.node_id) for r in refs.collect()}
    want = {(k, n, p) for k, own in nodes.items() for n, p in enumerate(own)}
    want |= {(k, len(own), own[0]) for k, own in nodes.items()
             if k is not None and k % 3 == 0 and len({p for p in own if p is not None}) >= 3}
    assert got == want and refs.count() == len(want) and (0, 3, 5) in got and (15, 3, None) not in got
    raw = spark.range(10).select("id", F.col("id").cast("double").alias("longitude"), F.lit(1.0).alias("latitude"))
    ways = B.assemble_ways(refs, F.broadcast(raw))
    assert executed(ways).count("Exchange hashpartitioning") == 1


def test_few_ids_do_not_shuffle_the_geometries_f9_f10_f17(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(k, f"{k}{i}", f"POINT ({i} 0)") for k in "nr" for i in range(50)], "kind string, id string, wkt string") \
        .write.partitionBy("kind").parquet(f"{tmp_path}/geometries")
    g = spark.read.parquet(f"{tmp_path}/geometries")
    names = spark.createDataFrame([("r7", "A"), ("r7", "A"), ("r9", "B"), (None, "C"), ("r70", "D")], "id string, name string")
    stats = spark.createDataFrame([("r7", "A", "x", 2000, 1.5, "1.5")],
                                  "id string, name string, indicator string, year int, value double, value_raw string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = LK.get_geometries(g, names)
        plan = executed(found)
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
        assert sorted(r.id for r in found.collect()) == ["r7", "r9"]
        rows = ST.multi_compare_stat(stats, "x", ids=names, geometries=g).collect()
        assert sorted((str(r.city_id), r.wkt, len(r["values"])) for r in rows) == [
            ("None", None, 0), ("r7", "POINT (7 0)", 1), ("r7", "POINT (7 0)", 1), ("r70", None, 0), ("r9", "POINT (9 0)", 0)]
        monkeypatch.setattr(LK, "BROADCAST_IDS", 1)
        many = LK.get_geometries(g, names)
        assert "SortMergeJoin" in executed(many) and sorted(r.id for r in many.collect()) == ["r7", "r9"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert LK.get_geometries(g, names.where("id IS NULL")).count() == 0


def test_faces_are_traced_once_f12(spark):
    nodes = spark.createDataFrame([(i, float(i % 2), float(i // 2), []) for i in range(4)],
                                  f"id long, longitude double, latitude double, tags {TAGS}")
    refs = spark.createDataFrame([(1, 0, 0), (1, 1, 1), (1, 2, 3), (2, 0, 0), (2, 1, 2), (2, 2, 3)], "way_id long, idx int, node_id long")
    ways = B.build_ways(refs, spark.createDataFrame([], f"id long, tags {TAGS}"), nodes)
    members = spark.createDataFrame([(5, 0, 1, "Way", ""), (5, 1, 2, "Way", ""), (6, 0, 1, "Way", "")],
                                    "rel_id long, pos long, member_id long, member_type string, role string")
    tags = spark.createDataFrame([(k, [("type", "multipolygon")]) for k in (5, 6)], f"id long, tags {TAGS}")
    rels = B.build_relations(members, tags, nodes, ways)
    assert executed(rels).count("ArrowEvalPython") == 1
    assert [(r.id, r["class"], len(r.parts[0].pts)) for r in rels.collect()] == [("r5", "pl", 5)]


def test_staged_cover_is_the_cover_f15(spark):
    e = spark.range(300).select((F.rand(4) * 360 - 180).alias("x"), (F.rand(5) * 180 - 90).alias("y"),
                                F.pow(F.lit(10.0), F.rand(6) * 9 - 7).alias("d")) \
        .select(F.when(F.col("d") < 50, F.struct(F.col("x").alias("minx"), F.col("y").alias("miny"), F.least(F.col("x") + F.col("d"), F.lit(180.0))
                                                 .alias("maxx"), F.least(F.col("y") + F.col("d"), F.lit(90.0)).alias("maxy"))).alias("envelope"))
    e = spark.createDataFrame(e.collect(), e.schema)
    rows = GH.with_cover_grid(e, "envelope").withColumn("want", GH.cover_grid_of("envelope"))
    assert rows.columns == ["envelope", "cover", "want"] and rows.where("envelope IS NULL").count() > 0
    assert rows.where(~F.col("cover").eqNullSafe(F.col("want"))).count() == 0


def test_a_region_is_sought_from_its_segment_f20_f21(spark):
    paths = ["file:/a/b/north/north.pbf.node.parquet/part-0.parquet", "north.pbf.way.parquet", "/x.pbf.y.pbf.node.parquet/p",
             "/r/a b.pbf.node.parquet/q.pbf.way.parquet", "/r/north.pbf/node.parquet", "/.pbf.node.parquet/p", ""]
    d = spark.createDataFrame([(p,) for p in paths], "p string")
    rows = d.select(F.regexp_extract("p", osm.REGION_PATTERN, 1).alias("got"),
                    F.regexp_extract("p", r"([^/]+)\.pbf\.[a-z]+\.parquet", 1).alias("want")).collect()
    assert [r.got for r in rows] == [r.want for r in rows] == ["north", "north", "x.pbf.y", "a b", "", "", ""]
    assert osm.REGION_PATTERN.startswith("(?:^|/)")
