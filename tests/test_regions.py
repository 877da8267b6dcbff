"""Overlapping region extracts: every element once, the last extract wins."""

import glob
import os
import tempfile

from pyspark.sql import functions as F

from orbis.plans import store
from orbis.sinks import tables as K
from orbis.sources import osm

TAGS = "array<struct<key:string,value:string>>"
KINDS = {"node": f"id long, longitude double, latitude double, tags {TAGS}",
         "way": f"id long, nodes array<struct<index:int,nodeId:long>>, tags {TAGS}",
         "relation": f"id long, members array<struct<id:long,role:string,type:string>>, tags {TAGS}"}


def write_region(spark, base, region, **rows):
    for kind, schema in KINDS.items():
        spark.createDataFrame(rows.get(kind, []), schema) \
            .write.parquet(osm.extract_paths(base, [region], kind)[0])


def two_regions(spark):
    """Both hold way 7 (three nodes) and relation 9; ``b`` has moved node 3 and renamed the way."""
    base = tempfile.mkdtemp(prefix="orbis-overlap-")
    way = [(0, 1), (1, 2), (2, 3)]
    write_region(spark, base, "a",
                 node=[(1, 0.0, 0.0, []), (2, 1.0, 0.0, []), (3, 2.0, 0.0, [("shop", "old")]), (4, 5.0, 5.0, [("shop", "x")]),
                       (4, 5.0, 5.0, [("shop", "x")])],
                 way=[(7, way, [("name", "old")]), (8, [(0, 1), (1, 4)], [("name", "only a")])],
                 relation=[(9, [(7, "", "Way"), (4, "", "Node")], [("type", "site")])])
    write_region(spark, base, "b",
                 node=[(1, 0.0, 0.0, []), (2, 1.0, 0.0, []), (3, 2.0, 2.0, [("shop", "new")])],
                 way=[(7, way, [("name", "new")])], relation=[(9, [(7, "", "Way")], [("type", "site")])])
    return base


def geometries(spark, base, regions):
    out = tempfile.mkdtemp(prefix="orbis-overlap-out-")
    paths = store.ingest_extracts(spark, base, regions, out)
    rows = spark.read.parquet(paths["geometries"]).collect()
    assert len({r.id for r in rows}) == len(rows)
    cells = spark.read.parquet(paths["cell_index"])
    assert cells.count() == cells.select("cell", "id").distinct().count()
    return {r.id: (r.wkt, r.tags.get("name") or r.tags.get("shop")) for r in rows}


def test_last_extract_wins(spark):
    base = two_regions(spark)
    common = {"n4": ("POINT (5 5)", "x"), "w8": ("LINESTRING (0 0, 5 5)", "only a")}
    assert geometries(spark, base, ["a", "b"]) == {
        **common, "n3": ("POINT (2 2)", "new"), "w7": ("LINESTRING (0 0, 1 0, 2 2)", "new"),
        "r9": ("GEOMETRYCOLLECTION (LINESTRING (0 0, 1 0, 2 2))", None)}
    assert geometries(spark, base, ["b", "a"]) == {
        **common, "n3": ("POINT (2 0)", "old"), "w7": ("LINESTRING (0 0, 1 0, 2 0)", "old"),
        "r9": ("GEOMETRYCOLLECTION (LINESTRING (0 0, 1 0, 2 0), POINT (5 5))", None)}


def test_rows_that_one_extract_repeats(spark):
    rows = spark.createDataFrame([(1, "a", 0), (1, "b", 0), (1, "b", 0), (2, "c", 0), (None, "d", 1), (3, "e", 1), (3, "f", 0)],
                                 "id long, v string, region_rank int")
    got = {tuple(sorted((r.id or 0, r.v) for r in osm.last_wins(rows.repartition(n)).collect())) for n in (1, 3, 5)}
    assert len(got) == 1                                    # whatever the partitioning
    assert [i for i, _ in got.pop()] == [0, 1, 2, 3]


def test_only_ids_are_shuffled(spark):
    base = two_regions(spark)
    plan = osm.last_wins(osm.read_regions(spark, base, ["a", "b"], "node"))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(key=[id" in plan.replace("keys=", "key=") and "CartesianProduct" not in plan


def table_rows(spark, paths):
    g = spark.read.parquet(paths["geometries"]).select("id", "class", "wkt", F.to_json("tags").alias("tags"))
    return [sorted(map(tuple, g.collect()))] + [
        sorted(map(tuple, K_read(spark, paths[t]).collect()))
        for t, K_read in (("cell_index", K.read_index), ("tag_index", K.read_tag_index))]


def files_below(path):
    return {f: (os.path.getmtime(f), os.path.getsize(f)) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_added_region_equals_a_rebuild(spark):
    base = two_regions(spark)
    # far away, only in the first extract; and a place that the second extract moves away from
    write_region(spark, base, "c", node=[(50, 100.0, -40.0, [("shop", "far")]), (51, 101.0, -40.0, []), (52, 60.0, 60.0, [("shop", "here")])],
                 way=[(60, [(0, 50), (1, 51)], [("name", "far")])])
    write_region(spark, base, "d", node=[(52, 61.5, 62.0, [("shop", "moved")])])
    first, whole = tempfile.mkdtemp(prefix="orbis-first-"), tempfile.mkdtemp(prefix="orbis-whole-")
    store.ingest_extracts(spark, base, ["a", "c"], first)
    before = files_below(f"{first}/cell_index")
    paths = store.add_region(spark, base, "b", first, tempfile.mkdtemp(prefix="orbis-out-") + "/1")
    assert table_rows(spark, paths) == table_rows(spark, store.ingest_extracts(spark, base, ["a", "c", "b"], whole))
    after = files_below(f"{first}/cell_index")
    same = {f for f in before if after.get(f) == before[f]}
    far = {f for f in before if "cell3=s0" not in f}                # what changes lies within these cells
    assert far and far <= same and same != set(before)
    # the only row of a cell moves: its folder goes
    old_cell = [f for f in after if any(r.id == "n52" for r in spark.read.parquet(f).select("id").collect())]
    out = tempfile.mkdtemp(prefix="orbis-out-") + "/2"
    grown = store.add_region(spark, base, "d", _merged(first, paths), out)
    assert old_cell and not any(os.path.exists(f) for f in old_cell)
    rebuilt = store.ingest_extracts(spark, base, ["a", "c", "b", "d"], tempfile.mkdtemp(prefix="orbis-whole-"))
    assert table_rows(spark, grown) == table_rows(spark, rebuilt)


def _merged(first, paths):
    """A store folder whose raw tables and geometries are the grown ones and whose indexes are the updated ones."""
    out = os.path.dirname(paths["geometries"])
    for name in ("cell_index", "tag_index"):
        os.symlink(f"{first}/{name}", f"{out}/{name}")
    return out
