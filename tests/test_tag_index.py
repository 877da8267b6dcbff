"""Search by the tag index, and posting lists in bounded blocks."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from orbis.operators import build as B
from orbis.operators import spatial as SP
from orbis.plans import catalog, store
from orbis.sinks import tables as K

from conftest import SF_SMALL
from test_plans import formatted, plan_of

TAGS = "array<struct<key:string,value:string>>"


def stored(spark, geoms):
    base = tempfile.mkdtemp(prefix="orbis-tags-")
    K.write_tag_index(B.build_tag_index(geoms), f"{base}/t")
    return K.read_tag_index(spark, f"{base}/t")


@pytest.mark.parametrize("op", ["=", "!="])
def test_same_as_the_search_by_cells(spark, op):
    g, idx = store.geometry_store(spark, SF_SMALL)
    pts = catalog.search_points(spark, SF_SMALL)
    want = SP.find_by_tags(g, idx, pts, op=op).select("qid", "id", "kind", "class")
    got = SP.find_ids_by_tags(g, store.tag_index(spark, SF_SMALL), pts, op=op)
    want, got = (sorted(map(tuple, d.collect())) for d in (want, got))
    assert got == want and len(got) > 10


def test_boxes_that_touch_the_search_box(spark):
    """A point on the edge and a line along it are outside, a line with an inner segment and a polygon are in."""
    lon, lat, m = 10.0, 0.0, 100_000.0
    box = spark.range(1).select(F.lit(lon).alias("lon"), F.lit(lat).alias("lat"))
    x1, y1 = SP.query_cover(box, m).select("box.maxx", "box.maxy").first()
    nodes = {1: (x1, 0.0), 2: (x1, 0.1), 3: (x1, 0.2), 4: (10.0, 0.1), 5: (10.1, y1), 6: (10.2, 0.2), 7: (10.0, 0.0)}
    raw = spark.createDataFrame([(i, x, y, [("k", "v")] if i in (1, 7) else []) for i, (x, y) in nodes.items()],
                                f"id long, longitude double, latitude double, tags {TAGS}")
    ways = {20: [1, 2, 3], 21: [1, 2, 4], 22: [4, 5, 6, 4], 23: [4, 6]}
    refs = spark.createDataFrame([(w, i, n) for w, ns in ways.items() for i, n in enumerate(ns)], "way_id long, idx int, node_id long")
    tags = spark.createDataFrame([(w, [("k", "v")]) for w in ways], f"id long, tags {TAGS}")
    g = B.build_nodes(raw).unionByName(B.build_ways(refs, tags, raw))
    pts = box.withColumn("qid", F.lit(1))
    got = SP.find_ids_by_tags(g, stored(spark, g), pts, "k", "v", m)
    assert sorted(r.id for r in got.collect()) == ["n7", "w21", "w22", "w23"]
    whole = SP.find_by_tags(g, None, pts, "k", "v", m, tag_index=stored(spark, g))
    assert sorted((r.id, r.wkt) for r in whole.where("kind = 'n'").collect()) == [("n7", "POINT (10 0)")]


def test_search_reads_its_tags_and_cells_only(spark):
    g, _ = store.geometry_store(spark, SF_SMALL)
    pts = spark.createDataFrame([(1, 10.0, 45.0)], "qid int, lon double, lat double")
    text = formatted(SP.find_ids_by_tags(g, store.tag_index(spark, SF_SMALL), pts, "status", "F", 20000))
    assert plan_of(SP.find_ids_by_tags(g, store.tag_index(spark, SF_SMALL), pts, "status", "F", 20000)).count("tag_index") == 1
    filters = [x for x in text.splitlines() if x.startswith("PartitionFilters") and "cell3" in x]
    assert filters and all("dynamicpruningexpression(cell3" in x and "tag_part" in x for x in filters)
    assert "cell_index" not in text
    many = formatted(SP.find_ids_by_tags(g, store.tag_index(spark, SF_SMALL), catalog.search_points(spark, SF_SMALL)))
    assert "dynamicpruningexpression(cell3" in many and "dynamicpruningexpression(tag_part" in many
    with pytest.raises(ValueError):
        SP.find_ids_by_tags(g, store.tag_index(spark, SF_SMALL), pts, "status", "F", 20000, op=">")
    with pytest.raises(ValueError):
        SP.find_ids_by_tags(g, store.tag_index(spark, SF_SMALL), pts, "status")


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_blocks_of_a_hot_cell(spark, size):
    r = random.Random(size)
    rows = [("hot", f"n{i}") for i in range(2500)] + [(f"c{r.randint(0, 40)}", f"w{i}") for i in range(900)]
    flat = spark.createDataFrame(rows, "cell string, id string").repartition(6)
    path = tempfile.mkdtemp(prefix="orbis-blocks-") + "/n"
    B.numbered_postings(flat).write.parquet(path)
    got = B.posting_blocks(spark.read.parquet(path), size).collect()
    assert max(b.n_ids for b in got) <= size and all(b.n_ids == len(b.ids) for b in got)
    assert all((b.min_id, b.max_id) == (b.ids[0], b.ids[-1]) and b.ids == sorted(b.ids) for b in got)
    whole = {}
    for b in sorted(got, key=lambda b: (b.cell, b.block)):
        whole.setdefault(b.cell, []).extend(b.ids)
    want = {}
    for cell, i in rows:
        want.setdefault(cell, []).append(i)
    assert whole == {c: sorted(v) for c, v in want.items()}
    assert all(b.n_ids == size for b in got if b.block < max(x.block for x in got if x.cell == b.cell))


def test_no_cell_is_brought_together(spark):
    flat = spark.createDataFrame([("a", "n1")], "cell string, id string")
    assert "SinglePartition" not in plan_of(B.posting_blocks(B.numbered_postings(flat)))
