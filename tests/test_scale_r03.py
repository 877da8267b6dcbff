"""What the searches, the ingest and the index cost: fixed by plans, not by times."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from orbis.functions import geohash as GH
from orbis.functions import geometry as GM
from orbis.operators import build as B
from orbis.operators import spatial as SP
from orbis.plans import catalog, store
from orbis.plans.catalog import search_points
from orbis.sinks import tables as K


@pytest.fixture(scope="module")
def copy_dir(tmp_path_factory):
    """The tables under a path of their own: nothing of them is ingested yet."""
    path = tmp_path_factory.mktemp("tables")
    for f in glob.glob(f"{SF_SMALL}/*.parquet"):
        os.symlink(f, path / os.path.basename(f))
    return str(path)


def test_a_kind_is_ingested_without_the_steps_after_it_f14(spark, copy_dir):
    n = store.geometries_of(spark, copy_dir, "n")
    base = n.inputFiles()[0].split("/geometries/")[0].removeprefix("file://").removeprefix("file:")
    assert n.count() > 0 and os.listdir(f"{base}/geometries") == ["kind=n"]
    assert store.geometries(spark, copy_dir).where("kind = 'n'").count() == n.count()
    assert not os.path.exists(f"{base}/cell_index") and not os.path.exists(f"{base}/tag_index")


def test_cells_are_made_after_the_shuffle_f13(spark, tmp_path):
    """Covers cut into squares, some dealt over several tasks: the same rows as the flat index."""
    boxes = [(f"w{i}", -180.0 + 3.1 * i, -90.0 + 1.7 * i, -180.0 + 3.1 * i + 0.1 * i, -90.0 + 1.7 * i + 0.05 * i) for i in range(0, 90, 9)]
    boxes += [("n1", 2.0, 3.0, 2.0, 3.0), ("r1", 1.0, 1.0, 31.0, 21.0), ("w1", 5.0, 5.0, 9.0, 9.0), (None, 1.0, 1.0, 2.0, 2.0)]
    g = spark.createDataFrame(boxes, "id string, minx double, miny double, maxx double, maxy double").select(
        "id", F.struct("minx", "miny", "maxx", "maxy").alias("envelope")).withColumn("cover", GH.cover_grid_of("envelope"))
    want = B.build_index(g)
    K.write_cells(g, str(tmp_path / "cells"), rows=100)
    got = K.read_index(spark, str(tmp_path / "cells")).select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    pieces = GH.cover_blocks(g, "cover", K.CELL_BLOCK, "square")
    assert pieces.count() < want.count() / 4
    K.write_cells(g.limit(0), str(tmp_path / "none"))
    assert K.read_index(spark, str(tmp_path / "none")).count() == 0


def test_query_cells_are_sized_after_they_are_made_f1(spark):
    """The cells of the points, not the points, decide whether they pass the driver."""
    g, idx = store.geometry_store(spark, SF_SMALL)
    covered = SP.query_cover(search_points(spark, SF_SMALL).select("qid", "lon", "lat"), 750000)
    plan = SP.candidates(idx, covered)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("RepartitionByExpression [cell3") < plan.index("Generate explode(sequence(")


def test_numbers_and_cover_lengths_as_before_f5(spark):
    values = [0.0, -0.0, 12.0, 0.1, 1e-4, -1.5e-7, 1e7, 1.25e10, 120.0, 5.001, 1000000.0]
    d = spark.createDataFrame([(v,) for v in values], "v double").select(GM.fmt_num("v").alias("t"))
    assert [r.t for r in d.collect()] == ["0", "-0", "12", "0.1", "0.0001", "-0.00000015", "10000000", "12500000000",
                                          "120", "5.001", "1000000"]
    e = spark.range(400).select((F.rand(1) * 360 - 180).alias("x"), (F.rand(2) * 180 - 90).alias("y"),
                                F.pow(F.lit(10.0), F.rand(3) * 9 - 7).alias("d")) \
        .select(F.struct(F.col("x").alias("minx"), F.col("y").alias("miny"), F.least(F.col("x") + F.col("d"), F.lit(180.0)).alias("maxx"),
                         F.least(F.col("y") + F.col("d"), F.lit(90.0)).alias("maxy")).alias("e"))
    b = F.col("b")

    def n(L):
        s, t = GH.BITS - GH.lon_bits(L), GH.BITS - GH.lat_bits(L)
        return (F.shiftright(b["x1"], s) - F.shiftright(b["x0"], s) + 1) * (F.shiftright(b["y1"], t) - F.shiftright(b["y0"], t) + 1)
    longest = F.greatest(F.lit(3), *[F.when(n(L) <= n(3), F.lit(L)).otherwise(F.lit(3)) for L in range(4, 13)])
    rows = e.select(GH.box_ints("e").alias("b")).select(GH.cover_length_of("b").alias("got"), longest.alias("want")).collect()
    assert len({r.want for r in rows}) > 5 and all(r.got == r.want for r in rows)


def test_rules_left_out_change_no_text_f22(spark):
    """Each kind by itself and in a collection, so that every rule that is guarded by a word is met."""
    points = "MULTIPOINT ((1 2), (3.5 4))"
    for text, n in ((points, 2), ("MULTIPOINT (1 2, 3 4)", 2), (f"GEOMETRYCOLLECTION (POINT (1 2), {points}, POINT EMPTY)", 3),
                    ("LINESTRING (1 2, 3 4)", 2), ("MULTIPOLYGON EMPTY", 0), ("GEOMETRYCOLLECTION EMPTY", 0)):
        r = spark.range(1).select(F.lit(text).alias("t")).select(GM.read_wkt("t").alias("g")).first().g
        assert r.geojson is not None and sum(len(p.pts) for p in r.parts) == n, text


def test_many_query_cells_do_not_pass_the_driver_f2(spark):
    """More cells than may be broadcast, from few points: merged with the index, with the pairs of one box test."""
    _, idx = store.geometry_store(spark, SF_SMALL)
    points = spark.range(1500).select(F.col("id").alias("qid"), (F.col("id") % 150 / 10.0 + 5.0).alias("lon"),
                                      (F.floor(F.col("id") / 150) + 41.0).alias("lat"))
    covered = SP.query_cover(points, 750000)
    assert sum(SP._covers(covered).values()) > SP.BROADCAST_CELLS
    got = SP.candidates(idx, covered)
    rows = got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [cell3" in plan and "BroadcastHashJoin [cell3" not in plan
    b = F.col("box")
    boxes = idx.select("id", "minx", "miny", "maxx", "maxy").distinct()
    want = boxes.crossJoin(F.broadcast(covered)).where((F.col("minx") >= b["minx"]) & (F.col("maxx") <= b["maxx"])
                                                       & (F.col("miny") >= b["miny"]) & (F.col("maxy") <= b["maxy"]))
    assert len(rows) == want.select("qid", "id").distinct().count() > 0


def test_cells_of_other_kinds_are_not_grouped_f18(spark):
    for name, kind in (("relations", "r"), ("ways", "w")):
        plan = catalog.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        below = plan[plan.index("Aggregate ["):]
        assert "StartsWith(id#" in below and f", {kind})" in below


def test_index_is_sorted_once_and_packed_f13(spark, tmp_path):
    g, _ = store.geometry_store(spark, SF_SMALL)
    assert not K.with_cell3(B.build_index(g)).schema["cell3"].nullable
    K.write_cells(g, str(tmp_path / "cells"))
    files = glob.glob(f"{tmp_path}/cells/*/*.parquet")
    assert files and all(".zstd." in f for f in files)
