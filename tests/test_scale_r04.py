"""What the queries of the cell index, the searches by tag and the codec cost: fixed by plans, not by times."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from orbis.functions import codec as CD
from orbis.functions import geometry as GM
from orbis.operators import build as B
from orbis.operators import spatial as SP
from orbis.plans import catalog, store
from test_plans import plan_of


def test_cells_are_counted_without_a_sort_f4(spark):
    """Ids of other forms, negative ones, blanks and nulls too: the ranges of the texts."""
    ids = ["w5", "w10", "w9", "n7", "w-3", "w-20", "r007", "r7", "w 4", "x", "", "w9223372036854775808", None, "w10"]
    flat = spark.createDataFrame([("a", i) for i in ids] + [("b", "n2"), ("b", "n10"), ("c", None), (None, "w1")], "cell string, id string")
    want = flat.groupBy("cell").agg(F.count(F.lit(1)).alias("n_ids"), F.min("id").alias("min_id"), F.max("id").alias("max_id"))
    got = B.cell_ranges(flat.repartition(3))
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    plan = plan_of(got)
    rows = plan[plan.rindex("Exchange hashpartitioning(cell"):]      # what meets every row of the index
    assert "HashAggregate(keys=[cell" in rows and "Sort" not in rows


def test_rules_of_a_text_are_tried_once_f6(spark):
    """Each step of the codec stands once in the plan: none is made again where its result is read twice."""
    texts = spark.createDataFrame([("GEOMETRYCOLLECTION (POINT Z (1 2 3), MULTIPOINT ((+1 .5), (007 2.)))",)], "t string")
    g = texts.select(GM.read_wkt("t").alias("g")).select("g.geojson", CD.geojson_to_wkt("g.geojson").alias("w"))
    plan = g._jdf.queryExecution().analyzed().toString()
    assert plan.count(r"\([p,]+\)") == 2 and plan.count(r"\([q,]+\)") == 2         # one for each direction
    assert plan.count(r"(\[[^\]]*\])\s*\)") == 1
    assert g.first().w == "GEOMETRYCOLLECTION (POINT (1 2 3), MULTIPOINT (1 0.5, 7 2))"


def test_sides_say_what_the_box_test_says_f5(spark):
    """Random lines and collections in a box whose edges they touch or not, some with coordinates that are not known."""
    r = random.Random(4)
    at = lambda: r.choice([0.0, 0.0, 1.0, 2.0, 3.0, 3.0, None if r.random() < 0.2 else 1.5])
    rows = []
    for i in range(600):
        parts = [(t, [(at(), at()) for _ in range(1 if t == "p" else r.randint(0, 4))])
                 for t in r.choices(["p", "ls", "ls", "pl", "h"], weights=[4, 4, 4, 1, 1], k=r.randint(1, 3))]
        x0, x1, y0, y1 = r.choice([0.0, -1.0]), r.choice([3.0, 4.0]), r.choice([0.0, -1.0]), r.choice([3.0, 4.0])
        rows.append((i, parts, (x0, y0, x1, y1)))
    g = spark.createDataFrame(rows, f"i int, parts {GM.PARTS_TYPE}, box {GM.ENVELOPE_TYPE}").withColumn("e", GM.envelope("parts")) \
        .where("e.minx IS NOT NULL AND e.miny IS NOT NULL")
    env = {c: F.col(f"e.{c}") for c in ("minx", "miny", "maxx", "maxy")}
    got = g.select("parts", "box", F.coalesce(GM.box_contains("box", "e", "parts"), F.lit(False)).alias("want"),
                   F.coalesce(GM.box_contains_sides("box", env, GM.inner_sides("e", "parts")), F.lit(False)).alias("got")).collect()
    assert [x for x in got if x.want != x.got] == [] and {x.want for x in got} == {True, False}


@pytest.mark.parametrize("op", ["=", "!="])
def test_found_rows_pass_no_shuffle_f3_f5(spark, monkeypatch, op):
    """Many points or few, the same rows; above the join of cells and index nothing is shuffled."""
    g, pts = store.geometries(spark, SF_SMALL), catalog.search_points(spark, SF_SMALL)
    t = store.tag_index(spark, SF_SMALL)
    want = sorted(map(str, SP.find_by_tags(g, None, pts, op=op, tag_index=t).collect()))
    one = sorted(map(str, SP.find_by_tags(g, None, pts.drop("key", "value"), "status", "F", op=op, tag_index=t).collect()))
    monkeypatch.setattr(SP, "BROADCAST_CELLS", 10)
    monkeypatch.setattr(SP, "LOOKUP_CELLS", 10)
    many = SP.find_by_tags(g, None, pts, op=op, tag_index=t)
    assert want and sorted(map(str, many.collect())) == want
    got = SP.find_by_tags(g, None, pts.drop("key", "value"), "status", "F", op=op, tag_index=t)
    assert one and sorted(map(str, got.collect())) == one
    for found in (many, SP.find_ids_by_tags(g, t, pts, op=op)):
        plan = found._jdf.queryExecution().sparkPlan().toString()
        top = plan[:plan.index("SortMergeJoin [cell3")] if "SortMergeJoin [cell3" in plan else plan[:plan.index("Join [cell3")]
        assert "Join" not in top.replace("SortMerge", "").replace("BroadcastHash", "")


@pytest.mark.parametrize("size", [1, 7, 100])
def test_packed_entries_are_the_index_f1_f2(spark, size):
    """Ids of every length, negative ones, a hot cell: the lists and blocks of the flat index, from fewer rows."""
    r = random.Random(size)
    ids = [f"w{i}" for i in range(1500)] + [f"w{r.randint(0, 10 ** 5)}" for _ in range(900)] + ["w-5", "w-17", "n3", "r12", "w"]
    rows = sorted({("hot", i) for i in ids} | {(f"c{r.randint(0, 30)}", i) for i in ids})
    flat = spark.createDataFrame(rows, "cell string, id string").repartition(3)
    packed = B.pack_index(flat).cache()
    assert B.is_packed(packed) and packed.count() < len(rows) and packed.agg(F.sum("n")).first()[0] == len(rows)
    whole = {}
    for cell, i in rows:
        whole.setdefault(cell, []).append(i)
    blocks = B.posting_blocks(packed, size)
    back = {}
    for b in sorted(blocks.collect(), key=lambda b: (b.cell, b.block)):
        assert b.n_ids == len(b.ids) and (b.min_id, b.max_id) == (b.ids[0], b.ids[-1])
        assert b.n_ids == size or len(back.get(b.cell, [])) + b.n_ids == len(whole[b.cell])
        back.setdefault(b.cell, []).extend(b.ids)
    assert back == whole
    grouped = B.group_index(flat, 4, packed).collect()
    assert all(g.ids == sorted(g.ids) and 0 <= g.chunk < 4 for g in grouped) and len({(g.cell, g.chunk) for g in grouped}) == len(grouped)
    assert sorted((g.cell, i) for g in grouped for i in g.ids) == rows
    odd = (["w1", "w1"], ["w1", None], ["w1x", "w123"], ["w1", "w12é"])
    assert not any(B.is_packed(B.pack_index(spark.createDataFrame([("a", i) for i in own], "cell string, id string"))) for own in odd)


def test_postings_are_packed_once_f1_f2(spark):
    packed = store.packed_index(spark, SF_SMALL)
    flat = store.cell_index(spark, SF_SMALL)
    assert packed.count() < flat.count() / 2
    assert "ArraySort" not in plan_of(catalog.q_posting_blocks(spark, SF_SMALL)) and "-packed" in plan_of(catalog.q_cell_postings(spark, SF_SMALL))


def test_rows_meet_their_cells_packed_f7(spark):
    """The cells of ids with one, none and many entries; a second entry of an id in a cell is counted as before."""
    ids = [f"w{i}" for i in range(300)] + ["w12345", "w-7"]
    entries = [(f"c{(i * 7 + k) % 40}", w) for i, w in enumerate(ids) for k in range(i % 9)]
    rows = spark.createDataFrame([(w, i) for i, w in enumerate(ids)] + [(None, -1), ("w999", -2)], "id string, v int")
    for twice in (False, True):
        flat = spark.createDataFrame(entries + entries[:1] * twice, "cell string, id string").repartition(3)
        each = flat.groupBy("id").agg(F.count(F.lit(1)).cast("int").alias("n_cells"),
                                      F.concat_ws(" ", F.array_sort(F.collect_list("cell"))).alias("cells"))
        got = B.with_cells(rows, flat)
        assert sorted(got.select("id", "v", "n_cells", "cells").collect()) == sorted(rows.join(each, "id").collect())
        assert ("head" in got._jdf.queryExecution().optimizedPlan().toString()) == (not twice)
    plan = catalog.q_ways(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join ") < plan.index("size(parts")           # parts and tags stay below the join
