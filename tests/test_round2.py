"""Inputs that once gave wrong answers: odd numbers and headers, the seam, exact hits,
mixed prefixes, spurs, upserts, real extracts."""

import itertools
import tempfile

import pytest
from pyspark.sql import functions as F

from orbis.functions import geometry as GM
from orbis.functions import measure as M
from orbis.functions import parse as PR
from orbis.operators import build as B
from orbis.operators import lookup as LK
from orbis.operators import spatial as SP
from orbis.operators.rings import largest_face, stitch_rings
from orbis.plans import store
from orbis.sinks import export as EX
from orbis.sinks import tables as K
from orbis.sources import fixtures as FX
from orbis.sources import osm
from orbis.sources import stats as SS

from conftest import SF_SMALL

TAGS = "array<struct<key:string,value:string>>"


def column(spark, values, kind, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", f("v").alias("x")).orderBy("i").collect()]


def test_to_double_takes_finite_numbers_only(spark):
    got = column(spark, ["359,314", " 2.5 ", "nan", "NaN", "inf", "-Infinity", "1e999", "1e3", ".5", "5.", "1d",
                         ":", "", None, "-7"], "string", PR.to_double)
    assert got == [359.314, 2.5, 0.0, 0.0, 0.0, 0.0, 0.0, 1000.0, 0.5, 5.0, 0.0, 0.0, 0.0, 0.0, -7.0]


def test_wkt_numbers_keep_their_digits(spark):
    values = [1.2345678901234567e-4, 1e-19, -2.5e-7, 1e7, 123456789.125, -1.5e20, 0.001, 12.0, -0.0, 5e-324]
    got = column(spark, values, "double", GM.fmt_num)
    assert [float(x) for x in got] == values and not any("e" in x.lower() for x in got)
    assert got[:4] == ["0.00012345678901234567", "0.0000000000000000001", "-0.00000025", "10000000"]


@pytest.mark.parametrize("text,cls,types,n", [
    ("POINT (1 2)", "p", ["p"], 1), ("linestring (0 0, 1 1)", "ls", ["ls"], 2),
    ("POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))", "pl", ["pl", "h"], 8),
    ("GEOMETRYCOLLECTION (POINT (1 2), LINESTRING (0 0, 1 1), POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1)))",
     "gc", ["p", "ls", "pl", "h"], 11),
    ("MULTIPOINT ((1 2), (3 4))", "gc", ["p", "p"], 2), ("MULTIPOINT (1 2, 3 4)", "gc", ["p", "p"], 2),
    ("MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))", "gc", ["ls", "ls"], 4),
    ("MULTIPOLYGON (((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1)), ((8 8, 9 8, 9 9, 8 8)))", "gc",
     ["pl", "h", "pl"], 12), ("CIRCLE (1 2)", None, None, 0), ("", None, None, 0)])
def test_wkt_reader(spark, text, cls, types, n):
    r = spark.range(1).select(GM.wkt_to_parts(F.lit(text)).alias("p")).first().p
    assert r["class"] == cls
    assert (r.parts and [p.t for p in r.parts]) == types
    assert sum(len(p.pts) for p in r.parts or []) == n


def nodes(spark, rows):
    raw = spark.createDataFrame([(i, x, y, [("k", "v")]) for i, x, y in rows],
                                f"id long, longitude double, latitude double, tags {TAGS}")
    g = B.build_nodes(raw)
    return g, B.build_index(g)


def test_seam_is_no_edge_of_a_buffer(spark):
    g, idx = nodes(spark, [(1, 179.99, 0.0), (2, 180.0, 0.0), (3, -180.0, 0.0), (4, -179.9, 0.0), (5, 179.0, 0.0)])
    pts = spark.createDataFrame([(0, 179.95, 0.0), (1, -179.95, 0.0)], "qid int, lon double, lat double")
    got = {(r.qid, r.id) for r in SP.find_by_tags(g, idx, pts, "k", "v", 50000).collect()}
    near = {"n1", "n2", "n3", "n4"}
    assert got == {(q, i) for q in (0, 1) for i in near}


def test_points_on_a_sample_get_its_value(spark):
    places = [(i, -10.0 + i * 0.377, 30.0 + i * 0.0913) for i in range(120)]
    g, idx = nodes(spark, places)
    stats = spark.createDataFrame([(f"n{i}", "s", 2000, float(i), str(i)) for i, _, _ in places],
                                  "id string, indicator string, year int, value double, value_raw string")
    pts = spark.createDataFrame(places, "qid int, lon double, lat double")
    got = SP.interpolate(g, idx, stats, pts, "s", 2000, 80000).collect()
    assert {r.qid: r.value for r in got} == {i: float(i) for i, _, _ in places}
    assert spark.range(1).select(M.distance_km(F.lit(1.1), F.lit(2.2), F.lit(1.1), F.lit(2.2))).first()[0] == 0


def test_prefixes_of_mixed_lengths(spark):
    cells = ["u0j", "u0k", "u0k7", "u0l", "uz9", "spu", "spv", "t00"]
    idx = spark.createDataFrame([(c, c) for c in cells], "cell string, id string")
    for prefixes in (["u", "u0k"], ["u0k", "spu"], ["s", "u0k7", "u0"], [], ["zz"], [""]):
        got = sorted(r.cell for r in LK.scan_index_by_prefixes(idx, prefixes).collect())
        assert got == sorted(c for c in cells if any(c.startswith(p) for p in prefixes)), prefixes


# ------------------------------------------------------------------ rings

SQUARE = [[(0, 0), (4, 0), (4, 4)], [(4, 4), (0, 4)], [(0, 4), (0, 0)]]
SPUR = [(4, 4), (9, 9)]
LOOP = [[(4, 4), (6, 4), (6, 6)], [(6, 6), (4, 4)]]          # touches the square in one point
HOLE = [[(1, 1), (2, 1)], [(2, 1), (2, 2), (1, 1)]]


def members(lines):
    return [(k, [float(x) for x, _ in ln], [float(y) for _, y in ln]) for k, ln in enumerate(lines)]


def _rings_of(members):
    face = largest_face([(xs, ys) for _, xs, ys in members])
    rings = None if face is None else [face[0], *face[1]]
    return rings and (["pl"] + ["h"] * len(face[1]), [[x for x, _ in r] for r in rings], [[y for _, y in r] for r in rings])


def points(result):
    ts, xs, ys = result
    return ts, [sorted(set(zip(x, y))) for x, y in zip(xs, ys)]


def test_rings_do_not_depend_on_member_order_or_direction():
    lines = SQUARE + [SPUR] + LOOP + HOLE
    want = points(_rings_of(members(lines)))
    assert want[0] == ["pl", "h"] and want[1][0] == [(0, 0), (0, 4), (4, 0), (4, 4)]
    for k, order in enumerate(itertools.islice(itertools.permutations(lines), 0, None, 501)):
        turned = [ln[::-1] if (k + i) % 3 == 0 else ln for i, ln in enumerate(order)]
        assert points(_rings_of(members(turned))) == want


def test_spurs_and_trees_close_no_ring():
    assert _rings_of(members([SPUR, [(9, 9), (12, 3)], [(9, 9), (8, 1)]])) is None
    assert points(_rings_of(members([SQUARE[0], SPUR, SQUARE[1], SQUARE[2]])))[0] == ["pl"]


def test_single_closed_way_needs_no_python(spark):
    kind = "rel_id long, pos long, parts array<struct<t:string,pts:array<struct<x:double,y:double>>>>"
    sq = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    rows = [(1, 0, [("pl", sq)]), (1, 1, [("p", [(5.0, 5.0)])]), (2, 0, [("pl", sq)]),
            (2, 1, [("ls", [(0.0, 0.0), (3.0, 3.0)])])]
    got = {r.osm_id: [[(p.x, p.y) for p in part.pts] for part in r.parts]
           for r in stitch_rings(spark.createDataFrame(rows, kind)).collect()}
    assert got == {1: [sq], 2: [sq]}


# ------------------------------------------------------------------ statistics

def write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_csv_columns_go_by_name(spark):
    base = tempfile.mkdtemp(prefix="orbis-csv-")
    write(f"{base}/a.csv", "CITIES,TIME,extra,INDIC_UR,Value\nLund,2010,x,pop,7\n")
    r = SS.read_stat_csv(spark, base).first()
    assert (r.TIME, r.CITIES, r.INDIC_UR, r.Value) == ("2010", "Lund", "pop", "7")
    other = tempfile.mkdtemp(prefix="orbis-csv-")
    write(f"{other}/a.csv", "name,id\nLund,3\n")
    assert tuple(SS.read_names(spark, other).first()) == ("3", "Lund")
    write(f"{other}/b.csv", "id,label\n3,Lund\n")
    with pytest.raises(ValueError, match="no column name"):
        SS.read_names(spark, f"{other}/b.csv")


def test_upsert_keeps_what_is_not_updated(spark):
    kind = "id string, indicator string, year int, value double, value_raw string"
    cur = spark.createDataFrame([("r1", "x", 2010, 1.0, "1"), ("r2", "x", 2010, 2.0, "2"),
                                 ("r3", None, None, None, None)], kind)
    new = spark.createDataFrame([("r1", "x", 2010, 9.0, "9"), ("r3", "x", 2011, 3.0, "3"),
                                 ("r4", "x", 2011, 4.0, "4"), ("r4", "x", 2011, 5.0, "5")], kind)
    got = sorted((r.id, r.year, r.value) for r in K.upsert_stats(cur, new).collect())
    assert got == [("r1", 2010, 9.0), ("r2", 2010, 2.0), ("r3", 2011, 3.0), ("r4", 2011, 5.0)]


def test_year_values_json(spark):
    rows = spark.createDataFrame([("Lund", 2011, 2.5), ("Lund", 2010, 1.0)], "city string, year int, value double")
    assert EX.year_values_json(rows).first().json == '{"Lund":{"2010":1.0,"2011":2.5}}'


# ------------------------------------------------------------------ extracts

def test_ingest_of_real_extracts(spark):
    base, out = tempfile.mkdtemp(prefix="orbis-pbf-"), tempfile.mkdtemp(prefix="orbis-out-")
    raw = FX.raw_nodes(spark, SF_SMALL)
    ways = FX.raw_ways(spark, SF_SMALL)
    for k, region in enumerate(("alpha", "beta")):
        raw.where(F.col("id") % 2 == k).write.parquet(osm.extract_paths(base, [region], "node")[0])
        ways.where(F.col("id") % 2 == k).write.parquet(osm.extract_paths(base, [region], "way")[0])
        spark.createDataFrame([(k + 1, [(1, "outer", "Way")], [("type", "site")])],
                              f"id long, members array<struct<id:long,role:string,type:string>>, tags {TAGS}") \
            .write.parquet(osm.extract_paths(base, [region], "relation")[0])
    paths = store.ingest_extracts(spark, base, ["alpha", "beta"], f"{out}/store")
    g = spark.read.parquet(paths["geometries"])
    assert {r.kind: r["count"] for r in g.groupBy("kind").count().collect()}["r"] == 2
    assert g.where("kind = 'n'").count() == raw.where(F.size("tags") > 0).count()
    indexed = spark.read.parquet(paths["cell_index"]).select("id").distinct().count()
    assert indexed == g.count()


def test_checkpoint_folder_is_asked_for_on_a_cluster(spark):
    from types import SimpleNamespace

    from orbis.session import checkpoint_root

    class Conf:
        def get(self, key, default=None):
            return default
    far = SimpleNamespace(conf=Conf(), sparkContext=SimpleNamespace(
        master="spark://host:7077", applicationId="app", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(far)
