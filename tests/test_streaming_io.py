"""Incremental statistics stream, raw extract readers (S1–S7) and sinks."""

import os
import tempfile

from pyspark.sql import functions as F

from orbis.sinks import tables as K
from orbis.sources import fixtures as FX
from orbis.sources import osm
from orbis.sources import stats as SS
from orbis.streaming.stat_files import latest_stats, start_stat_stream

from conftest import SF_SMALL


def _write_csv(path, rows):
    with open(path, "w") as f:
        f.write("TIME,CITIES,INDIC_UR,Value\n")
        for r in rows:
            f.write(",".join(f'"{v}"' for v in r) + "\n")


def test_stat_stream_upserts(spark):
    base = tempfile.mkdtemp(prefix="orbis-stream-")
    src, out, ck = f"{base}/in", f"{base}/out", f"{base}/ck"
    os.makedirs(src)
    names = spark.createDataFrame([("1", "Lund"), ("2", "Rubí")], "id string, name string")
    _write_csv(f"{src}/a.csv", [("2010", "Lund", "pop", "118,542"), ("2010", "Rubí", "pop", ":")])
    start_stat_stream(spark, src, names, out, ck).awaitTermination()
    _write_csv(f"{src}/b.csv", [("2010", "Rubí", "pop", "73,591")])
    start_stat_stream(spark, src, names, out, ck).awaitTermination()
    got = {r.id: r.value for r in latest_stats(spark, out).collect()}
    assert got == {"r1": 118.542, "r2": 73.591}


def test_stat_stream_reads_columns_by_name(spark):
    base = tempfile.mkdtemp(prefix="orbis-stream-")
    src, out, ck = f"{base}/in", f"{base}/out", f"{base}/ck"
    os.makedirs(src)
    names = spark.createDataFrame([("1", "Lund"), ("2", "Rubí")], "id string, name string")
    _write_csv(f"{src}/a.csv", [("2010", "Lund", "pop", "118,542")])
    with open(f"{src}/b.csv", "w") as f:
        f.write('Value,INDIC_UR,flag,CITIES,TIME\n"73,591",pop,e,Rubí,2011\n')
    start_stat_stream(spark, src, names, out, ck).awaitTermination()
    got = {(r.id, r.year): (r.indicator, r.value) for r in latest_stats(spark, out).collect()}
    assert got == {("r1", 2010): ("pop", 118.542), ("r2", 2011): ("pop", 73.591)}


def test_stat_csv_directory_reads_all_files(spark):
    base = tempfile.mkdtemp(prefix="orbis-csv-")
    _write_csv(f"{base}/one.csv", [("2010", "A", "x", "1")])
    _write_csv(f"{base}/two.csv", [("2011", "A", "x", "2")])
    df = SS.read_stat_csv(spark, base)
    assert df.count() == 2 and df.select("source_file").distinct().count() == 2


def test_raw_extract_roundtrip_with_region(spark):
    base = tempfile.mkdtemp(prefix="orbis-osm-")
    nodes = FX.raw_nodes(spark, SF_SMALL)
    for region in ("alpha", "beta"):
        nodes.where(F.col("id") % 2 == (0 if region == "alpha" else 1)).write.parquet(
            osm.extract_paths(base, [region], "node")[0])
    back = osm.with_region(osm.read_nodes(spark, *osm.extract_paths(base, ["alpha", "beta"], "node")))
    assert back.count() == nodes.count()
    assert {r.region for r in back.select("region").distinct().collect()} == {"alpha", "beta"}
    ways = FX.raw_ways(spark, SF_SMALL)
    refs = osm.way_refs(ways)
    assert refs.count() == FX.way_refs(spark, SF_SMALL).count()


def test_upsert_stats(spark):
    cur = spark.createDataFrame([("r1", "A", "x", 2010, 1.0, "1"), ("r1", "A", "x", 2011, 2.0, "2")],
                                "id string, name string, indicator string, year int, value double, value_raw string")
    new = spark.createDataFrame([("r1", "A", "x", 2011, 5.0, "5"), ("r2", "B", "x", 2011, 7.0, "7")],
                                cur.schema)
    got = {(r.id, r.year): r.value for r in K.upsert_stats(cur, new).collect()}
    assert got == {("r1", 2010): 1.0, ("r1", 2011): 5.0, ("r2", 2011): 7.0}
