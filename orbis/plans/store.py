"""Ingest once, query many: the ``geometries`` table and the flat cell index
written to the shared folder the cluster names in ``spark.checkpoint.dir``.

Analysis queries read these tables instead of re-running way assembly and
ring stitching (the table names are set once, here: Q20); a written table also cuts lineage, so a lost executor costs
a re-read, not a re-ingest.  Tables are keyed by the input files (path,
size, modification time), so changed inputs are ingested again.
"""

from __future__ import annotations

import hashlib
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbis.operators import build as B
from orbis.operators.statistics import build_names, stat_facts
from orbis.plans import params as P
from orbis.session import committed, table_path
from orbis.sinks import tables as K
from orbis.sources import fixtures as FX
from orbis.sources import osm
from orbis.sources import stats as stats_files

INGEST_TABLES = ("part", "lineitem", "orders", "customer", "nation")
GEOMETRY_TABLES = ("geometries", "cell_index", "tag_index")
# bump when the layout or the rules of the written tables change
STORE_LAYOUT = "12"
_CACHE: dict[tuple[str, str], dict[str, str]] = {}
_LOCK = threading.Lock()
_FRAMES: dict[tuple[str, str, str], DataFrame] = {}


def _input_key(spark: SparkSession, sf_dir: str) -> str:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    h = hashlib.sha1(STORE_LAYOUT.encode())
    for t in INGEST_TABLES:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        fs = path.getFileSystem(conf)
        listed = fs.listStatus(path)          # the file itself, or the files of a table folder
        for st in sorted(listed, key=lambda st: st.getPath().toString()):
            h.update(f"{st.getPath().toString()}|{st.getLen()}|{st.getModificationTime()}".encode())
    return h.hexdigest()[:16]


def ingest(spark: SparkSession, sf_dir: str, root: str | None = None) -> dict[str, str]:
    """Build and write every stored table for the driver tables under ``sf_dir``: the
    geometries and their index, the statistics and the locality dictionary.  Steps already
    written are skipped.  Returns the paths."""
    return {**ingest_geometries(spark, sf_dir, root), **ingest_stats(spark, sf_dir, root)}


def ingest_geometries(spark: SparkSession, sf_dir: str, root: str | None = None,
                      upto: str | None = None) -> dict[str, str]:
    """Nodes, ways, relations (reading the written ways back, which cuts lineage) into
    ``geometries/kind=<n|w|r>``; then ``cell_index`` and ``tag_index`` of every stored geometry.
    With ``upto`` (``kind=<n|w|r>`` or a table) only the steps that it rests on."""
    base = root or table_path(spark, "orbis", _input_key(spark, sf_dir))
    paths = {t: f"{base}/{t}" for t in GEOMETRY_TABLES}
    write_store(spark, paths, FX.raw_nodes(spark, sf_dir), FX.way_refs(spark, sf_dir),
                FX.way_tags(spark, sf_dir), FX.relation_members(spark, sf_dir),
                FX.relation_tags(spark, sf_dir), upto)
    if upto is None or upto in GEOMETRY_TABLES[1:]:
        return paths if upto is None else {t: paths[t] for t in ("geometries", upto)}
    return {"geometries": paths["geometries"]} if upto == "geometries" else {upto: f"{paths['geometries']}/{upto}"}


def ingest_stats(spark: SparkSession, sf_dir: str, root: str | None = None) -> dict[str, str]:
    """The statistics (``stats``, one scan of the facts) and the dictionary (``localities``)."""
    base = root or table_path(spark, "orbis", _input_key(spark, sf_dir))
    paths = {t: f"{base}/{t}" for t in ("stats", "localities")}
    if not committed(spark, paths["localities"]):
        # written last: its marker says that both are whole
        K.load_stats(spark, FX.stat_csv(spark, sf_dir), FX.names(spark, sf_dir), paths["stats"])
        build_names(FX.names(spark, sf_dir)).write.mode("overwrite").parquet(paths["localities"])
    return paths


def merge_extracts(spark: SparkSession, root: str, regions: list[str], out: str) -> dict[str, str]:
    """S7 + K1-K3: the node, way and relation tables of overlapping extracts, every id once
    (``osm.last_wins``), written below ``out``: three later steps read them."""
    paths = {kind: f"{out}/raw/{kind}" for kind in osm.READERS}
    for kind, path in paths.items():
        if not committed(spark, path):
            osm.last_wins(osm.read_regions(spark, root, regions, kind)).write.mode("overwrite").parquet(path)
    return paths


def ingest_extracts(spark: SparkSession, root: str, regions: list[str], out: str) -> dict[str, str]:
    """E10 + E9 for real extracts (S1-S3, S7): the node, way and relation tables of
    ``regions`` below ``root`` become the geometry table and cell index below ``out``.  Extracts may
    overlap: an element that several hold is the one of the last."""
    raw = merge_extracts(spark, root, regions, out)
    nodes, ways, rels = (osm.READERS[kind](spark, raw[kind]) for kind in ("node", "way", "relation"))
    paths = {t: f"{out}/{t}" for t in GEOMETRY_TABLES}
    write_store(spark, paths, nodes, osm.way_refs(ways), osm.way_tags(ways), osm.relation_members(rels),
                osm.relation_tags(rels))
    return paths


def _changed(spark: SparkSession, raw: dict[str, str], new: dict[str, DataFrame], out: str) -> dict[str, DataFrame]:
    """Ids that a delivery changes, per kind (written): its own elements, the ways that refer to its
    nodes, the relations with any of these as members."""
    nodes = new["node"].select("id")
    refs = osm.way_refs(osm.read_ways(spark, raw["way"]))
    ways = refs.join(nodes, F.col("node_id") == F.col("id"), "left_semi").select(F.col("way_id").alias("id")) \
        .unionByName(new["way"].select("id")).distinct()
    ways.write.mode("overwrite").parquet(f"{out}/changed/way")
    ways = spark.read.parquet(f"{out}/changed/way")
    below = nodes.select(F.lit("Node").alias("member_type"), F.col("id").alias("member_id")).unionByName(
        ways.select(F.lit("Way").alias("member_type"), F.col("id").alias("member_id")))
    members = osm.relation_members(osm.read_relations(spark, raw["relation"]))
    rels = members.join(below, ["member_type", "member_id"], "left_semi").select(F.col("rel_id").alias("id")) \
        .unionByName(new["relation"].select("id")).distinct()
    rels.write.mode("overwrite").parquet(f"{out}/changed/relation")
    return {"node": nodes, "way": ways, "relation": spark.read.parquet(f"{out}/changed/relation")}


def add_region(spark: SparkSession, root: str, region: str, before: str, out: str) -> dict[str, str]:
    """Another extract for a store of ``ingest_extracts`` at ``before``: the same tables as an ingest of all
    extracts with this one last.

    Raw tables and geometries are copied to ``out`` with the changed rows replaced: only ways and
    relations that the delivery touches are assembled again.  The indexes stay where they are (K4, K6):
    only the partitions of the cells that lose or get rows are rewritten.  Every step is a
    written table, and a step run again after a failure gives the same result."""
    raw = {kind: f"{out}/raw/{kind}" for kind in osm.READERS}
    new = {kind: osm.last_wins(osm.read_regions(spark, root, [region], kind)) for kind in osm.READERS}
    for kind, path in raw.items():
        if not committed(spark, path):
            old = osm.READERS[kind](spark, f"{before}/raw/{kind}").join(new[kind].select("id"), "id", "left_anti")
            old.unionByName(new[kind]).write.mode("overwrite").parquet(path)
    nodes, ways, rels = (osm.READERS[kind](spark, raw[kind]) for kind in ("node", "way", "relation"))
    ids = _changed(spark, raw, new, out)
    refs = osm.way_refs(ways).join(ids["way"].select(F.col("id").alias("way_id")), "way_id", "left_semi")
    members = osm.relation_members(rels).join(ids["relation"].select(F.col("id").alias("rel_id")), "rel_id", "left_semi")
    old, g, fresh = (f"{before}/geometries", f"{out}/geometries", f"{out}/changed/geometries")

    def replace(kind: str, name: str, rows: DataFrame) -> None:
        if not committed(spark, f"{g}/kind={kind}"):
            K.write_kind(rows, fresh, kind)
            kept = spark.read.parquet(f"{old}/kind={kind}").join(ids[name].select(F.col("id").alias("osm_id")), "osm_id", "left_anti")
            made = spark.read.parquet(f"{fresh}/kind={kind}")
            K.write_kind(kept.select(*made.columns).unionByName(made), g, kind)
    replace("n", "node", B.build_nodes(nodes.join(ids["node"], "id", "left_semi")))
    replace("w", "way", B.build_ways(refs, osm.way_tags(ways), nodes))
    replace("r", "relation", B.build_relations(members, osm.relation_tags(rels), nodes, spark.read.parquet(f"{g}/kind=w")))
    stored, made = spark.read.parquet(old), spark.read.parquet(fresh)
    gone = None
    for kind, name in (("n", "node"), ("w", "way"), ("r", "relation")):
        own = stored.where(F.col("kind") == kind).join(ids[name].select(F.col("id").alias("osm_id")), "osm_id", "left_semi")
        gone = own if gone is None else gone.unionByName(own)
    K.update_index(spark, f"{before}/cell_index", gone, made, f"{out}/changed/cell_index")
    K.update_tag_index(spark, f"{before}/tag_index", gone, made, f"{out}/changed/tag_index")
    return {"geometries": g, "cell_index": f"{before}/cell_index", "tag_index": f"{before}/tag_index"}


def _write_block_extracts(spark: SparkSession, sf_dir: str, base: str) -> str:
    """The street blocks as extracts below ``base``, written once."""
    for region, tables in FX.block_extracts(spark, sf_dir).items():
        for kind, rows in tables.items():
            path = osm.extract_paths(f"{base}/extracts", [region], kind)[0]
            if not committed(spark, path):
                rows.write.mode("overwrite").parquet(path)
    return f"{base}/extracts"


def grown_store(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The first extract of the blocks ingested alone, the second one added to it."""
    base = table_path(spark, "orbis", _input_key(spark, sf_dir), "regions")
    first, second = FX.BLOCK_REGIONS
    with _LOCK:
        root = _write_block_extracts(spark, sf_dir, base)
        ingest_extracts(spark, root, [first], f"{base}/first")
        if not committed(spark, f"{base}/grown/done"):
            add_region(spark, root, second, f"{base}/first", f"{base}/grown")
            spark.range(1).write.mode("overwrite").parquet(f"{base}/grown/done")
    return {"geometries": f"{base}/grown/geometries", **{t: f"{base}/first/{t}" for t in ("cell_index", "tag_index")}}


def region_store(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Two overlapping extracts of the street blocks (``FX.block_extracts``), written below the shared
    folder once per input and ingested from there."""
    base = table_path(spark, "orbis", _input_key(spark, sf_dir), "regions")
    with _LOCK:
        return ingest_extracts(spark, _write_block_extracts(spark, sf_dir, base), list(FX.BLOCK_REGIONS), f"{base}/store")


# the steps that each stored thing rests on
_KINDS = ("kind=n", "kind=w", "kind=r")
_NEEDS = {None: (*_KINDS, "cell_index", "tag_index"), "kind=n": ("kind=n",), "kind=w": ("kind=w",),
          "kind=r": ("kind=w", "kind=r"), "geometries": _KINDS, "cell_index": (*_KINDS, "cell_index"),
          "tag_index": (*_KINDS, "tag_index")}


def write_store(spark: SparkSession, paths: dict[str, str], raw_nodes: DataFrame, refs: DataFrame,
                way_tags: DataFrame, members: DataFrame, relation_tags: DataFrame, upto: str | None = None) -> None:
    """The steps of an ingest (all, or those that ``upto`` rests on), each skipped if it is already there."""
    g, steps = paths["geometries"], _NEEDS[upto]
    if "kind=n" in steps and not committed(spark, f"{g}/kind=n"):
        K.write_kind(B.build_nodes(raw_nodes), g, "n")
    if "kind=w" in steps and not committed(spark, f"{g}/kind=w"):
        K.write_kind(B.build_ways(refs, way_tags, raw_nodes), g, "w")
    if "kind=r" in steps and not committed(spark, f"{g}/kind=r"):
        ways = spark.read.parquet(f"{g}/kind=w")
        K.write_kind(B.build_relations(members, relation_tags, raw_nodes, ways), g, "r")
    if "cell_index" in steps and not committed(spark, paths["cell_index"]):
        K.write_cells(spark.read.parquet(g), paths["cell_index"])
    if "tag_index" in steps and not committed(spark, paths["tag_index"]):
        K.write_tag_index(B.build_tag_index(spark.read.parquet(g)), paths["tag_index"])


def use(spark: SparkSession, sf_dir: str, paths: dict[str, str]) -> None:
    """Point later queries on ``sf_dir`` at an ingest written elsewhere."""
    _CACHE[(spark.sparkContext.applicationId, sf_dir)] = paths


_STEPS = {"stats": ingest_stats, "localities": ingest_stats}
_READ = {"cell_index": K.read_index, "tag_index": K.read_tag_index, "stats": K.read_stats}


def _path(spark: SparkSession, sf_dir: str, name: str) -> str:
    paths = _CACHE.setdefault((spark.sparkContext.applicationId, sf_dir), {})
    if name in _KINDS and "geometries" in paths:
        return f"{paths['geometries']}/{name}"
    if name not in paths:
        paths.update(_STEPS[name](spark, sf_dir) if name in _STEPS else ingest_geometries(spark, sf_dir, upto=name))
    return paths[name]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored table as a DataFrame, read once per session (file listing and
    Parquet footers are not re-read by every query)."""
    with _LOCK:                       # one ingest per input, even from threads
        path = _path(spark, sf_dir, name)
        key = (spark.sparkContext.applicationId, sf_dir, path)
        if key not in _FRAMES:
            _FRAMES[key] = _READ.get(name, lambda s, p: s.read.parquet(p))(spark, path)
        return _FRAMES[key]


def geometry_store(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(geometries, cell_index)`` for ``sf_dir`` -- every stored geometry and its
    cells -- ingesting first if needed."""
    return geometries(spark, sf_dir), cell_index(spark, sf_dir)


def geometries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stored geometry; the indexes are not needed for it."""
    return _table(spark, sf_dir, "geometries")


def geometries_of(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The stored geometries of one kind (n, w or r), with their ``kind``."""
    return _table(spark, sf_dir, f"kind={kind}").withColumn("kind", F.lit(kind))


def stats_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored statistics."""
    return _table(spark, sf_dir, "stats").drop("bucket")


def localities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored locality dictionary ``(id, name)``."""
    return _table(spark, sf_dir, "localities")


def merged_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 on a table of its own, from files (S4-S6): the statistics up to a year, then a later
    delivery over them (the cities of one region, from that year on, with new values).  Merging
    again changes nothing, so the table is kept below the shared folder."""
    base = table_path(spark, "orbis", _input_key(spark, sf_dir), "upsert")
    deliveries = {"names": FX.names(spark, sf_dir),
                  "first": FX.stat_csv(spark, sf_dir).where(F.col("TIME") <= str(P.UPSERT["until"])),
                  "later": FX.later_delivery(spark, sf_dir, P.UPSERT["region"], P.UPSERT["until"])}
    with _LOCK:
        if not committed(spark, f"{base}/merged"):
            for name, rows in deliveries.items():
                rows.write.mode("overwrite").option("header", True).csv(f"{base}/csv/{name}")
            names = stats_files.read_names(spark, f"{base}/csv/names")
            first, later = (stats_files.read_stat_csv(spark, f"{base}/csv/{d}") for d in ("first", "later"))
            K.load_stats(spark, first, names, f"{base}/stats")
            K.merge_stats(spark, f"{base}/stats", stat_facts(later, names), f"{base}/merged")
    return K.read_stats(spark, f"{base}/stats").drop("bucket")


def tag_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "tag_index")


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entries of the cell index packed (``packed_index``), or in order, numbered
    (``build.numbered_postings``), written once."""
    packed = packed_index(spark, sf_dir)
    if packed is not None:
        return packed
    flat = cell_index(spark, sf_dir)
    path = f"{_CACHE[(spark.sparkContext.applicationId, sf_dir)]['cell_index']}-numbered"
    with _LOCK:
        if not committed(spark, path):
            B.numbered_postings(flat).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def packed_index(spark: SparkSession, sf_dir: str) -> DataFrame | None:
    """The entries of the cell index packed (``build.pack_index``), written once; none if some entry cannot be packed."""
    flat = cell_index(spark, sf_dir)
    path = f"{_CACHE[(spark.sparkContext.applicationId, sf_dir)]['cell_index']}-packed"
    with _LOCK:
        if not committed(spark, path):
            B.pack_index(flat).write.mode("overwrite").options(**K.INDEX_OPTIONS).parquet(path)
    packed = spark.read.parquet(path)
    return packed if B.is_packed(packed) else None


def documents_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Where a document made from ``sf_dir`` is written: a folder for each call."""
    return table_path(spark, "orbis", _input_key(spark, sf_dir), "documents", f"{name}-{uuid.uuid4().hex[:12]}")


def cell_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "cell_index")
