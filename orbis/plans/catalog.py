"""Registered queries: name → ``fn(spark, sf_dir) -> DataFrame``.

Each one reads the driver tables under ``sf_dir`` whole, derives the
OSM-like inputs from them (``orbis.sources.fixtures``) and runs one of the
engine's operators.  Parameters live in ``orbis.plans.params`` and are the
same ones the SQL oracle uses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbis.functions import codec as CD
from orbis.functions import geohash as GH
from orbis.functions import geometry as GM
from orbis.functions.parse import WAY_PREFIX, get_stat, prefixed_id, region_from_url, url_parent
from orbis.operators import build as B
from orbis.operators import lookup as LK
from orbis.operators import spatial as SP
from orbis.operators import statistics as ST
from orbis.plans import params as P
from orbis.plans.store import (cell_index, documents_path, geometries, geometries_of, geometry_store, grown_store,
                               localities, merged_stats, packed_index, postings, region_store, stats_table, tag_index)
from orbis.sinks import export as EX
from orbis.sinks import tables as K
from orbis.sources import fixtures as FX
from orbis.sources import osm


class Inputs:
    """The OSM-like inputs derived from the driver tables under ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.raw_nodes = FX.raw_nodes(spark, sf_dir)
        self.refs = FX.way_refs(spark, sf_dir)
        self.way_tags = FX.way_tags(spark, sf_dir)
        self.members = FX.relation_members(spark, sf_dir)
        self.relation_tags = FX.relation_tags(spark, sf_dir)

    def nodes(self) -> DataFrame:
        return B.build_nodes(self.raw_nodes)

    def ways(self) -> DataFrame:
        return B.build_ways(self.refs, self.way_tags, self.raw_nodes)

    def relations(self, polygons: bool = True) -> DataFrame:
        return B.build_relations(self.members, self.relation_tags, self.raw_nodes,
                                 self.ways(), polygons)

    def geometries(self, polygons: bool = True) -> DataFrame:
        return B.build_geometries(self.raw_nodes, self.refs, self.way_tags, self.members,
                                  self.relation_tags, polygons)


def _round6(c):
    return F.round(c, 6)


def _geometry_summary(df: DataFrame, index: DataFrame, kind: str, **more) -> DataFrame:
    """Scalar view of stored geometry rows of one kind for value comparison, with ``more`` columns; the cells
    come from the stored index, so the index is checked against the cover.  Ids begin with
    their kind: cells of other kinds are left out before any are grouped.  The columns are made
    before the rows meet their cells, so that parts and tags are not shuffled."""
    own = df.select(
        "id", "class", "wkt",
        _round6(F.col("centroid.x")).alias("cx"), _round6(F.col("centroid.y")).alias("cy"),
        F.col("envelope.minx").alias("minx"), F.col("envelope.miny").alias("miny"),
        F.col("envelope.maxx").alias("maxx"), F.col("envelope.maxy").alias("maxy"),
        F.col("cover.L").alias("cover_len"), *[c.alias(name) for name, c in more.items()])
    return B.with_cells(own, index.where(F.col("id").startswith(kind)))


def _stored(spark, sf_dir, kind: str) -> DataFrame:
    return geometries_of(spark, sf_dir, kind)


# ------------------------------------------------------------ geometries
# The steps of the ingest (nodes, ways, relations, indexes) run once per input, when a query first
# reads what they make, and are written to the shared folder (orbis.plans.store).

def q_nodes(spark, sf_dir):
    """E10 nodes: P1, F1, F2, F10, P7."""
    n = _stored(spark, sf_dir, "n").select(
        "id", "class", "wkt", F.col("centroid.x").alias("x"), F.col("centroid.y").alias("y"),
        F.col("tags")["place"].alias("place"), F.col("tags")["brand"].alias("brand"))
    return GH.with_geohash(n, "x", "y", "cell").select(
        "id", "class", "wkt", "x", "y", "cell", "place", "brand")


def q_ways(spark, sf_dir):
    """E10 ways: J1, A1, F3–F9, P2, P9 (+ their index cells, E9)."""
    w = _geometry_summary(_stored(spark, sf_dir, "w"), cell_index(spark, sf_dir), "w",
                          n_points=F.size(F.get("parts", 0)["pts"]), priority=F.col("tags")["priority"],
                          status=F.col("tags")["status"])
    return w.select("id", "class", "n_points", "wkt", "cx", "cy", "minx", "miny", "maxx", "maxy", "cover_len",
                    "n_cells", "cells", "priority", "status")


def q_relations(spark, sf_dir):
    """E10 relations built as collections: P8, J2, J3, A2, F17, F20, P16."""
    r = _stored(spark, sf_dir, "r").where(F.col("class") == "gc")
    r = _geometry_summary(r, cell_index(spark, sf_dir), "r", rel_type=F.col("tags")["type"],
                          name=F.col("tags")["name"], n_parts=F.size("parts"))
    return r.select("id", "class", "rel_type", "name", "n_parts", "wkt",
                    "cx", "cy", "minx", "miny", "maxx", "maxy", "cover_len", "n_cells", "cells")


def block_relations(spark, sf_dir) -> DataFrame:
    """The street blocks' relations, built by the same steps as the stored ones."""
    nodes = FX.block_nodes(spark, sf_dir)
    raw_ways, raw_rels = FX.block_ways(spark, sf_dir), FX.block_relations(spark, sf_dir)
    ways = B.build_ways(osm.way_refs(raw_ways), osm.way_tags(raw_ways), nodes)
    return B.build_relations(osm.relation_members(raw_rels), osm.relation_tags(raw_rels), nodes, ways)


def q_relation_rings(spark, sf_dir):
    """V3 + F19 + O3: multipolygon/boundary relations as polygon faces: the stored ones (closed
    member ways) and the street blocks (faces of open lines, with dangles, bridges and gardens)."""
    g = _stored(spark, sf_dir, "r").where(F.col("class") == "pl").select(*B.GEOMETRY_COLUMNS)
    r = g.unionByName(block_relations(spark, sf_dir).select(*B.GEOMETRY_COLUMNS))
    c = F.col("cover")
    return r.select("id", "class", F.col("tags")["type"].alias("rel_type"), F.size("parts").alias("n_rings"), "wkt",
                    _round6(F.col("centroid.x")).alias("cx"), _round6(F.col("centroid.y")).alias("cy"),
                    *[F.col(f"envelope.{e}").alias(e) for e in ("minx", "miny", "maxx", "maxy")],
                    c["L"].alias("cover_len"), GH.grid_size(c).cast("int").alias("n_cells"))


def q_overlapping_regions(spark, sf_dir):
    """E10 for two overlapping extracts (S1-S3, S7, P6, K1-K3): every element once, as the extract
    listed last has it."""
    paths = region_store(spark, sf_dir)
    g = spark.read.parquet(paths["geometries"])
    tag = F.coalesce(*[F.col("tags")[k] for k in ("place", "highway", "name")])
    rows = g.select("id", "kind", "class", "wkt", tag.alias("tag"))
    return rows.groupBy("id", "kind", "class", "wkt", "tag").agg(F.count(F.lit(1)).cast("int").alias("n_rows"))


def q_added_region(spark, sf_dir):
    """K4 + K6: the cell index of one extract after another one was added to it, partition by partition."""
    flat = K.read_index(spark, grown_store(spark, sf_dir)["cell_index"])
    return flat.groupBy("cell").agg(F.count(F.lit(1)).alias("n_ids"), F.min("id").alias("min_id"),
                                    F.max("id").alias("max_id"), F.round(F.sum("maxx"), 6).alias("east"))


def q_cell_index(spark, sf_dir):
    """P4 + U1 + A3 -- per cell, how many geometries and the id range.
    Counted by partial aggregation, so a hot cell never sits in one task."""
    return B.cell_ranges(cell_index(spark, sf_dir))


# ------------------------------------------------------------ spatial

def _pick(values, idx):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def search_points(spark, sf_dir):
    """Supplier points, each with its own search: tag and radius vary with
    the key so all cover lengths and geometry kinds take part."""
    a = P.FIND_BY_TAGS
    q = F.col("qid")
    n_s, n_r = len(a["searches"]), len(a["radii_m"])
    return FX.query_points(spark, sf_dir).select(
        "qid", "lon", "lat",
        _pick([k for k, _ in a["searches"]], q % n_s).alias("key"),
        _pick([v for _, v in a["searches"]], q % n_s).alias("value"),
        _pick(a["radii_m"], (q / n_s).cast("long") % n_r).alias("meters"))


def q_find_by_tags(spark, sf_dir):
    """E1 for every supplier point at once: J7 + F11 + F13 + P11."""
    g = geometries(spark, sf_dir)
    return SP.find_ids_by_tags(g, tag_index(spark, sf_dir), search_points(spark, sf_dir), op=P.FIND_BY_TAGS["op"])


def q_find_by_tags_not(spark, sf_dir):
    """E1 as coded (Q1, ``!=``): geometries around every supplier point whose tag is there and differs."""
    a = P.FIND_BY_TAGS_NOT
    g = geometries(spark, sf_dir)
    r = SP.find_by_tags(g, None, FX.query_points(spark, sf_dir), a["key"], a["value"], a["meters"], op=a["op"],
                        tag_index=tag_index(spark, sf_dir))
    return r.select("qid", "id", "kind", "class", "wkt")


def q_find_by_stats(spark, sf_dir):
    """Samples (distance to centroid, value of the year) around every
    supplier point: J7 + P12 + P17 + F12."""
    a = P.FIND_BY_STATS
    g, idx = geometry_store(spark, sf_dir)
    r = SP.find_by_stats(g, idx, stats_table(spark, sf_dir),
                         FX.query_points(spark, sf_dir), a["indicator"], a["year"], a["meters"])
    return r.select("qid", "id", _round6(F.col("distance_km")).alias("distance_km"), "value")


def q_interpolate(spark, sf_dir):
    """Inverse-distance weighted value at every supplier point."""
    a = P.INTERPOLATE
    g, idx = geometry_store(spark, sf_dir)
    r = SP.interpolate(g, idx, stats_table(spark, sf_dir),
                       FX.query_points(spark, sf_dir), a["indicator"], a["year"], a["meters"],
                       a["power"])
    return r.select("qid", "lon", "lat", _round6(F.col("value")).alias("value"), "n_samples")


def _density_out(d):
    return d.select("cell", "n", _round6(F.col("x")).alias("x"), _round6(F.col("y")).alias("y"))


def q_density(spark, sf_dir):
    """Centroids of all geometries counted per 4-character cell."""
    g = geometries(spark, sf_dir)
    return _density_out(SP.density(g, P.DENSITY["length"]))


def q_clusters(spark, sf_dir):
    """Tagged nodes grouped into 3-character cells with a label point."""
    return _density_out(SP.density(_stored(spark, sf_dir, "n"), P.CLUSTERS["length"]))


def q_radius_clusters(spark, sf_dir):
    """Clusters of all geometries within a pixel radius, at several zoom levels."""
    g = geometries(spark, sf_dir)
    c = SP.radius_clusters(g, P.RADIUS_CLUSTERS["zooms"], P.RADIUS_CLUSTERS["radius"])
    return c.select("zoom", "gx", "gy", "n", "n_cells", F.round("x", 5).alias("x"), F.round("y", 5).alias("y"))


def q_heat_surface(spark, sf_dir):
    """Heat of all geometries over the pixel cells around them."""
    g = geometries(spark, sf_dir)
    h = SP.heat_surface(g, P.HEAT["zooms"], P.HEAT["radius"], P.HEAT["size"])
    return h.select("zoom", "gx", "gy", F.round("heat", 6).alias("heat"))


# ------------------------------------------------------------ lookups, exports

def q_locality_geometries(spark, sf_dir):
    """S8 + J5 + J8 + F16: the geometry of every named locality, looked up
    by id in the ingested table, with its name and SHA-1 row key."""
    g = geometries(spark, sf_dir)
    names = localities(spark, sf_dir)
    r = LK.with_names(LK.get_geometries(g, names), names)
    return r.select("id", "name", "class", _round6(F.col("centroid.x")).alias("cx"),
                    _round6(F.col("centroid.y")).alias("cy"), F.sha1("id").alias("key"))


def q_get_filtered(spark, sf_dir):
    """Keyed lookup with a row filter: member ways of localities that are lines, by their ids."""
    g = _stored(spark, sf_dir, "w")
    names = localities(spark, sf_dir).select(F.substring("id", 2, 20).cast("long").alias("k"))
    own = FX.table(spark, sf_dir, "orders").join(names, F.col("o_custkey") == F.col("k"))
    ids = own.select(prefixed_id(WAY_PREFIX, "o_orderkey").alias("id"))
    return LK.get_filtered(g, ids, F.col("class") == "ls").select("id", "class", "wkt")


def q_index_prefix_scan(spark, sf_dir):
    """S10 + O2: index rows under a set of cell prefixes (on a stored index
    the range bounds and the OR of prefix filters reach the Parquet scan)."""
    return LK.scan_index_by_prefixes(cell_index(spark, sf_dir),
                                      P.INDEX_PREFIXES).select("cell", "id")


def q_cell_postings(spark, sf_dir):
    """A3 grouped index (posting lists by cell and chunk), read back flat: every
    (cell, id) exactly once."""
    grouped = B.group_index(cell_index(spark, sf_dir), P.POSTING_CHUNKS, packed_index(spark, sf_dir))
    return grouped.select("cell", F.explode("ids").alias("id"))


def q_posting_blocks(spark, sf_dir):
    """A3 + E9 as lists: each cell's ids in blocks of bounded length, with their smallest and largest id."""
    b = B.posting_blocks(postings(spark, sf_dir), P.POSTING_BLOCK)
    return b.select("cell", "block", F.array_join("ids", " ").alias("ids"), "n_ids", "min_id", "max_id")


def q_wkt_roundtrip(spark, sf_dir):
    """F8 read: every stored geometry's WKT parsed back to parts; its envelope
    and point count must be those of the geometry."""
    g = geometries(spark, sf_dir)
    w = g.select("id", GM.wkt_to_parts("wkt").alias("p"))
    w = w.select("id", F.col("p.class").alias("class"), F.col("p.parts").alias("parts"))
    e = GM.envelope("parts")
    n = F.aggregate("parts", F.lit(0).cast("long"), lambda acc, p: acc + F.size(p["pts"]))
    return w.select("id", "class", n.alias("n_points"),
                    e["minx"].alias("minx"), e["miny"].alias("miny"),
                    e["maxx"].alias("maxx"), e["maxy"].alias("maxy"))


def geometry_texts(spark, sf_dir) -> DataFrame:
    """WKT of every type, one per order, from its line items as points: by key modulo 7 one of the simple
    types or a nested collection; with a reference system, empty or broken by other remainders."""
    li = FX.table(spark, sf_dir, "lineitem")
    xy = F.concat_ws(" ", (F.col("l_partkey") % 1000).cast("string"), F.col("l_suppkey").cast("string"))
    own = li.groupBy(F.col("l_orderkey").alias("k")).agg(F.array_sort(F.collect_list(
        F.struct("l_linenumber", "l_partkey", "l_suppkey", xy.alias("xy")))).alias("rows"))
    k = F.col("k")
    p = own.select("k", F.transform("rows", lambda r: r["xy"]).alias("p"))
    pts, first = F.array_join("p", ", "), F.get("p", 0)
    ring = F.concat(F.lit("("), pts, F.lit(", "), first, F.lit(")"))
    said = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    multipoint = F.when(k % 2 == 0, said("MULTIPOINT (", pts, ")")).otherwise(
        said("MULTIPOINT ((", F.array_join("p", "), ("), "))"))
    polygons = said("MULTIPOLYGON ((", ring, "), (", ring, ", ", ring, "))")
    nested = said("GEOMETRYCOLLECTION (POINT (", first, "), GEOMETRYCOLLECTION (LINESTRING (", pts, "), ", multipoint,
                  ", GEOMETRYCOLLECTION (POLYGON (", ring, "), POINT EMPTY)), ", polygons, ")")
    kinds = [said("Point(", first, ")"), said("LINESTRING (", pts, ")"), said("POLYGON (", ring, ",", ring, ")"),
             multipoint, said("multilinestring ((", pts, "), (", pts, "))"), polygons, nested]
    text = _pick_column(kinds, k % 7)
    text = F.when(k % 13 == 0, said("POINT (abc ", first, ")")).when(k % 17 == 0, "MULTILINESTRING EMPTY") \
        .when(k % 5 == 0, said("SRID=4326;", text)).otherwise(text)
    return p.select("k", text.alias("text"))


def _pick_column(values, at):
    out = F.when(at == 0, values[0])
    for i, v in enumerate(values[1:], 1):
        out = out.when(at == i, v)
    return out


def q_wkt_geojson(spark, sf_dir):
    """F5 + F8, all types and nested collections: WKT -> GeoJSON -> WKT, class code and parts."""
    t = geometry_texts(spark, sf_dir).select("k", GM.read_wkt("text").alias("g")).select("k", "g.*")
    n = F.aggregate("parts", F.lit(0).cast("long"), lambda acc, p: acc + F.size(p["pts"]))
    return t.select("k", "class", "geojson", CD.geojson_to_wkt("geojson").alias("wkt"),
                    F.array_join(F.transform("parts", lambda p: p["t"]), " ").alias("kinds"), n.alias("n_points"))


def locality_candidates(spark, sf_dir):
    a = P.FIRST_MATCH
    c = FX.table(spark, sf_dir, "customer")
    n = FX.table(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("n_name").alias("name"), F.col("c_custkey").alias("osm_id"),
        ((F.col("c_custkey") * a["rank_mul"]) % a["rank_mod"]).alias("rank"))


def q_locality_first_match(spark, sf_dir):
    """First search result per locality name, skipping names already
    resolved (resume = anti join)."""
    n = FX.table(spark, sf_dir, "nation")
    done = n.where(F.col("n_regionkey") == P.FIRST_MATCH["done_region"]) \
        .select(F.col("n_name").alias("name"))
    return LK.first_match(locality_candidates(spark, sf_dir), done=done)


def q_url_regions(spark, sf_dir):
    """F21 + S7: region name and parent path of every page URL and of the download URLs of a manifest
    (one extract per nation, numbered below zero)."""
    p = FX.table(spark, sf_dir, "pages").select("page_id", "url")
    urls = p.unionByName(FX.extract_urls(spark, sf_dir))
    return urls.select("page_id", "url", region_from_url("url").alias("region"), url_parent("url").alias("parent"))


def q_stat_json(spark, sf_dir):
    """K7: one JSON line per city, ``{city: {stat: {year: value}}}`` (E7
    shape); rows-only check (JSON text)."""
    a = P.STAT_JSON
    return EX.range_json(ST.range_map(stats_table(spark, sf_dir), a["indicators"],
                                      a["start"], a["end"], ids=localities(spark, sf_dir)))


def q_interpolation_geojson(spark, sf_dir):
    """K8 + P18: GeoJSON features -- interpolated supplier points
    (inferred) and the observed localities (not inferred)."""
    a = P.INTERPOLATE
    g, idx = geometry_store(spark, sf_dir)
    stats = stats_table(spark, sf_dir)
    pts = FX.query_points(spark, sf_dir)
    est = SP.interpolate(g, idx, stats, pts, a["indicator"], a["year"], a["meters"], a["power"])
    obs = SP.join_geometries(SP.stat_samples(stats, a["indicator"], a["year"]),
                             g.select("kind", "id", "centroid")).select(
        "id", F.col("centroid.x").alias("lon"), F.col("centroid.y").alias("lat"), "value")
    est, obs = (d.withColumns({c: _round6(F.col(c)) for c in ("lon", "lat", "value")}) for d in (est, obs))
    return EX.point_features(est, "qid", "lon", "lat", "value", True).unionByName(
        EX.point_features(obs, "id", "lon", "lat", "value", False))


def _document(spark, sf_dir, name, write) -> DataFrame:
    path = documents_path(spark, sf_dir, name)
    write(path, f"{path}-staged")
    return EX.read_document(spark, path).select("line")


def q_geojson_document(spark, sf_dir):
    """K8 as one FeatureCollection: the lines of its part files."""
    features = q_interpolation_geojson(spark, sf_dir)
    return _document(spark, sf_dir, "features", lambda path, staging: EX.write_features(features, path, staging))


def q_stat_document(spark, sf_dir):
    """K7 for E5 as one document with all passing cities."""
    a = P.STAT_FROM_ALL
    rows = q_stat_from_all(spark, sf_dir)
    return _document(spark, sf_dir, "stat_from_all", lambda path, staging: EX.write_stat_from_all(
        rows, a["indicator"], a["op"], a["threshold"], a["year"], path, staging))


def q_range_document(spark, sf_dir):
    """K7 for E7 as one object of all cities."""
    lines = q_stat_json(spark, sf_dir)
    return _document(spark, sf_dir, "ranges", lambda path, staging: EX.write_object(lines, path, staging))


def q_compare_document(spark, sf_dir):
    """K7 for E4 as one object: each city's values and geometry."""
    g = geometries(spark, sf_dir)
    rows = ST.multi_compare_stat(stats_table(spark, sf_dir), P.MULTI_COMPARE["indicator"],
                                 ids=localities(spark, sf_dir), geometries=g)
    return _document(spark, sf_dir, "compare", lambda path, staging: EX.write_object(EX.compare_json(rows), path, staging))


# ------------------------------------------------------------ statistics

def q_stat_series(spark, sf_dir):
    return stats_table(spark, sf_dir).select(
        "id", "name", "indicator", "year", "value", "value_raw")


def q_stats_upsert(spark, sf_dir):
    """K5 + E11: a later delivery merged over the stored statistics, bucket by bucket."""
    return merged_stats(spark, sf_dir).select("id", "name", "indicator", "year", "value", "value_raw")


def q_stat_maps(spark, sf_dir):
    """A5 + F18: each city's statistics as map of lists, and one indicator read from it."""
    m = ST.stat_maps(stats_table(spark, sf_dir))
    one = get_stat("stats", P.MULTI_COMPARE["indicator"])
    years = F.map_entries(one)
    return m.select("id", "name", F.size("stats").alias("n_indicators"), F.size(one).alias("n_years"),
                    F.array_join(F.transform(F.array_sort(years), lambda e: F.concat_ws("=", e["key"].cast("string"),
                                                                                         GM.fmt_num(e["value"]))), " ").alias("series"))


def q_stat_from_all(spark, sf_dir):
    a = P.STAT_FROM_ALL
    return ST.stat_from_all(stats_table(spark, sf_dir), a["indicator"], a["op"],
                            a["threshold"], a["year"])


def q_stat_from_all_equal(spark, sf_dir):
    a = P.STAT_FROM_ALL_EQUAL
    return ST.stat_from_all(stats_table(spark, sf_dir), a["indicator"], a["op"], a["threshold"], a["year"])


def q_stat_from_all_first_year(spark, sf_dir):
    a = P.STAT_FROM_ALL_FIRST_YEAR
    return ST.stat_from_all(stats_table(spark, sf_dir), a["indicator"], a["op"],
                            a["threshold"], a["year"])


def q_multi_compare_stat(spark, sf_dir):
    """E4, with each city's ordered list exploded to (pos, year, value) so
    the order itself is compared; cities without data keep one null row."""
    out = ST.multi_compare_stat(stats_table(spark, sf_dir), P.MULTI_COMPARE["indicator"],
                                ids=localities(spark, sf_dir))
    return out.select("city_id", "city", F.posexplode_outer("series").alias("pos", "s")) \
        .select("city_id", "city", "pos", F.col("s.year").alias("year"),
                F.col("s.value").alias("value"))


def q_compare_with_geometry(spark, sf_dir):
    """E4 with each city's geometry (the compare sample carries WKT): how
    many values each city has, their sum, and its geometry text."""
    g = geometries(spark, sf_dir)
    out = ST.multi_compare_stat(stats_table(spark, sf_dir), P.MULTI_COMPARE["indicator"],
                                ids=localities(spark, sf_dir), geometries=g)
    return out.select("city_id", "city", F.size("values").alias("n_values"),
                      _round6(F.aggregate("values", F.lit(0.0), lambda a, v: a + v))
                      .alias("total"), "wkt")


def q_stat_in_range(spark, sf_dir):
    a = P.STAT_IN_RANGE
    return ST.stat_in_range(stats_table(spark, sf_dir), a["indicator"], a["start"], a["end"])


def q_stats_in_range(spark, sf_dir):
    a = P.STATS_IN_RANGE
    return ST.stats_in_range(stats_table(spark, sf_dir), a["indicators"], a["start"], a["end"],
                             ids=localities(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "nodes": q_nodes,
    "ways": q_ways,
    "relations": q_relations,
    "relation_rings": q_relation_rings,
    "overlapping_regions": q_overlapping_regions,
    "added_region": q_added_region,
    "cell_index": q_cell_index,
    "find_by_tags": q_find_by_tags,
    "find_by_tags_not": q_find_by_tags_not,
    "find_by_stats": q_find_by_stats,
    "interpolate": q_interpolate,
    "density": q_density,
    "clusters": q_clusters,
    "radius_clusters": q_radius_clusters,
    "heat_surface": q_heat_surface,
    "get_filtered": q_get_filtered,
    "locality_geometries": q_locality_geometries,
    "index_prefix_scan": q_index_prefix_scan,
    "cell_postings": q_cell_postings,
    "posting_blocks": q_posting_blocks,
    "wkt_roundtrip": q_wkt_roundtrip,
    "wkt_geojson": q_wkt_geojson,
    "locality_first_match": q_locality_first_match,
    "url_regions": q_url_regions,
    "stat_json": q_stat_json,
    "interpolation_geojson": q_interpolation_geojson,
    "geojson_document": q_geojson_document,
    "stat_document": q_stat_document,
    "range_document": q_range_document,
    "compare_document": q_compare_document,
    "stat_series": q_stat_series,
    "stats_upsert": q_stats_upsert,
    "stat_maps": q_stat_maps,
    "stat_from_all": q_stat_from_all,
    "stat_from_all_equal": q_stat_from_all_equal,
    "stat_from_all_first_year": q_stat_from_all_first_year,
    "multi_compare_stat": q_multi_compare_stat,
    "compare_with_geometry": q_compare_with_geometry,
    "stat_in_range": q_stat_in_range,
    "stats_in_range": q_stats_in_range,
}

FLAGSHIP = "stat_from_all_first_year"
