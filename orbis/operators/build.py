"""Ingestion: raw OSM tables → one ``geometries`` table + cell index
(E9, E10, P1–P9, P16, J1–J3, A1–A3, A10, F3–F10, F17, F20, U1).

``geometries`` columns::

    kind string (n | w | r), id string (n12, w7, r3), osm_id long,
    class string (p | ls | pl | gc), parts (see functions.geometry),
    wkt string, centroid struct<x,y>, envelope struct<minx,miny,maxx,maxy>,
    tags map<string,string>,
    cover struct<L,c0,c1,r0,r1,fx,fy>   (the geohash cover grid; see functions.geohash)

Way assembly is one shuffle join (references × nodes on the *long* node
id) and one aggregation keyed by way id; order inside a way is made in the
group (``array_sort`` on the reference index), never taken from a global
sort.  Relations join their members on (member type, id), so way 5 can
never pick up node 5, and are grouped once for collections and polygons alike.  Only
relations whose faces must be traced go through Python (``rings.polygon_parts``, an Arrow UDF).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orbis.functions import geohash as GH
from orbis.functions import geometry as GM
from orbis.functions.common import col_of
from orbis.functions.parse import (NODE_PREFIX, RELATION_PREFIX, WAY_PREFIX, prefixed_id,
                                   relation_type, tag_map)
from orbis.operators.rings import polygon_parts

# Relation types that are kept, and those built as polygons.
VALID_RELATION_TYPES = ("multipolygon", "route", "boundary", "site",
                        "public_transport", "street", "waterway")
POLYGON_RELATION_TYPES = ("multipolygon", "boundary")

GEOMETRY_COLUMNS = ("kind", "id", "osm_id", "class", "parts", "wkt", "centroid",
                    "envelope", "tags", "cover")


def _finish(df: DataFrame, kind: str, prefix: str) -> DataFrame:
    """Add the derived geometry columns to ``(osm_id, class, parts, tags)``."""
    df = df.withColumn("envelope", GM.envelope("parts")) \
        .where(F.col("envelope").isNotNull())               # Q9: empty → dropped
    df = GH.with_cover_grid(GM.with_centroid(df), "envelope")
    return df.select(F.lit(kind).alias("kind"), prefixed_id(prefix, "osm_id").alias("id"),
                     "osm_id", "class", "parts", GM.wkt("class", "parts").alias("wkt"),
                     "centroid", "envelope", tag_map("tags").alias("tags"),
                     "cover")


def node_points(raw_nodes: DataFrame) -> DataFrame:
    """All nodes as ``(node_id, x, y)`` -- untagged ones too, ways need them."""
    return raw_nodes.select(F.col("id").alias("node_id"), F.col("longitude").alias("x"),
                            F.col("latitude").alias("y"))


def build_nodes(raw_nodes: DataFrame) -> DataFrame:
    """E10 nodes (P1, P7, K1): only tagged nodes are stored; class ``p``, one
    12-character cell (a one-cell cover grid), WKT point, centroid = the
    point itself (Q22)."""
    n = raw_nodes.where(F.size("tags") > 0)
    x, y = F.col("longitude"), F.col("latitude")
    xi, yi = GH.lon_int(x), GH.lat_int(y)
    one = F.lit(1).cast("long")
    grid = F.struct(F.lit(GH.MAX_CELL_LENGTH).alias("L"), xi.alias("c0"), xi.alias("c1"),
                    yi.alias("r0"), yi.alias("r1"), one.alias("fx"), one.alias("fy"))
    return n.select(
        F.lit("n").alias("kind"), prefixed_id(NODE_PREFIX, "id").alias("id"),
        F.col("id").alias("osm_id"), F.lit("p").alias("class"),
        GM.point_parts(x, y).alias("parts"), GM.point_wkt(x, y).alias("wkt"),
        GM.point(x, y).alias("centroid"),
        F.struct(x.alias("minx"), y.alias("miny"), x.alias("maxx"), y.alias("maxy"))
        .alias("envelope"),
        tag_map("tags").alias("tags"), grid.alias("cover"))


def assemble_ways(refs: DataFrame, raw_nodes: DataFrame) -> DataFrame:
    """J1 + A1: ``(osm_id, pts array<struct<x,y>>)`` in reference order.

    References whose node is missing vanish (inner join).  A node shared by
    very many ways is a skewed join key; AQE's skew join splits it.  Order
    is made inside each way's group (Q5), so no global sort is needed (O1).
    Row-object ``map`` lambdas of the old code (V2) are column expressions."""
    j = refs.join(node_points(raw_nodes), "node_id")
    g = j.groupBy("way_id").agg(
        F.array_sort(F.collect_list(F.struct("idx", "x", "y"))).alias("r"))
    return g.select(F.col("way_id").alias("osm_id"),
                    F.transform("r", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
                    .alias("pts"))


def build_ways(refs: DataFrame, way_tags: DataFrame, raw_nodes: DataFrame) -> DataFrame:
    """E10 ways (P2, P9, F3–F9): closed with 4+ points → polygon, open with
    2+ → line, anything else is dropped.  Tags are joined back by way id
    after assembly (never grouped on)."""
    w = assemble_ways(refs, raw_nodes)
    w = w.withColumn("class", GM.way_class("pts")).where(F.col("class").isNotNull())
    w = w.select("osm_id", "class",
                 F.array(F.struct(F.col("class").alias("t"), F.col("pts").alias("pts")))
                 .alias("parts"))
    t = way_tags.select(F.col("id").alias("osm_id"), "tags")
    w = w.join(t, "osm_id", "left").withColumn(
        "tags", F.coalesce("tags", F.array().cast("array<struct<key:string,value:string>>")))
    return _finish(w, "w", WAY_PREFIX)


def typed_relations(relation_tags: DataFrame) -> DataFrame:
    """F17 + P8: ``(rel_id, rel_type, tags)`` of the relation types kept."""
    return relation_tags.select(F.col("id").alias("rel_id"),
                                relation_type("tags").alias("rel_type"), "tags") \
        .where(F.col("rel_type").isin(*VALID_RELATION_TYPES))


def member_geometries(raw_nodes: DataFrame, ways: DataFrame) -> DataFrame:
    """Geometries a member can point at: ``(member_type, member_id, parts)``."""
    nodes = raw_nodes.select(F.lit("Node").alias("member_type"),
                             F.col("id").alias("member_id"),
                             GM.point_parts("longitude", "latitude").alias("parts"))
    w = ways.select(F.lit("Way").alias("member_type"), F.col("osm_id").alias("member_id"),
                    "parts")
    return nodes.unionByName(w)


def resolved_members(members: DataFrame, relation_tags: DataFrame, raw_nodes: DataFrame,
                     ways: DataFrame) -> DataFrame:
    """P8 + J2 + J3 (+ P16, Q6): members of kept relations joined to their
    geometry on (type, id); relation members (type R…) are ignored, as are
    members whose geometry does not exist."""
    rel = typed_relations(relation_tags).select("rel_id", "rel_type")
    m = members.where(~F.col("member_type").startswith("R")).join(rel, "rel_id")
    return m.join(member_geometries(raw_nodes, ways), ["member_type", "member_id"])


def grouped_members(resolved: DataFrame) -> DataFrame:
    """A2: ``(rel_id, rel_type, parts)`` -- each relation's member parts in member order."""
    g = resolved.groupBy("rel_id", "rel_type").agg(
        F.array_sort(F.collect_list(F.struct("pos", "parts"))).alias("ms"))
    return g.select("rel_id", "rel_type", F.flatten(F.transform("ms", lambda e: e["parts"])).alias("parts"))


def build_relations(members: DataFrame, relation_tags: DataFrame, raw_nodes: DataFrame,
                    ways: DataFrame, polygons: bool = True) -> DataFrame:
    """E10 relations.  Members meet their geometry in one join and their relation in one
    aggregate, whatever the type: multipolygon and boundary become the largest polygon
    face of their lines (V3, F19, O3, see ``orbis.operators.rings``; without ``polygons`` they are
    left out), the others a geometry collection of their members, in member order (F20).
    Relations that close no ring vanish."""
    resolved = resolved_members(members, relation_tags, raw_nodes, ways)
    is_polygon = F.col("rel_type").isin(*POLYGON_RELATION_TYPES)
    if not polygons:
        resolved = resolved.where(~is_polygon)
    g = grouped_members(resolved)
    if polygons:
        rings = polygon_parts(F.when(is_polygon, F.col("parts")))
        g = g.withColumn("parts", F.when(is_polygon, rings).otherwise(F.col("parts"))) \
            .where(F.col("parts").isNotNull())
    g = g.select(F.col("rel_id").alias("osm_id"), F.when(is_polygon, "pl").otherwise("gc").alias("class"), "parts")
    t = relation_tags.select(F.col("id").alias("osm_id"), "tags")
    return _finish(g.join(t, "osm_id"), "r", RELATION_PREFIX)


def build_geometries(raw_nodes: DataFrame, refs: DataFrame, way_tags: DataFrame,
                     members: DataFrame, relation_tags: DataFrame,
                     polygons: bool = True) -> DataFrame:
    """E10 for all three kinds, as one table (U1 at the table level)."""
    nodes = build_nodes(raw_nodes)
    ways = build_ways(refs, way_tags, raw_nodes)
    rels = build_relations(members, relation_tags, raw_nodes, ways, polygons)
    cols = list(GEOMETRY_COLUMNS)
    return nodes.select(cols).unionByName(ways.select(cols)).unionByName(rels.select(cols))


# ------------------------------------------------------------------ index

INDEX_COLUMNS = ("cell", "id", "minx", "miny", "maxx", "maxy")


def build_index(*tables: DataFrame) -> DataFrame:
    """E9 flat (P4, U1): ``(cell, id, minx, miny, maxx, maxy)``, one row per
    cover cell of each stored geometry (Q19: only what is stored is
    indexed).  Cells are made from each cover grid by ``explode`` (codegen),
    not kept as arrays.  The geometry's envelope rides along, so a search can
    drop a candidate whose box is not inside the query box right after the
    cell join, before any shuffle."""
    parts = [GH.explode_grid(t.select("id", "cover", "envelope.*"), "cover")
             .select(*INDEX_COLUMNS) for t in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# parts that tag keys are dealt to in the tag index
TAG_PARTS = 4
TAG_INDEX_COLUMNS = ("key", "value", "cell", "id", "kind", "class", "minx", "miny", "maxx", "maxy", "sides")


def tag_part(key) -> Column:
    """The part of the tag index that holds a key (a function of the key alone, so that a search
    for any value, or for other values, reads one part)."""
    return F.pmod(F.xxhash64(col_of(key)), F.lit(TAG_PARTS)).cast("int")


def build_tag_index(geoms: DataFrame) -> DataFrame:
    """P11 + J7: ``(key, value, cell, id, kind, class, box, sides)``, one row for each tag of a stored
    geometry, under the first cell of its cover (a contained geometry is found by any of its
    cells, see ``with_anchor_cell``): what a search by tag needs to know, so that it reads neither the
    cells of other tags nor the geometry table, and finds no geometry twice.  ``sides``
    (``geometry.inner_sides``) tells of lines and collections whether a box is theirs whose edge they touch."""
    sides = F.when(~F.col("class").isin("p", "pl"), GM.inner_sides("envelope", "parts"))
    g = GH.with_anchor_cell(geoms.select("id", "kind", "class", "envelope.*", "cover", "tags", sides.alias("sides")), "cover")
    return g.select(*TAG_INDEX_COLUMNS[2:], F.explode("tags").alias("key", "value")).select(*TAG_INDEX_COLUMNS)


def cell_ranges(flat: DataFrame) -> DataFrame:
    """E9 counted: ``(cell, n_ids, min_id, max_id)`` (ids as texts).

    The smallest and largest text of a group can only be kept by sorting all rows, so ids of one
    letter and one length are compared as numbers first, in a hash table of a row for each cell, letter and
    length; texts are compared between these.  An id of another form is a group of its own."""
    letter, number = F.left("id", F.lit(1)), F.expr("substring(id, 2)").try_cast("long")
    plain = (number >= 0) & (F.concat(letter, number.cast("string")) == F.col("id"))
    own = flat.select("cell", F.when(plain, letter).otherwise(F.col("id")).alias("stem"),
                      F.length("id").alias("digits"), F.when(plain, number).alias("number"))
    few = own.groupBy("cell", "stem", "digits").agg(
        F.count(F.lit(1)).alias("n"), F.min("number").alias("lo"), F.max("number").alias("hi"))
    text = lambda n: F.concat("stem", F.coalesce(F.col(n).cast("string"), F.lit("")))
    return few.groupBy("cell").agg(F.sum("n").alias("n_ids"), F.min(text("lo")).alias("min_id"), F.max(text("hi")).alias("max_id"))


# ids in one block of a posting list
BLOCK_IDS = 1000


# what the last digits of an id may be, in the order of the texts: none, one, or two
TAILS = ["", *[d + e for d in "0123456789" for e in ["", *"0123456789"]]]


def head_width(flat: DataFrame) -> Column:
    """How many characters of an ``id`` are its head: the longest id of its first letter without two."""
    first, longest = F.left("id", F.lit(1)), F.max(F.length("id")).alias("n")
    sizes = {r.c: r.n for r in flat.groupBy(first.alias("c")).agg(longest).limit(100).collect() if r.c}
    most = max(sizes.values(), default=1) if len(sizes) < 90 else flat.agg(longest).first().n
    width = F.lit(max(most - 2, 1))
    if not 0 < len(sizes) < 90:
        return width
    own = F.create_map(*[F.lit(v) for c, n in sizes.items() for v in (c, max(n - 2, 1))])
    return F.coalesce(F.try_element_at(own, first), width)


def tail_slot(width) -> Column:
    """The place in ``TAILS`` of what follows the head of ``id``, null for other tails."""
    tail = F.substr("id", col_of(width) + 1)
    digits, at = F.when(F.translate(tail, "0123456789", "") == "", F.length(tail)), tail.try_cast("int")
    return F.when(digits == 0, 0).when(digits == 1, 1 + 11 * at).when(digits == 2, 2 + 11 * F.floor(at / 10) + at % 10).cast("int")


def pack_index(flat: DataFrame, width: Column | None = None) -> DataFrame:
    """Index entries by all but the last two digits of their ids: ``(cell, part, head, low, high, n)``.

    ``head`` are the first characters of an id, as many for all ids of one first letter; the bits of ``low`` and
    ``high`` say which of ``TAILS`` follow it in the cell, ``n`` counts the entries, ``part`` is the head without three
    more characters.  Heads in order, and tails in theirs, give the ids in order.  Packed rows are made by a
    partial aggregate, so entries of neighbouring ids are shuffled as one row.  See ``is_packed``."""
    own = flat.select("cell", "id", (head_width(flat) if width is None else width).alias("w"))
    one = lambda to: F.call_function("shiftleft", F.lit(1).cast("long"), to)
    bit = lambda of, to: F.coalesce(F.bit_or(F.when(of, one(to))), F.lit(0).cast("long"))
    own = own.select("cell", F.left("id", F.greatest(F.col("w") - 3, F.lit(1))).alias("part"), F.left("id", F.col("w")).alias("head"),
                     tail_slot("w").alias("slot"))
    s = F.col("slot")
    return own.groupBy("cell", "part", "head").agg(bit(s < 64, s).alias("low"), bit(s >= 64, s - 64).alias("high"),
                                                   F.count(F.lit(1)).alias("n"))


def is_packed(packed: DataFrame) -> bool:
    """Whether a packed index says all: every entry has a bit of its own (no id is null, occurs twice in a cell,
    or ends otherwise)."""
    whole = F.col("head").isNotNull() & (F.col("n") == F.bit_count("low") + F.bit_count("high"))
    return packed.where(~whole).isEmpty()


def _has(row: Column, slot: Column) -> Column:
    """Whether a packed row has the tail at ``slot``."""
    shifted = lambda c, by: F.call_function("shiftright", row[c], by)
    return F.when(slot < 64, shifted("low", slot)).otherwise(shifted("high", slot - 64)).bitwiseAND(F.lit(1)) == 1


def packed_ids(row: Column) -> Column:
    """The ids of a packed row, in order."""
    has = lambda s: _has(row, s)
    tails = F.array(*map(F.lit, TAILS))
    return F.transform(F.filter(F.sequence(F.lit(0), F.lit(len(TAILS) - 1)), has), lambda s: F.concat(row["head"], F.get(tails, s)))


def group_index(flat: DataFrame, chunks: int = 16, packed: DataFrame | None = None) -> DataFrame:
    """A3 grouped form ``(cell, chunk, ids)``: sorted posting lists, keyed by cell and
    chunk.  ``chunk`` is always a hash of the id modulo ``chunks``, so a hot cell (a
    whole city in one 3-character cell) is spread over that many groups and the index is read
    once; lists grow with the cell (``posting_blocks`` bounds them).  With the same entries ``packed``
    (``pack_index``, if ``is_packed``) packed rows are shuffled, dealt by the hash of their head."""
    if packed is not None:
        rows = packed.select("cell", F.pmod(F.xxhash64("head"), F.lit(chunks)).cast("int").alias("chunk"),
                             F.struct("head", "low", "high").alias("row"))
        lists = rows.groupBy("cell", "chunk").agg(F.array_sort(F.collect_list("row")).alias("rows"))
        return lists.select("cell", "chunk", F.flatten(F.transform("rows", packed_ids)).alias("ids"))
    salted = flat.select("cell", F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int").alias("chunk"), "id")
    return salted.groupBy("cell", "chunk").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def numbered_postings(flat: DataFrame) -> DataFrame:
    """``(cell, id, task, at)``: index entries in the order of (cell, id), range-partitioned by
    Spark: ``task`` counts the ranges, ``at`` the entries of a range.  To be written: the
    numbers belong to one run of the sort."""
    at = F.monotonically_increasing_id()
    return flat.select("cell", "id").repartitionByRange("cell", "id").sortWithinPartitions("cell", "id") \
        .select("cell", "id", F.spark_partition_id().alias("task"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("at"))


def posting_blocks(numbered: DataFrame, size: int = BLOCK_IDS) -> DataFrame:
    """A3 + E9: ``(cell, block, ids, n_ids, min_id, max_id)`` -- each cell's ids in order, cut into blocks
    of ``size`` (the last one shorter), from written ``numbered_postings``.

    A cell of any size lies in consecutive ranges of the sort.  Its counts per range (one row for each
    cell and range, by a partial aggregate) give each range the number of ids before it, so an id's
    place in its cell is known without bringing the cell together; only blocks are
    grouped, and no block is larger than ``size``, however hot the cell.  The numbered postings may be a packed index."""
    if "low" in numbered.columns:
        return _packed_blocks(numbered, size)
    counts = numbered.groupBy("cell", "task").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("start"))
    earlier = Window.partitionBy("cell").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("cell", "task", "start", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.col("before") + F.col("at") - F.col("start")
    placed = numbered.join(offsets, ["cell", "task"]).select("cell", "id", F.floor(place / size).alias("block"))
    return placed.groupBy("cell", "block").agg(F.array_sort(F.collect_list("id")).alias("ids")) \
        .select("cell", "block", "ids", F.size("ids").alias("n_ids"),
                F.get("ids", 0).alias("min_id"), F.element_at("ids", -1).alias("max_id"))


def _packed_blocks(packed: DataFrame, size: int) -> DataFrame:
    """``posting_blocks`` of a packed index: the place of a packed row in its cell is the number of ids in the parts before
    its own (one row for each cell and part, by a partial aggregate) and in the rows before it in its part (a
    thousand or so).  Packed rows are dealt to the blocks that they touch, and ids are made there."""
    def earlier(n: str, *by: str, order: str) -> Column:
        w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(n).over(w), F.lit(0))
    parts = packed.groupBy("cell", "part").agg(F.sum("n").alias("m"))
    before = parts.select("cell", "part", earlier("m", "cell", order="part").alias("before"))
    inner = packed.select("cell", "part", "head", "low", "high", "n", earlier("n", "cell", "part", order="head").alias("inner"))
    at, block, n = F.col("at"), F.col("block"), F.col("n")
    rows = inner.join(before, ["cell", "part"]).withColumn("at", F.col("before") + F.col("inner"))
    rows = rows.withColumn("block", F.explode(F.sequence(F.floor(at / size), F.floor((at + n - 1) / size))))
    skip = F.greatest(block * size - at, F.lit(0)).cast("int")
    rows = rows.select("cell", "block", F.struct("head", "low", "high", skip.alias("skip"), F.least((block + 1) * size - at, n).cast("int").alias("upto"))
                       .alias("row"))
    lists = rows.groupBy("cell", "block").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    ids = F.flatten(F.transform("rows", lambda r: F.slice(packed_ids(r), r["skip"] + 1, r["upto"] - r["skip"])))
    return lists.select("cell", "block", ids.alias("ids")).select(
        "cell", "block", "ids", F.size("ids").alias("n_ids"), F.get("ids", 0).alias("min_id"), F.element_at("ids", -1).alias("max_id"))


def with_cells(rows: DataFrame, flat: DataFrame) -> DataFrame:
    """``rows`` that have an ``id`` with its index entries: ``n_cells`` and ``cells`` (in order, as a text).

    The entries meet the rows packed (``pack_index``), by the heads of the ids; entries that cannot be packed as
    they are, one by one."""
    width = head_width(flat)
    packed = pack_index(flat, width)
    if not is_packed(packed):
        each = flat.groupBy("id").agg(F.count(F.lit(1)).cast("int").alias("n_cells"),
                                      F.concat_ws(" ", F.array_sort(F.collect_list("cell"))).alias("cells"))
        return rows.join(each, "id")
    heads = packed.groupBy("head").agg(F.array_sort(F.collect_list(F.struct("cell", "low", "high"))).alias("packed"))
    own = rows.withColumns({"head": F.left("id", width), "slot": tail_slot(width)}).join(heads, "head")
    cells = F.transform(F.filter("packed", lambda p: _has(p, F.col("slot"))), lambda p: p["cell"])
    own = own.withColumn("packed", cells).where(F.size("packed") > 0)
    return own.select(*rows.columns, F.size("packed").alias("n_cells"), F.concat_ws(" ", "packed").alias("cells"))
