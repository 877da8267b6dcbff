"""OSM-like and statistics inputs derived from the driver tables.

The driver tables carry no coordinates, so these views make them with plain
arithmetic (see FIXTURES.md §4): one node per part, one way per order (its
line items are the node references), one relation per customer (its orders
are member ways, plus one member node), and yearly counts of orders per
nation and priority as the city statistics.  Each view is a DataFrame plan
over the whole tables, so its work grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Fixed values of the derivation (FIXTURES.md §4): coordinate origin, spans
# (in thousandths of a degree) and multipliers.
LON0, LAT0 = 5.0, 40.0
LON_SPAN, LAT_SPAN = 15000, 12000
NODE_LON_MUL, NODE_LAT_MUL = 7919, 104729
# query points (one per supplier) use other multipliers and sit half a grid
# step off the node grid
POINT_LON_MUL, POINT_LAT_MUL, POINT_OFFSET = 3571, 7727, 0.0005

# Customer market segment → relation type.
SEGMENT_TO_RELATION_TYPE = {
    "BUILDING": "multipolygon",
    "HOUSEHOLD": "boundary",
    "AUTOMOBILE": "route",
    "MACHINERY": "site",
}
OTHER_RELATION_TYPE = "restriction"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _tags(*pairs) -> F.Column:
    return F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in pairs])


_EMPTY_TAGS = "array<struct<key:string,value:string>>"


def raw_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One node per part; distinct coordinates; tags only where p_size is even."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    tags = F.when(F.col("p_size") % 2 == 0,
                  _tags(("place", F.col("p_type")), ("brand", F.col("p_brand")))) \
        .otherwise(F.array().cast(_EMPTY_TAGS))
    return p.select(
        k.alias("id"),
        (F.lit(LON0) + ((k * NODE_LON_MUL) % LON_SPAN).cast("double") / F.lit(1000.0)).alias("longitude"),
        (F.lit(LAT0) + ((k * NODE_LAT_MUL) % LAT_SPAN).cast("double") / F.lit(1000.0)).alias("latitude"),
        tags.alias("tags"))


def way_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node references ``(way_id, idx, node_id)``: one way per order.

    (l_orderkey, l_linenumber) is not unique, so references are renumbered;
    every third way with 3+ distinct nodes is closed by repeating its first
    node at the end.  One window pass: the way's size and distinct node
    count are window aggregates, and the first reference of a way to be
    closed emits the closing reference next to itself (no second pass)."""
    # named before the window, whose shuffle by way id then serves the assembly of ways too
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("way_id"), F.col("l_partkey").alias("node_id"),
        "l_linenumber", "l_suppkey", "l_extendedprice")
    order = Window.partitionBy("way_id").orderBy("l_linenumber", "node_id", "l_suppkey", "l_extendedprice")
    whole = Window.partitionBy("way_id")
    r = li.select("way_id", (F.row_number().over(order) - 1).cast("int").alias("idx"), "node_id",
                  F.count(F.lit(1)).over(whole).cast("int").alias("n"),
                  F.min("node_id").over(whole).alias("lo"), F.max("node_id").over(whole).alias("hi"))
    # three distinct nodes: one lies between the smallest and the largest
    between = F.max((F.col("node_id") > F.col("lo")) & (F.col("node_id") < F.col("hi"))).over(whole)
    r = r.withColumn("three", between)
    close = (F.col("idx") == 0) & (F.col("way_id") % 3 == 0) & F.col("three")
    refs = F.array(F.struct("idx", "node_id"),
                   F.when(close, F.struct(F.col("n").alias("idx"), "node_id")))
    return r.select("way_id", F.explode(refs).alias("ref")).where(F.col("ref").isNotNull()) \
        .select("way_id", "ref.idx", "ref.node_id")


def way_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"),
                    _tags(("priority", F.col("o_orderpriority")),
                          ("status", F.col("o_orderstatus"))).alias("tags"))


def raw_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ways in the raw extract shape (``nodes`` array), for the S2 path."""
    refs = way_refs(spark, sf_dir)
    g = refs.groupBy("way_id").agg(F.array_sort(F.collect_list(F.struct(
        F.col("idx").alias("index"), F.col("node_id").alias("nodeId")))).alias("nodes"))
    return g.join(way_tags(spark, sf_dir), g.way_id == F.col("id")).select("id", "nodes", "tags")


# ------------------------------------------------------------ street blocks
# A second extract: each customer without a relation of its own above has a 5 x 5 lattice of
# corners, some of its streets (open ways, by the parts it ordered), and sometimes a square garden (a
# closed way).  The faces between streets are its polygon.  Coordinates are multiples of
# 1/1024 degree, so areas are exact in doubles.

BLOCK_BASE = 1_000_000_000_000
BLOCK_STEP, BLOCK_UNIT = 8, 1024
BLOCK_STREETS, BLOCK_CORNERS = 42, 25
# The garden's corners (from the middle of the second cell of the second row) and
# the two diagonal streets.
GARDEN = [(-2, 0), (0, -2), (2, 0), (0, 2)]
DIAGONALS = [(0, 6), (18, 24)]


def block_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.where(~F.col("c_mktsegment").isin(*SEGMENT_TO_RELATION_TYPE)) \
        .select(F.col("c_custkey").alias("c"), F.col("c_name").alias("name"))


def block_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw nodes: 25 corners, and 4 of the garden for every third owner; corner 0 is tagged."""
    k, c = F.col("k"), F.col("c")
    n = block_owners(spark, sf_dir).select("c", "name", F.explode(F.sequence(F.lit(0), F.lit(28))).alias("k")) \
        .where((k < BLOCK_CORNERS) | (c % 3 == 0))
    mid = F.lit(BLOCK_STEP + BLOCK_STEP // 2)
    gx, gy = (F.array(*[F.lit(g[a]) for g in GARDEN]) for a in (0, 1))
    dx = F.when(k < BLOCK_CORNERS, k % 5 * BLOCK_STEP).otherwise(mid + F.get(gx, k - BLOCK_CORNERS))
    dy = F.when(k < BLOCK_CORNERS, F.floor(k / 5) * BLOCK_STEP).otherwise(mid + F.get(gy, k - BLOCK_CORNERS))
    unit = F.lit(float(BLOCK_UNIT))
    x = (int(LON0) * BLOCK_UNIT + c * POINT_LON_MUL % (LON_SPAN // 1000 * BLOCK_UNIT) + dx).cast("double") / unit
    y = (int(LAT0) * BLOCK_UNIT + c * POINT_LAT_MUL % (LAT_SPAN // 1000 * BLOCK_UNIT) + dy).cast("double") / unit
    return n.select((BLOCK_BASE + c * 32 + k).alias("id"), x.alias("longitude"), y.alias("latitude"),
                    F.when(k == 0, _tags(("place", F.col("name")))).otherwise(F.array().cast(_EMPTY_TAGS)).alias("tags"))


def block_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ways ``(id, nodes, tags)``: an owner's streets, every second one from its far end, and its garden."""
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    own = block_owners(spark, sf_dir).select("c")
    e, c = F.col("e"), F.col("c")
    streets = li.join(o, li.l_orderkey == o.o_orderkey).join(own, F.col("o_custkey") == c) \
        .select("c", (F.col("l_partkey") % BLOCK_STREETS).cast("int").alias("e")).distinct()
    across, up = F.floor(e / 4) * 5 + e % 4, e - 20
    a = F.when(e < 20, across).when(e < 40, up).otherwise(
        F.get(F.array(*[F.lit(a) for a, _ in DIAGONALS]), e - 40))
    b = F.when(e < 20, across + 1).when(e < 40, up + 5).otherwise(
        F.get(F.array(*[F.lit(b) for _, b in DIAGONALS]), e - 40))
    ends = F.when(e % 2 == 0, F.array(a, b)).otherwise(F.array(b, a)).cast("array<long>")
    garden = own.where(c % 3 == 0).select("c", F.lit(BLOCK_STREETS).alias("e"),
                                          F.array(*[F.lit(BLOCK_CORNERS + k % 4) for k in range(5)])
                                          .cast("array<long>").alias("ks"))
    all_ = streets.select("c", "e", ends.alias("ks")).unionByName(garden)
    nodes = F.transform("ks", lambda k, i: F.struct(i.alias("index"), (BLOCK_BASE + c * 32 + k).alias("nodeId")))
    return all_.select((BLOCK_BASE + c * 64 + e).alias("id"), nodes.alias("nodes"),
                       _tags(("highway", F.when(e == BLOCK_STREETS, "garden").otherwise("street"))).alias("tags"))


def block_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw relations ``(id, members, tags)``: one per owner, of all its ways."""
    w = block_ways(spark, sf_dir).select("id", F.floor((F.col("id") - BLOCK_BASE) / 64).alias("c"))
    m = w.groupBy("c").agg(F.array_sort(F.collect_list(F.struct(
        "id", F.lit("outer").alias("role"), F.lit("Way").alias("type")))).alias("members"))
    own = block_owners(spark, sf_dir)
    kind = F.when(own["c"] % 2 == 0, "boundary").otherwise("multipolygon")
    return own.join(m, "c").select((BLOCK_BASE + F.col("c")).alias("id"), "members",
                                   _tags(("type", kind), ("name", F.col("name"))).alias("tags"))


# Owners of an extract, by key modulo 3: those of remainder 1 are in both.  The second
# extract is a later survey: it lies one unit further east and marks its tags.
BLOCK_REGIONS = {"alpha": (0, 1), "beta": (1, 2)}
BLOCK_SURVEY, BLOCK_MARK = "beta", "/2"


def block_extracts(spark: SparkSession, sf_dir: str) -> dict[str, dict[str, DataFrame]]:
    """The blocks as two overlapping extracts: region -> kind -> raw table."""
    owner = {"node": F.floor((F.col("id") - BLOCK_BASE) / 32), "way": F.floor((F.col("id") - BLOCK_BASE) / 64),
             "relation": F.col("id") - BLOCK_BASE}
    tables = {"node": block_nodes(spark, sf_dir), "way": block_ways(spark, sf_dir),
              "relation": block_relations(spark, sf_dir)}

    def surveyed(kind: str, rows: DataFrame) -> DataFrame:
        tags = F.transform("tags", lambda t: F.struct(t["key"], F.when(t["key"] == "type", t["value"]).otherwise(
            F.concat(t["value"], F.lit(BLOCK_MARK))).alias("value")))
        rows = rows.withColumn("tags", tags)
        return rows.withColumn("longitude", F.col("longitude") + 1.0 / BLOCK_UNIT) if kind == "node" else rows
    out = {}
    for region, rests in BLOCK_REGIONS.items():
        own = {kind: t.where((owner[kind] % 3).isin(*rests)) for kind, t in tables.items()}
        out[region] = {k: surveyed(k, t) for k, t in own.items()} if region == BLOCK_SURVEY else own
    return out


def _relation_type(segment: F.Column) -> F.Column:
    out = None
    for seg, typ in SEGMENT_TO_RELATION_TYPE.items():
        out = F.when(segment == seg, typ) if out is None else out.when(segment == seg, typ)
    return out.otherwise(OTHER_RELATION_TYPE)


def relation_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members ``(rel_id, pos, member_id, member_type, role)``: one relation
    per customer; its orders are member ways, its own key a member node."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    ways = o.select(F.col("o_custkey").alias("rel_id"), F.col("o_orderkey").alias("pos"),
                    F.col("o_orderkey").alias("member_id"), F.lit("Way").alias("member_type"),
                    F.lit("outer").alias("role"))
    node = c.select(F.col("c_custkey").alias("rel_id"), F.lit(-1).cast("long").alias("pos"),
                    F.col("c_custkey").alias("member_id"), F.lit("Node").alias("member_type"),
                    F.lit("label").alias("role"))
    return ways.unionByName(node)


def relation_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"),
                    _tags(("type", _relation_type(F.col("c_mktsegment"))),
                          ("name", F.col("c_name"))).alias("tags"))


def stat_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics rows ``(TIME, CITIES, INDIC_UR, Value)``, all text: yearly
    order counts per nation and priority, written ``tens,units``; every count
    divisible by three is the missing-value mark ``:``."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    nat = table(spark, sf_dir, "nation")
    g = (o.join(c, o.o_custkey == c.c_custkey).join(nat, c.c_nationkey == nat.n_nationkey)
         .groupBy("n_name", F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("p"))
         .agg(F.count(F.lit(1)).alias("n")))
    value = F.when(F.col("n") % 3 == 0, F.lit(":")).otherwise(
        F.concat((F.col("n") / 10).cast("long").cast("string"), F.lit(","),
                 (F.col("n") % 10).cast("string")))
    return g.select(F.col("y").cast("string").alias("TIME"), F.col("n_name").alias("CITIES"),
                    F.col("p").alias("INDIC_UR"), value.alias("Value"))


def later_delivery(spark: SparkSession, sf_dir: str, region: int, since: int) -> DataFrame:
    """Statistics rows of one region's nations from the year ``since`` on, with revised values."""
    nat = table(spark, sf_dir, "nation").where(F.col("n_regionkey") == region).select(F.col("n_name").alias("CITIES"))
    rows = stat_csv(spark, sf_dir).where(F.col("TIME") >= str(since)).join(nat, "CITIES")
    return rows.withColumn("Value", F.when(F.col("Value") == ":", "0,5").otherwise(F.concat(F.lit("1"), "Value")))


# Market segments whose relations become geometry collections
# (route, site); a nation's locality is its first such customer.
LOCALITY_SEGMENTS = ("AUTOMOBILE", "MACHINERY")


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id,name`` dictionary: one locality per nation, named after the
    nation; its id is the nation's smallest customer key among route/site
    customers, so the statistics attach to relation ``r<that key>``.  A
    nation with no such customer keeps its name with a null id (dropped by
    the id filter, P10)."""
    nat = table(spark, sf_dir, "nation")
    c = table(spark, sf_dir, "customer")
    first = c.where(F.col("c_mktsegment").isin(*LOCALITY_SEGMENTS)) \
        .groupBy("c_nationkey").agg(F.min("c_custkey").alias("k"))
    return nat.join(first, nat.n_nationkey == first.c_nationkey, "left").select(
        F.col("k").cast("string").alias("id"), F.col("n_name").alias("name"))


def extract_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A download manifest in the form of the extract lists: one URL per nation, below its region."""
    nat, reg = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    slug = lambda c: F.lower(F.replace(F.col(c), F.lit(" "), F.lit("-")))
    return nat.join(reg, nat.n_regionkey == reg.r_regionkey).select(
        (-F.col("n_nationkey") - 1).cast("long").alias("page_id"),
        F.concat(F.lit("https://extracts.example.org/"), slug("r_name"), F.lit("/"), slug("n_name"),
                 F.lit("-latest.osm.pbf")).alias("url"))


def query_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query point per supplier ``(qid, lon, lat)``."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        k.alias("qid"),
        (F.lit(LON0) + ((k * POINT_LON_MUL) % LON_SPAN).cast("double") / F.lit(1000.0)
         + F.lit(POINT_OFFSET)).alias("lon"),
        (F.lit(LAT0) + ((k * POINT_LAT_MUL) % LAT_SPAN).cast("double") / F.lit(1000.0)
         + F.lit(POINT_OFFSET)).alias("lat"))
