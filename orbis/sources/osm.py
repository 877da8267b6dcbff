"""OpenStreetMap extract readers with explicit schemas.

Columns not named in the schema (version, timestamp, changeset, uid,
user_sid) are simply never read: column pruning replaces the old ``drop``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TAGS = T.ArrayType(T.StructType([T.StructField("key", T.StringType()),
                                 T.StructField("value", T.StringType())]))

NODE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("tags", TAGS),
])

WAY_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("nodes", T.ArrayType(T.StructType([
        T.StructField("index", T.IntegerType()),
        T.StructField("nodeId", T.LongType())]))),
    T.StructField("tags", TAGS),
])

RELATION_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("members", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("type", T.StringType())]))),
    T.StructField("tags", TAGS),
])

# Where an extract's three tables lie (kind: node, way, relation).
EXTRACT_PATTERN = "{root}/{region}/{region}.pbf.{kind}.parquet"
# The region in a path.  A name begins with its path segment: tried from every character of
# the path, on every row, this took most of the reading time.
REGION_PATTERN = r"(?:^|/)([^/]+)\.pbf\.[a-z]+\.parquet"


def read_nodes(spark: SparkSession, *paths: str) -> DataFrame:
    """Raw nodes ``(id, longitude, latitude, tags)``."""
    return spark.read.schema(NODE_SCHEMA).parquet(*paths)


def read_ways(spark: SparkSession, *paths: str) -> DataFrame:
    """Raw ways ``(id, nodes array<struct<index,nodeId>>, tags)``."""
    return spark.read.schema(WAY_SCHEMA).parquet(*paths)


def read_relations(spark: SparkSession, *paths: str) -> DataFrame:
    """S3: raw relations ``(id, members array<struct<id,role,type>>, tags)``."""
    return spark.read.schema(RELATION_SCHEMA).parquet(*paths)


# Reader of each kind of extract table.
READERS = {"node": read_nodes, "way": read_ways, "relation": read_relations}


def with_region(df: DataFrame) -> DataFrame:
    """Read many regions at once and keep which extract a row came from."""
    return df.withColumn("region", F.regexp_extract(
        F.col("_metadata.file_path"), REGION_PATTERN, 1))


def read_regions(spark: SparkSession, root: str, regions: list[str], kind: str) -> DataFrame:
    """The ``kind`` tables of many extracts at once, with ``region_rank`` (the place of the
    extract in ``regions``)."""
    ranks = F.create_map(*[F.lit(x) for r, name in enumerate(regions) for x in (name, r)])
    rows = with_region(READERS[kind](spark, *extract_paths(root, regions, kind)))
    return rows.withColumn("region_rank", ranks[F.col("region")]).drop("region")


def last_wins(rows: DataFrame) -> DataFrame:
    """One row per ``id``: of the extract listed last, as a later put under the same row key
    would have left it; of rows that one extract repeats, always the same one.

    Extracts overlap along their borders only, so only ids pass a shuffle (a grouped maximum with
    map-side combining); ids that occur once go through untouched, and the few that repeat
    are joined with their winner (AQE broadcasts them if they are few indeed)."""
    cols = [c for c in rows.columns if c != "region_rank"]
    version = F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) + F.col("region_rank").cast("long") * (1 << 40)
    keyed = rows.withColumn("version", version)
    best = keyed.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max("version").alias("version")) \
        .where("n > 1").select("id", "version")
    once = rows.join(best, "id", "left_anti")
    won = keyed.join(best, ["id", "version"], "left_semi").dropDuplicates(["id"])
    return once.select(cols).unionByName(won.select(cols))


def extract_paths(root: str, regions: list[str], kind: str) -> list[str]:
    return [EXTRACT_PATTERN.format(root=root, region=r, kind=kind) for r in regions]


def way_refs(raw_ways: DataFrame) -> DataFrame:
    """One row per node reference ``(way_id, idx, node_id)``."""
    return raw_ways.select(F.col("id").alias("way_id"), F.inline("nodes")) \
        .select("way_id", F.col("index").alias("idx"), F.col("nodeId").alias("node_id"))


def way_tags(raw_ways: DataFrame) -> DataFrame:
    return raw_ways.select("id", "tags")


def relation_members(raw_relations: DataFrame) -> DataFrame:
    """One row per member ``(rel_id, pos, member_id, member_type, role)``;
    ``pos`` keeps the member order."""
    return raw_relations.select(F.col("id").alias("rel_id"), F.posexplode("members")) \
        .select("rel_id", F.col("pos").cast("long").alias("pos"),
                F.col("col.id").alias("member_id"), F.col("col.type").alias("member_type"),
                F.col("col.role").alias("role"))


def relation_tags(raw_relations: DataFrame) -> DataFrame:
    return raw_relations.select("id", "tags")
