"""Table sinks (K1–K6): Parquet in place of the old column store.

* geometries: partitioned by ``kind`` (n / w / r) so a search for one kind
  prunes whole directories; rows sorted by id inside each file.
* cell index: partitioned by the first three characters of the cell, rows sorted
  by cell inside each file.  A search reads the partitions its cells lie in, and
  Parquet min/max statistics let a prefix filter (S10) skip row groups.
* statistics: partitioned by a hash bucket of the id, sorted by indicator inside each file.
  ``merge_stats`` puts new rows over old ones per (id, indicator, year) -- the cell-level upsert
  of the old store -- and rewrites only the buckets that the new rows touch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbis.functions import geohash as GH
from orbis.operators.build import INDEX_COLUMNS, build_index, build_tag_index, tag_part
from orbis.operators.statistics import bare_localities, stat_facts


# an id list reaches row groups and pages: bloom filters on the id, rows sorted by it
LOOKUP_OPTIONS = {"parquet.bloom.filter.enabled#id": "true", "parquet.bloom.filter.adaptive.enabled": "true", "compression": "zstd"}


def write_geometries(geoms: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1–K3: one table for nodes, ways and relations."""
    geoms.sortWithinPartitions("kind", "id").write.mode(mode).options(**LOOKUP_OPTIONS).partitionBy("kind").parquet(path)


def write_kind(geoms: DataFrame, path: str, kind: str, mode: str = "overwrite") -> None:
    """K1–K3 one kind at a time, into the ``kind=<kind>`` partition folder of
    the geometry table (each step commits on its own)."""
    geoms.drop("kind").sortWithinPartitions("id").write.mode(mode).options(**LOOKUP_OPTIONS) \
        .parquet(f"{path}/kind={kind}")


INDEX_SCHEMA = ("cell string, id string, minx double, miny double, maxx double, maxy double, "
                "cell3 string")
TAG_INDEX_SCHEMA = ("key string, value string, cell string, id string, kind string, class string, minx double, "
                    "miny double, maxx double, maxy double, sides int, tag_part int, cell3 string")


def with_cell3(flat_index: DataFrame) -> DataFrame:
    """The partition column of the indexes.  It is never null: a text that may be empty is rewritten by
    Spark before a partitioned write, which then sorts the sorted rows once more."""
    return flat_index.withColumn("cell3", F.coalesce(F.left("cell", F.lit(3)), F.lit("")))


def write_index(flat_index: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4 / K6: flat ``(cell, id, box)`` index in partitions ``cell3=<prefix>``.  Spark deals the rows
    by prefix and, from their sizes at run time, splits a crowded prefix over several
    tasks and puts small ones together (``rebalance``)."""
    with_cell3(flat_index).hint("rebalance", "cell3").sortWithinPartitions("cell3", "cell") \
        .write.mode(mode).partitionBy("cell3").parquet(path)


# the index is several times its input: its files are packed more tightly than by default
INDEX_OPTIONS = {"compression": "zstd"}
# index rows that one task makes when the index of stored geometries is written
CELL_ROWS = 4_000_000
# side, in 3-character cells, of the squares by which covers are dealt out
CELL_BLOCK = 4


def write_cells(geoms: DataFrame, path: str, mode: str = "overwrite", rows: int = CELL_ROWS) -> None:
    """E9 + K4 of stored geometries: the rows of ``build_index`` in the layout of ``write_index``.

    A large geometry has dozens of cells.  What is shuffled are its covers, cut into squares of
    ``CELL_BLOCK`` 3-character cells: the cells are made after that, in the task that writes them.
    A square with many cells is dealt over several tasks by id (neighbouring ids to the same, so that
    ``pack_index`` finds them together), from its counted cells, so a task
    makes about ``rows`` of them, of one square; squares are few (at most 32 ** 3 / 16).  Covers are
    sorted by their western edge first (the sort by cell keeps that order), so that the edges of a cell's
    rows are runs of one value in the file."""
    blocks = GH.cover_blocks(geoms.select("id", "cover", "envelope.*"), "cover", CELL_BLOCK, "square")
    counts = sorted(map(tuple, blocks.groupBy("square").agg(F.sum(GH.grid_size("cover"))).collect()))
    tasks, sizes = 0, []
    for square, n in counts:
        sizes.append((square, tasks, -(-n // rows)))
        tasks += sizes[-1][2]
    at = geoms.sparkSession.createDataFrame(sizes, "square long, first int, ways int")
    task = (F.col("first") + F.pmod(F.xxhash64(F.left("id", F.length("id") - 3)), F.col("ways"))).cast("int")
    dealt = blocks.join(F.broadcast(at), "square").repartitionById(max(tasks, 1), task) \
        .sortWithinPartitions("minx")
    flat = GH.explode_grid(dealt.select("id", "cover", "minx", "miny", "maxx", "maxy"), "cover").select(*INDEX_COLUMNS)
    with_cell3(flat).sortWithinPartitions("cell3", "cell").write.mode(mode).options(**INDEX_OPTIONS) \
        .partitionBy("cell3").parquet(path)


def write_tag_index(tag_index: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The index by tag in partitions ``tag_part=<n>/cell3=<prefix>``, sorted by key, value and cell."""
    with_cell3(tag_index).withColumn("tag_part", tag_part("key")).hint("rebalance", "tag_part", "cell3") \
        .sortWithinPartitions("tag_part", "cell3", "key", "value", "cell") \
        .write.mode(mode).partitionBy("tag_part", "cell3").parquet(path)


def read_tag_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TAG_INDEX_SCHEMA).parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The written index; the schema is given, since a prefix may look like a number."""
    return spark.read.schema(INDEX_SCHEMA).parquet(path)


def update_partitions(old: DataFrame, gone: DataFrame, new: DataFrame, path: str, by: list[str], order: list[str],
                      touched: list, staging: str) -> None:
    """Index maintenance (K4, K6): in the stored table ``old`` at ``path``, rows of the ids in ``gone``
    are replaced by the rows ``new``.  ``touched`` are the partitions (rows of ``by``) that hold
    any of them; only these are read, staged, and written over the stored ones; a partition left
    without rows is removed.  Files of all other partitions stay as they are.  Each partition comes
    out sorted and balanced anew, so small deliveries do not pile up small files."""
    spark = old.sparkSession
    if not touched:
        return
    at = spark.createDataFrame(touched, new.select(*by).schema)
    parts = F.broadcast(at)                                     # at most 32 ** 3 cells per part
    kept = old.join(parts, by, "left_semi").join(gone.select("id"), "id", "left_anti")
    rows = kept.select(*new.columns).unionByName(new)
    rows.hint("rebalance", *by).sortWithinPartitions(*order).write.mode("overwrite").partitionBy(*by).parquet(staging)
    staged = spark.read.schema(rows.schema).parquet(staging)
    replace_partitions(staged, path, by, order)
    left = {tuple(r) for r in staged.select(*by).distinct().collect()}
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for values in {tuple(t) for t in touched} - left:
        folder = hadoop.Path("/".join([path, *[f"{c}={v}" for c, v in zip(by, values)]]))
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def update_index(spark: SparkSession, path: str, gone: DataFrame, new: DataFrame, staging: str) -> list[str]:
    """The cell index after geometries changed: ``gone (id, cover)`` are the stored rows that go,
    ``new`` the geometries that come.  Returns the ``cell3`` partitions rewritten."""
    cells = with_cell3(GH.explode_grid(gone.select("id", "cover"), "cover")).select("cell3")
    rows = with_cell3(build_index(new))
    touched = sorted(tuple(r) for r in cells.unionByName(rows.select("cell3")).distinct().collect())
    update_partitions(read_index(spark, path), gone, rows, path, ["cell3"], ["cell3", "cell"], touched, staging)
    return [t[0] for t in touched]


def update_tag_index(spark: SparkSession, path: str, gone: DataFrame, new: DataFrame, staging: str) -> None:
    """The tag index likewise; ``gone`` has ``tags`` too."""
    keyed = lambda t: with_cell3(build_tag_index(t)).withColumn("tag_part", tag_part("key"))
    by = ["tag_part", "cell3"]
    rows = keyed(new)
    touched = sorted(tuple(r) for r in keyed(gone).select(*by).unionByName(rows.select(*by)).distinct().collect())
    update_partitions(read_tag_index(spark, path), gone, rows, path, by, [*by, "key", "value", "cell"], touched, staging)


STATS_BUCKETS = 16
STATS_SCHEMA = ("id string, name string, indicator string, year int, value double, value_raw string, bucket int")


def stats_bucket(buckets: int = STATS_BUCKETS) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")


def write_stats(stats: DataFrame, path: str, mode: str = "overwrite", buckets: int = STATS_BUCKETS) -> None:
    """K5: the long statistics table, partitioned by ``bucket`` (a hash of the id: every row of a
    city lies in one) and sorted by indicator, so a query of one indicator skips row groups."""
    order = [c for c in ("indicator", "id", "year") if c in stats.columns]
    stats.withColumn("bucket", stats_bucket(buckets)).hint("rebalance", "bucket") \
        .sortWithinPartitions("bucket", *order).write.mode(mode).partitionBy("bucket").parquet(path)


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATS_SCHEMA).parquet(path)


def load_stats(spark: SparkSession, stat_csv: DataFrame, names: DataFrame, path: str,
               buckets: int = STATS_BUCKETS) -> None:
    """E11 ``load`` + ``send``: the statistics joined to the dictionary and written, in one scan of
    the statistics: localities without any are found from the names just written."""
    write_stats(stat_facts(stat_csv, names), path, buckets=buckets)
    write_stats(bare_localities(names, read_stats(spark, path)), path, "append", buckets)


def merge_stats(spark: SparkSession, path: str, updates: DataFrame, staging: str,
                buckets: int = STATS_BUCKETS) -> list[int]:
    """K5: ``updates`` over the stored rows of the same key (``upsert_stats``).  Only the buckets
    that hold an updated city are read and written; files of the others stay as they are.  The
    merged buckets are staged first, so a job that is lost midway is run again with the same
    result.  Returns the buckets (at most ``buckets`` numbers)."""
    own = updates.withColumn("bucket", stats_bucket(buckets))
    touched = sorted(r.bucket for r in own.select("bucket").distinct().collect())
    if touched:
        old = read_stats(spark, path).where(F.col("bucket").isin(touched))
        write_stats(upsert_stats(old.drop("bucket"), updates), staging, buckets=buckets)
        replace_partitions(read_stats(spark, staging), path, ["bucket"], ["bucket", "indicator", "id", "year"])
    return touched


def replace_partitions(rows: DataFrame, path: str, by: list[str], order: list[str]) -> None:
    """Overwrite the partitions that ``rows`` have, and no others (dynamic partition overwrite)."""
    rows.hint("rebalance", *by).sortWithinPartitions(*order).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def upsert_stats(current: DataFrame, updates: DataFrame) -> DataFrame:
    """K5 upsert: rows of ``updates`` replace rows of ``current`` with the same
    (id, indicator, year), null-safe; everything else is kept as it is.  Of several
    updates of one key the greatest row wins (by the columns in order, so the result
    does not depend on the order of rows).  The placeholder row of a locality without
    data (no indicator, no year) goes once a real row of that locality is there.  Write
    the result to a new path (a table is never overwritten while it is being read)."""
    keys = ["id", "indicator", "year"]
    cols = [c for c in current.columns if c not in keys]
    new = updates.groupBy(*keys).agg(F.max(F.struct(*cols)).alias("new"))
    c, u = current.alias("c"), new.alias("u")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"c.{k}").eqNullSafe(F.col(f"u.{k}"))
    old = c.join(u, same, "left_anti").select(*current.columns)
    merged = old.unionByName(new.select(*keys, "new.*").select(*current.columns))
    blank = F.col("indicator").isNull() & F.col("year").isNull()
    real = updates.where(~blank).select("id").distinct()
    placeholders = merged.where(blank).join(real, "id", "left_anti")
    return merged.where(~blank).unionByName(placeholders.select(*current.columns))
