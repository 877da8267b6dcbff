"""Keyed lookups, index prefix scans and first-match selection
(S8–S10, J5, J8, J9, O2, F16).

The old store answered "get these row keys" with batched point gets; here a
lookup is a join against the id list (Spark/AQE broadcasts the list when its
runtime size is small), and a predicate is a plain filter Catalyst places
below the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbis.functions.common import col_of


# ids in one pushed IN list (Spark pushes longer ones as a range only), and in all of them
PUSHED_IN, PUSHED_IDS = 10, 500
# ids of a DataFrame that are broadcast to the geometries
BROADCAST_IDS = 10_000


def id_filter(ids: list[str], id_col: str = "id") -> Column:
    """``id IN ids`` in lists short enough to be pushed to Parquet as they are."""
    own = sorted(set(ids))
    out = F.lit(False)
    for at in range(0, len(own), PUSHED_IN):
        out = out | F.col(id_col).isin(own[at:at + PUSHED_IN])
    return out


def get_geometries(geoms: DataFrame, ids) -> DataFrame:
    """Geometries of the given ids (a DataFrame with ``id`` or a
    list).  Ids with no geometry simply do not come back (Q18).

    A list of up to ``PUSHED_IDS`` ids becomes pushed filters: the kinds of the ids select partitions
    (an id begins with its kind), and in the stored table bloom filters skip row groups and
    page statistics skip pages without any of them.  More ids are a join.

    The ids of a DataFrame are read first, up to ``BROADCAST_IDS``: a join is planned by the size of the
    tables it comes from, so a few ids would make the whole geometry table pass a shuffle."""
    if isinstance(ids, DataFrame):
        own = ids.select("id").where(F.col("id").isNotNull()).distinct()
        few = [r.id for r in own.limit(BROADCAST_IDS + 1).collect()]
        if len(few) > BROADCAST_IDS:
            return geoms.join(own, "id", "left_semi")
        if "kind" in geoms.columns and own.schema["id"].dataType.typeName() == "string":
            geoms = geoms.where(F.col("kind").isin(sorted({i[:1] for i in few})))
        return geoms.join(F.broadcast(geoms.sparkSession.createDataFrame([(i,) for i in few], own.schema)), "id", "left_semi")
    ids = [i for i in ids if i is not None]
    if len(ids) > PUSHED_IDS:
        return get_geometries(geoms, geoms.sparkSession.createDataFrame([(i,) for i in ids], "id string"))
    found = geoms.where(id_filter(ids))
    kinds = sorted({i[:1] for i in ids})
    return found.where(F.col("kind").isin(kinds)) if "kind" in geoms.columns else found


def get_filtered(geoms: DataFrame, ids, predicate: Column) -> DataFrame:
    """Keyed lookup plus a row filter (pushed below the join)."""
    return get_geometries(geoms.where(predicate), ids)


def with_names(df: DataFrame, names: DataFrame, id_col: str = "id") -> DataFrame:
    """Attach the locality name (``names`` has ``id``, ``name``)."""
    return df.join(names.select(F.col("id").alias(id_col), "name"), id_col)


def _after(prefix: str) -> str:
    """The smallest text greater than every text that starts with ``prefix``."""
    return prefix[:-1] + chr(ord(prefix[-1]) + 1)


def scan_index_by_prefixes(index: DataFrame, prefixes: list[str], cell: str = "cell") -> DataFrame:
    """Index rows whose cell starts with any of ``prefixes``.

    Prefixes may differ in length; one that extends another adds nothing and is
    left out.  Each of the rest is a half-open range of cells, and the OR of the
    ranges is a pushed filter of the Parquet scan: files are sorted by cell, so row
    groups outside all ranges are skipped.  Where the index is partitioned by ``cell3``,
    only the partitions of the prefixes are read."""
    wanted: list[str] = []
    for p in sorted(set(prefixes)):
        if not (wanted and p.startswith(wanted[-1])):
            wanted.append(p)
    if "" in wanted:
        return index
    c = col_of(cell)
    cond = F.lit(False)
    for p in wanted:
        in_range = (c >= p) & (c < _after(p))
        if "cell3" in index.columns:
            part = p[:3]
            in_range = in_range & (F.col("cell3") >= part) & (F.col("cell3") < _after(part))
        cond = cond | in_range
    return index.where(cond)


def first_match(candidates: DataFrame, key: str = "name", rank: str = "rank",
                value: str = "osm_id", done: DataFrame | None = None) -> DataFrame:
    """Per key, the candidate with the best (smallest) rank, ties by the
    smallest value; keys already in ``done`` are skipped (resume).

    A grouped ``min`` over (rank, value) -- partial aggregation, so a key
    with very many candidates never sits whole in one task."""
    c = candidates
    if done is not None:
        c = c.join(done.select(key).distinct(), key, "left_anti")
    best = c.groupBy(key).agg(F.min(F.struct(F.col(rank).alias("r"), F.col(value).alias("v")))
                              .alias("m"))
    return best.select(key, F.col("m.v").alias(value), F.col("m.r").alias(rank))
