"""JSON and GeoJSON results.

Results leave as text lines built by Spark (``to_json``), one line per
city or per feature, and are written with ``write.text`` -- nothing is
collected on the driver.  ``write_document`` writes one JSON document of any size: sorted
part files that joined in name order are the head, the entries with separators, and the tail.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbis.functions.common import last_map


def _comparison(indicator: str, op: str, threshold: float, year: int) -> Column:
    """What was asked, as the pages read it: name, operator, value and year by position."""
    asked = [F.lit(indicator), F.lit(op), F.lit(float(threshold)), F.lit(int(year))]
    return F.struct(*[c.alias(f"_{i}") for i, c in enumerate(asked, 1)])


def stat_from_all_json(result: DataFrame, indicator: str, op: str, threshold: float,
                       year: int) -> DataFrame:
    """K7 for E5: one line per passing city,
    ``{"_1":{"_1":name,"_2":op,"_3":value,"_4":year},"_2":{city: value}}``."""
    head = _comparison(indicator, op, threshold, year)
    return result.select(F.to_json(F.struct(
        head.alias("_1"), F.create_map(F.col("city"), F.col("value")).alias("_2"))).alias("json"))


def write_stat_from_all(result: DataFrame, indicator: str, op: str, threshold: float, year: int,
                        path: str, staging: str) -> None:
    """K7 for E5 as the pages read it: one document, ``_2`` holds all passing cities."""
    head = result.sparkSession.range(1).select(F.to_json(_comparison(indicator, op, threshold, year))).first()[0]
    rows = result.select(F.col("city").alias("k"), entry(F.to_json(F.create_map("city", "value"))).alias("json"))
    write_document(rows, path, f'{{"_1":{head},"_2":{{', "}}", ["k"], staging)


def entry(json: Column) -> Column:
    """A JSON object as an entry of a larger one: without its outer braces."""
    return F.substr(json, F.lit(2), F.char_length(json) - 2)


def write_object(lines: DataFrame, path: str, staging: str) -> None:
    """K7 for E4, E6 and E7: lines ``{city: ...}`` as one object with all cities."""
    write_document(lines.select(entry(F.col("json")).alias("json")), path, "{", "}", ["json"], staging)


def write_features(features: DataFrame, path: str, staging: str) -> None:
    """K8: feature lines as one GeoJSON FeatureCollection."""
    write_document(features.select("json"), path, '{"type":"FeatureCollection","features":[', "]}", ["json"], staging)


def write_document(rows: DataFrame, path: str, head: str, tail: str, order: list[str], staging: str) -> None:
    """One JSON document below ``path``: ``head``, the ``json`` of the rows sorted by ``order`` with
    commas between them, ``tail``.  Lines are range-partitioned and sorted by Spark; every row but the
    first carries its comma in front, so tasks need not know their neighbours.  Rows are
    numbered in a staged table, so that repeated rows have one first among them."""
    spark = rows.sparkSession
    rows.select(*order, F.col("json").alias("line"), F.monotonically_increasing_id().alias("uid")) \
        .write.mode("overwrite").parquet(staging)
    kept = spark.read.parquet(staging)
    first = kept.agg(F.min(F.struct(*order, "uid")).alias("f")).select("f.uid").first().uid
    body = kept.withColumns({"line": F.when(F.col("uid") == F.lit(first), F.col("line")).otherwise(F.concat(F.lit(","), "line")),
                             "rank": F.lit(1)})
    ends = spark.createDataFrame([(0, head), (2, tail)], "rank int, line string") \
        .select(*[F.lit(None).cast(t).alias(c) for c, t in kept.dtypes if c != "line"], "line", "rank")
    body.unionByName(ends).sort("rank", *order, "uid").select("line").write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a written document, with the part file each is in."""
    return spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_name").alias("part"))


def range_json(range_map: DataFrame) -> DataFrame:
    """K7 for E6/E7: one line per city, ``{city: {stat: {year: value}}}``."""
    return range_map.select(F.to_json(F.create_map("city", "stats")).alias("json"))


def year_values_json(rows: DataFrame) -> DataFrame:
    """K7 for E6: one line per city, ``{city: {year: value}}``, from the rows of
    ``stat_in_range`` (a city's years are few: the group is small)."""
    m = F.array_sort(F.collect_list(F.struct(F.col("year").cast("string").alias("year"), "value")))
    return rows.groupBy("city").agg(m.alias("years")).withColumn("years", last_map(F.col("years"), "year")) \
        .select(F.to_json(F.create_map("city", "years")).alias("json"))


def compare_json(compare: DataFrame) -> DataFrame:
    """K7 for E4: ``{city: {"_1": [values], "_2": wkt}}`` (wkt when joined)."""
    wkt = F.col("wkt") if "wkt" in compare.columns else F.lit(None).cast("string")
    return compare.select(F.to_json(F.create_map(
        F.col("city"), F.struct(F.col("values").alias("_1"), wkt.alias("_2")))).alias("json"))


def point_features(df: DataFrame, fid: str, lon: str, lat: str, value: str,
                   inferred: bool) -> DataFrame:
    """K8: GeoJSON Point features ``{"type":"Feature","properties":{id,
    value, inferred},"geometry":{"type":"Point","coordinates":[lon,lat]}}``;
    ``inferred`` marks interpolated points apart from observed ones (P18)."""
    feat = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col(fid).cast("string").alias("id"), F.col(value).alias("value"),
                 F.lit(inferred).alias("inferred")).alias("properties"),
        F.struct(F.lit("Point").alias("type"),
                 F.array(F.col(lon), F.col(lat)).alias("coordinates")).alias("geometry"))
    return df.select(F.to_json(feat).alias("json"))


def write_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    lines.select("json").write.mode(mode).text(path)
