"""City-statistic tables and queries.

The statistics live in one long table::

    stats(id string, name string, indicator string, year int, value double,
          value_raw string)

one row per (city, indicator, year).  Every query is a filter/join/aggregate
plan over it; nothing is collected to the driver.  Series are grouped per
(city, indicator), so a group holds one value per year at most -- a hot city
never lands whole in one task.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbis.functions.common import last_map
from orbis.functions.parse import RELATION_PREFIX, prefixed_id, to_double, to_int
from orbis.operators.lookup import get_geometries

# The comparison operators a statistic filter accepts.
COMPARISONS = {
    ">": lambda v, t: v > t,
    "<": lambda v, t: v < t,
    "=": lambda v, t: v == t,
}


def comparison(op: str, value_col: Column, threshold: float) -> Column:
    """P14 operator, chosen when the plan is built; unknown → ValueError (Q16)."""
    if op not in COMPARISONS:
        raise ValueError(f"unknown comparison {op!r}; expected one of {sorted(COMPARISONS)}")
    return COMPARISONS[op](value_col, F.lit(float(threshold)))


def build_names(names: DataFrame) -> DataFrame:
    """The locality dictionary keyed like geometries (``r<id>``); P10
    drops rows without an id."""
    return names.where(F.col("id").isNotNull()).select(
        prefixed_id(RELATION_PREFIX, F.col("id")).alias("id"), "name")


def stat_facts(stat_csv: DataFrame, names: DataFrame) -> DataFrame:
    """J4, the rows with a statistic: one scan of the statistics; Spark (AQE) broadcasts the
    dictionary when its runtime size is small, so the statistics are not shuffled."""
    nm = build_names(names)
    rows = stat_csv.select("CITIES", "TIME", "INDIC_UR", "Value")
    return rows.join(nm, rows.CITIES == nm.name).select(
        nm.id, nm.name,
        F.col("INDIC_UR").alias("indicator"),
        to_int("TIME").alias("year"),
        to_double("Value").alias("value"),
        F.col("Value").alias("value_raw"))


def bare_localities(names: DataFrame, cities: DataFrame) -> DataFrame:
    """J4, the rows without: localities of the dictionary whose ``name`` is not in ``cities``."""
    return build_names(names).join(cities.select("name").distinct(), "name", "left_anti").select(
        "id", "name", F.lit(None).cast("string").alias("indicator"),
        F.lit(None).cast("int").alias("year"), F.lit(None).cast("double").alias("value"),
        F.lit(None).cast("string").alias("value_raw"))


def build_stats(stat_csv: DataFrame, names: DataFrame) -> DataFrame:
    """Statistic rows joined to the locality dictionary by name.

    The dictionary is the preserved side (a locality with no statistics
    keeps one row, with null indicator, year and value).  It is written as
    an inner join plus an anti join against the *distinct* city names, so
    the large statistics side is never shuffled whole for the outer join.  A stored table
    (``sinks.tables.load_stats``) takes the city names from what it has written, so it scans
    the statistics once."""
    cities = stat_csv.select(F.col("CITIES").alias("name"))
    return stat_facts(stat_csv, names).unionByName(bare_localities(names, cities))


def series(stats: DataFrame, indicators: Iterable[str] | None = None) -> DataFrame:
    """A4: ``(id, name, indicator, series array<struct<year,value>>)`` in year
    order (order is made inside the group, never assumed from a sort)."""
    s = stats.where(F.col("indicator").isNotNull())
    if indicators is not None:
        s = s.where(F.col("indicator").isin(list(indicators)))
    return s.groupBy("id", "name", "indicator").agg(
        F.array_sort(F.collect_list(F.struct("year", "value"))).alias("series"))


def stat_maps(stats: DataFrame) -> DataFrame:
    """A5 + A8: ``(id, name, stats map<indicator, map<year, value>>)``.  One
    map per city, built from per-indicator partial groups."""
    per = series(stats).select(
        "id", "name", "indicator",
        last_map(F.col("series"), "year").alias("years"))
    return per.groupBy("id", "name").agg(
        F.map_from_entries(_by_indicator(F.collect_list(F.struct("indicator", "years"))))
        .alias("stats"))


def _by_indicator(entries: Column) -> Column:
    """Sort (indicator, map) entries by indicator (maps cannot be ordered)."""
    return F.array_sort(entries, lambda a, b: F.when(a["indicator"] < b["indicator"], -1)
                        .when(a["indicator"] > b["indicator"], 1).otherwise(0))


def _ids(stats: DataFrame, ids) -> DataFrame:
    """Requested cities ``(id, name)``: a DataFrame with ``id`` and ``name`` (the
    dictionary: the statistics are not scanned for them), one with ``id``, a list of
    ids, or None for every city in the table."""
    if isinstance(ids, DataFrame) and "name" in ids.columns:
        return ids.select("id", "name")
    cities = stats.select("id", "name").distinct()
    if ids is None:
        return cities
    if isinstance(ids, DataFrame):
        return cities.join(ids.select("id").distinct(), "id")
    return cities.where(F.col("id").isin(list(ids)))


def stat_from_all(stats: DataFrame, indicator: str, op: str, threshold: float,
                  year: int) -> DataFrame:
    """E5 ``getStatFromAll``: cities whose ``indicator`` in ``year`` passes
    ``op threshold`` → ``(city_id, city, year, value)``.

    ``year == 0`` means each city's earliest recorded year (Q15); the value
    is looked up by year, not by list position (Q14); a city with no value
    for the year does not pass."""
    cond_probe = comparison(op, F.col("value"), threshold)  # validate early
    s = stats.where(F.col("indicator") == indicator)
    if year == 0:
        first = s.groupBy("id", "name").agg(F.min(F.struct("year", "value")).alias("f"))
        s = first.select("id", "name", F.col("f.year").alias("year"),
                         F.col("f.value").alias("value"))
    else:
        s = s.where(F.col("year") == int(year))
    return s.where(cond_probe).select(
        F.col("id").alias("city_id"), F.col("name").alias("city"), "year", "value")


def multi_compare_stat(stats: DataFrame, indicator: str, ids=None,
                       geometries: DataFrame | None = None) -> DataFrame:
    """E4 ``multiCompareStat``: each requested city's values of one
    indicator in year order → ``(city_id, city, values array<double>,
    series array<struct<year,value>>)``; a city without data keeps an empty
    list (A7).  Grouped by id, so two cities sharing a name stay apart (Q17).
    With ``geometries`` given, each city also carries its ``wkt``."""
    wanted = _ids(stats, ids)
    s = series(stats, [indicator]).select("id", "series")
    out = wanted.join(s, "id", "left")
    extra = []
    if geometries is not None:
        own = [c for c in ("kind", "id", "wkt") if c in geometries.columns]
        out = out.join(get_geometries(geometries.select(own), wanted).select("id", "wkt"), "id", "left")
        extra = ["wkt"]
    return out.select(
        F.col("id").alias("city_id"), F.col("name").alias("city"),
        F.coalesce(F.transform("series", lambda e: e["value"]),
                   F.array().cast("array<double>")).alias("values"),
        F.coalesce("series", F.array().cast("array<struct<year:int,value:double>>"))
        .alias("series"), *extra)


def stat_in_range(stats: DataFrame, indicator: str, start_year: int, end_year: int,
                  ids=None) -> DataFrame:
    """E6 ``getStatInRange``: ``(city_id, city, year, value)`` for the years
    in ``[start_year, end_year]`` (P15, inclusive)."""
    s = stats.where((F.col("indicator") == indicator)
                    & F.col("year").between(int(start_year), int(end_year)))
    if ids is not None:
        s = s.join(_ids(stats, ids).select("id"), "id")
    return s.select(
        F.col("id").alias("city_id"), F.col("name").alias("city"), "year", "value")


def stats_in_range(stats: DataFrame, indicators: list[str], start_year: int, end_year: int,
                   ids=None) -> DataFrame:
    """E7 ``getStatsInRange``: ``(city_id, city, indicator, year, value)`` for
    several indicators; a requested indicator with no value in range keeps
    one row with null year and value (its empty map, A9)."""
    wanted = _ids(stats, ids).select(
        "id", "name", F.explode(F.array(*[F.lit(i) for i in indicators])).alias("indicator"))
    s = stats.where(F.col("indicator").isin(list(indicators))
                    & F.col("year").between(int(start_year), int(end_year))) \
        .select("id", "indicator", "year", "value")
    return wanted.join(s, ["id", "indicator"], "left").select(
        F.col("id").alias("city_id"), F.col("name").alias("city"), "indicator", "year", "value")


def range_map(stats: DataFrame, indicators: list[str], start_year: int, end_year: int,
              ids=None) -> DataFrame:
    """E6/E7 in their nested shape: ``(city_id, city, stats map<indicator,
    map<year, value>>)``; requested indicators without values map to an
    empty map."""
    flat = stats_in_range(stats, indicators, start_year, end_year, ids)
    per = flat.groupBy("city_id", "city", "indicator").agg(
        F.array_sort(F.collect_list(
            F.when(F.col("year").isNotNull(), F.struct("year", "value")))).alias("years")) \
        .withColumn("years", last_map(F.col("years"), "year"))
    return per.groupBy("city_id", "city").agg(
        F.map_from_entries(_by_indicator(F.collect_list(F.struct("indicator", "years"))))
        .alias("stats"))
