"""Text → number parsing, ids and tag helpers.

All are Column → Column expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orbis.functions.common import col_of, last_map

# Geometry id prefixes by kind.
NODE_PREFIX = "n"
WAY_PREFIX = "w"
RELATION_PREFIX = "r"


def prefixed_id(prefix: str, id_col) -> Column:
    """public id ``<prefix><number>`` (``n12``, ``w7``, ``r3``)."""
    return F.concat(F.lit(prefix), col_of(id_col).cast("string"))


def to_int(s) -> Column:
    """comma becomes dot, then a strict integer parse; anything else
    (blanks, decimals, null, overflow) is 0."""
    t = F.replace(col_of(s), F.lit(","), F.lit("."))
    ok = t.rlike(r"^[+-]?[0-9]+$")
    return F.coalesce(F.when(ok, t.try_cast("int")), F.lit(0))


def to_double(s) -> Column:
    """comma becomes dot (``359,314`` → 359.314); text that is not a finite
    decimal number (``:``, empty, ``1 234,5``, ``nan``, ``inf``) and null are 0.0."""
    t = F.trim(F.replace(col_of(s), F.lit(","), F.lit(".")))
    v = F.when(t.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), t.try_cast("double"))
    return F.coalesce(F.when(F.abs(v) < F.lit(float("inf")), v), F.lit(0.0))


def sha1_key(id_col) -> Column:
    """F16: binary SHA-1 of the public id (the row key of the old store)."""
    return F.unhex(F.sha1(col_of(id_col).cast("string")))


def tag_value(tags, key: str, default: str | None = None) -> Column:
    """Value of tag ``key`` from an ``array<struct<key,value>>`` tag list; the
    last entry wins.  F17 is ``tag_value(tags, 'type', 'unknown')``."""
    hits = F.filter(col_of(tags), lambda t: t["key"] == F.lit(key))
    v = F.get(hits, F.size(hits) - 1)["value"]
    return F.coalesce(v, F.lit(default)) if default is not None else v


def relation_type(tags) -> Column:
    """F17 (and V1, the old UDF): relation type from its tags, ``unknown``
    when absent -- a column expression, no UDF."""
    return tag_value(tags, "type", "unknown")


def tag_map(tags) -> Column:
    """Tag list → ``map<string,string>`` (empty list → empty map);
    a repeated key keeps its last value, as the old store kept the last put.  Tags live in their own
    map, so a tag named like a metadata field cannot overwrite it (Q21)."""
    c = col_of(tags)
    return F.when(F.size(c) > 0, last_map(c, "key")).otherwise(
        F.create_map().cast("map<string,string>"))


def get_stat(stats_map, key: str, empty: str = "map<int,double>") -> Column:
    """the series of one indicator from a ``map<indicator, series>``
    (``stat_maps`` gives ``map<year, value>`` series); an empty series of
    type ``empty`` when the indicator is missing."""
    m = col_of(stats_map)
    blank = F.create_map() if empty.startswith("map") else F.array()
    return F.coalesce(F.try_element_at(m, F.lit(key)), blank.cast(empty))


def region_from_url(url) -> Column:
    """region name of an extract URL (``.../italy/nord-ovest-latest.osm.pbf``
    → ``nord-ovest``); empty when the URL does not name one."""
    return F.regexp_extract(col_of(url), r"([^/]+)-latest", 1)


def url_parent(url) -> Column:
    """parent of a URL, up to and including its last ``/``."""
    return F.regexp_extract(col_of(url), r".+/", 0)
