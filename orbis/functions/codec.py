"""Geometry text: WKT and GeoJSON, all seven types, nested collections, both ways.

Column to column, in the engine.  A text is rewritten in passes of regular expressions that
follow its nesting from the inside out: coordinate tuples, lists of them, simple geometries, then
collections, one level per pass for as many levels as the text has (``aggregate`` over that
many steps), so the depth is not bounded.  Repetition is always over character classes, so the
length of a text is not bounded either.

Texts that are no geometry (unknown type, unbalanced or misplaced parentheses, things that are not
numbers) give null.  ``EMPTY`` is a geometry without coordinates.  Numbers keep their digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orbis.functions.common import col_of, let, memo_expr

# The names of the simple types in both formats.
SIMPLE = {"POINT": "Point", "LINESTRING": "LineString", "POLYGON": "Polygon", "MULTIPOINT": "MultiPoint",
          "MULTILINESTRING": "MultiLineString", "MULTIPOLYGON": "MultiPolygon"}
COLLECTION = ("GEOMETRYCOLLECTION", "GeometryCollection")
CRS = '"crs":{"type":"name","properties":{"name":"urn:ogc:def:crs:EPSG::'

_NUM = r"[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:E[-+]?[0-9]+)?"
_TUPLE = rf"(?<![0-9A-Z.])({_NUM}(?:\s+{_NUM})+)(?![0-9A-Z.])"
_LISTS = r"\[[\[\]0-9,.E+\s-]*\]"


def _replace(text: Column, *rules: tuple[str, str]) -> Column:
    for pattern, by in rules:
        text = F.regexp_replace(text, pattern, by)
    return text


def _where(text: Column, word: str, rewrite) -> Column:
    """``rewrite(text)`` where the text contains ``word`` (bound once), the text itself elsewhere: rules that
    cannot match are not tried."""
    return let(text, lambda t: F.when(t.contains(word), rewrite(t)).otherwise(t))


def _guarded(text: Column, *rules: tuple[str, str, str]) -> Column:
    """Rules in order, each as ``(word, pattern, by)`` and tried only on texts that contain its word."""
    for word, pattern, by in rules:
        text = _where(text, word, lambda t, pattern=pattern, by=by: F.regexp_replace(t, pattern, by))
    return text


def _each_level(text: Column, name: str, pattern: str, by: str) -> Column:
    """The rule once for every time that ``name`` occurs, innermost levels first."""
    return _where(text, name, lambda t: F.aggregate(
        F.sequence(F.lit(1), F.size(F.split(t, name)) - 1), t, lambda acc, _: F.regexp_replace(acc, pattern, by)))


def _body(text: Column) -> Column:
    """Upper case, without the reference system; numbers in the form JSON has; tuples as ``[x,y]``;
    points of a MULTIPOINT without parentheses of their own."""
    t = F.upper(F.trim(F.regexp_replace(text, r"^\s*SRID\s*=\s*[0-9]+\s*;", "")))
    t = _replace(t, (_TUPLE, "[$1]"), (r"(?<=[0-9.])\s+(?=[-+.0-9])", ","))
    t = _guarded(t, ("+", r"([\[,])\+", "$1"), (".", r"([\[,]-?)\.", "$10."), (".", r"\.(?=[\],E])", ".0"),
                 ("0", r"([\[,]-?)0+(?=[0-9])", "$1"))
    return _where(t, "MULTIPOINT", lambda m: F.regexp_replace(
        m, r"(MULTIPOINT\s*\(\s*|\G\s*,\s*)\(\s*(\[[^\]]*\])\s*\)", "$1$2"))


def _is_geometry(body: Column) -> Column:
    """Reduces the structure of a text step by step; one geometry must be left."""
    return _is_structure(F.regexp_replace(body, r"\[[^\]]*\]", "p"))


def _is_plain_geometry(text: Column) -> Column:
    """``_is_geometry`` of a WKT text in upper case whose numbers need not be rewritten."""
    return _is_structure(_guarded(F.regexp_replace(text, _TUPLE, "p"), (
        "MULTIPOINT", r"(MULTIPOINT\s*\(\s*|\G\s*,\s*)\(\s*(p)\s*\)", "$1$2")))


def _is_structure(s: Column) -> Column:
    """``p`` stands for a tuple."""
    kinds = "|".join([*SIMPLE, COLLECTION[0]])
    s = _where(s, "EMPTY", lambda t: F.regexp_replace(t, rf"(?<![A-Z])(?:{kinds})\s+EMPTY", "g"))
    # no space is left before a parenthesis but that after a Z
    s = _guarded(F.regexp_replace(s, r"\s*([(),])\s*", "$1"),
                 ("Z", r"(?<![A-Z])(POINT|LINESTRING|POLYGON)\s+Z?\s*(?=\()", "$1"), ("Z", r"\s+(?=\()", ""))
    return let(s, _reduces)


def _reduces(s: Column) -> Column:
    bad = s.rlike(r",,|\(,|,\)|pp|\(\)")
    s = _guarded(s, ("POINT(p)", r"(?<![A-Z])POINT\(p\)", "g"), ("(", r"\([p,]+\)", "r"),
                 ("r", r"(?<![A-Z])(?:LINESTRING|MULTIPOINT)r", "g"),
                 ("(r", r"(?<![A-Z])(?:POLYGON|MULTILINESTRING)\([r,]+\)", "g"), ("(r", r"\([r,]+\)", "q"),
                 ("MULTIPOLYGON(", r"MULTIPOLYGON\([q,]+\)", "g"))
    return ~bad & (_each_level(s, COLLECTION[0], rf"{COLLECTION[0]}\([g,]+\)", "g") == "g")


def _geojson_of(body: Column) -> Column:
    # no simple type nests deeper
    t = _guarded(body, *[("(", rf"\(\s*({_LISTS})\s*\)", "[$1]")] * 3)
    t = _where(t, "POINT", lambda p: F.regexp_replace(
        p, r"(?<![A-Z])POINT\s*Z?\s*\[(\[[^\]]*\])\]", '{"type":"Point","coordinates":$1}'))
    for name, json in SIMPLE.items():
        t = _where(t, name, lambda own, name=name, json=json: _guarded(
            own, ("EMPTY", rf"(?<![A-Z]){name}\s+EMPTY", f'{{"type":"{json}","coordinates":[]}}'),
            (name, rf"(?<![A-Z]){name}\s*Z?\s*({_LISTS})", f'{{"type":"{json}","coordinates":$1}}')))
    t = _where(t, COLLECTION[0], lambda c: F.regexp_replace(
        c, rf"{COLLECTION[0]}\s+EMPTY", f'{{"type":"{COLLECTION[1]}","geometries":[]}}'))
    t = _each_level(t, COLLECTION[0], rf"{COLLECTION[0]}\s*\(([^()]*)\)", f'{{"type":"{COLLECTION[1]}","geometries":[$1]}}')
    return F.regexp_replace(t, r"\s+", "")


@memo_expr
def wkt_to_geojson(text) -> Column:
    """GeoJSON of a WKT text (any case; ``SRID=n;`` becomes a ``crs`` member), null if it is none."""
    t = col_of(text)
    srid = F.regexp_extract(t, r"^\s*(?i:SRID)\s*=\s*([0-9]+)\s*;", 1)
    json = let(_body(F.regexp_replace(t, r"^\s*(?i:SRID)\s*=", "SRID=")),
               lambda b: F.when(_is_geometry(b), _geojson_of(b)))
    return let(json, lambda j: F.when(srid == "", j).otherwise(
        F.concat(F.left(j, F.char_length(j) - 1), F.lit(f",{CRS}"), srid, F.lit('"}}}'))))


def _wkt_of(json: Column) -> Column:
    t = _where(json, '"crs"', lambda own: _replace(
        own, (r',?"crs":\{"type":"name","properties":\{[^{}]*\}\}', ""),
        (r',?"crs":\{"properties":\{[^{}]*\},"type":"name"\}', ""), (r',?"crs":null', "")))
    t = _guarded(t, ('"bbox"', r',?"bbox":\[[^\]]*\]', ""), ("{,", r"\{,", "{"))
    coords = r'(\[[^{}"]*\])'
    for name, kind in SIMPLE.items():
        t = _where(t, f'"{kind}"', lambda own, name=name, kind=kind: _replace(own, *[
            (pattern, f"{name} $1") for pattern in (rf'\{{"type":"{kind}","coordinates":{coords}\}}',
                                                    rf'\{{"coordinates":{coords},"type":"{kind}"\}}')]))
    t = _replace(t, (r"\[([-+0-9.eE,]+)\]", "<$1>"), (r",(?=[^<>]*>)", " "))
    t = _guarded(t, ("[]", r"([A-Z]) \[\]", "$1 EMPTY"), ("POINT [", r"(?<![A-Z])POINT \[", "?"),
                 ("POINT <", r"(?<![A-Z])POINT <([^>]*)>", "POINT ($1)"))
    t = _guarded(F.translate(t, "<>", ""), (".0", r"([0-9])\.0+(?=[\s,)\]])", "$1"))
    # coordinate lists follow a type; what stays in brackets are the lists of collections
    t = F.replace(F.replace(t, F.lit('"geometries":['), F.lit('"geometries":|')), F.lit("["), F.lit("("))
    t = _each_level(
        t, f'"type":"{COLLECTION[1]}"',
        rf'\{{"type":"{COLLECTION[1]}","geometries":\|([^{{}}|"]*?)\]\}}|\{{"geometries":\|([^{{}}|"]*?)\],"type":"{COLLECTION[1]}"\}}',
        f"{COLLECTION[0]} ($1$2)")
    t = F.replace(t, F.lit(f"{COLLECTION[0]} ()"), F.lit(f"{COLLECTION[0]} EMPTY"))
    return F.regexp_replace(F.replace(t, F.lit("]"), F.lit(")")), r",\s*", ", ")


@memo_expr
def geojson_to_wkt(text) -> Column:
    """WKT of a GeoJSON geometry or Feature (members in any order; ``crs`` becomes ``SRID=n;``),
    null if it is none."""
    json = let(F.get_json_object(col_of(text), "$"), lambda whole: F.when(
        whole.contains("Feature") & (F.get_json_object(whole, "$.type") == "Feature"),
        F.get_json_object(whole, "$.geometry")).otherwise(whole))

    def read(j: Column) -> Column:
        named = F.when(j.contains('"crs"'), F.get_json_object(j, "$.crs.properties.name"))
        prefix = let(F.regexp_extract(named, r"([0-9]+)$", 1),
                     lambda srid: F.when(srid != "", F.concat(F.lit("SRID="), srid, F.lit(";"))).otherwise(""))
        return let(_wkt_of(j), lambda w: F.when(_is_plain_geometry(F.upper(w)), F.concat(prefix, w)))
    return let(json, read)


@memo_expr
def type_name(text) -> Column:
    """The GeoJSON type name of a WKT text, null for any other type."""
    names = F.create_map(*[F.lit(v) for kv in [*SIMPLE.items(), COLLECTION] for v in kv])
    body = F.upper(F.regexp_replace(col_of(text), r"^\s*(?:(?i:SRID)\s*=\s*[0-9]+\s*;)?\s*", ""))
    return F.try_element_at(names, F.regexp_extract(body, r"^([A-Z]+)", 1))


_RINGS = "array<array<array<array<double>>>>"
_PARTS = "array<struct<t:string,pts:array<struct<x:double,y:double>>>>"


def _parts_of_object(obj: Column) -> Column:
    """Parts of one simple GeoJSON geometry; its coordinates padded to the depth of a MultiPolygon."""
    return let(F.struct(F.regexp_extract(obj, r'"type":"([A-Za-z]+)"', 1).alias("kind"),
                        F.regexp_extract(obj, r'"coordinates":(\[[^{}"]*\])', 1).alias("c")),
               lambda o: _parts_of(o["kind"], o["c"]))


def _parts_of(kind: Column, c: Column) -> Column:
    pad = F.when(kind == "Point", 3).when(kind.isin("MultiPoint", "LineString"), 2) \
        .when(kind.isin("Polygon", "MultiLineString"), 1).otherwise(0)
    full = F.concat(F.call_function("repeat", F.lit("["), pad), c, F.call_function("repeat", F.lit("]"), pad))
    polygons = F.from_json(full, _RINGS)

    def points(ring: Column) -> Column:
        return F.transform(ring, lambda xy: F.struct(F.get(xy, 0).alias("x"), F.get(xy, 1).alias("y")))

    def rings(polygon: Column) -> Column:
        return F.transform(polygon, lambda r, i: F.struct(
            F.when(kind.isin("LineString", "MultiLineString"), "ls").when(i == 0, "pl").otherwise("h").alias("t"),
            points(r).alias("pts")))
    each = F.transform(points(F.get(F.get(polygons, 0), 0)), lambda p: F.struct(F.lit("p").alias("t"), F.array(p).alias("pts")))
    some = F.when(kind.isin("Point", "MultiPoint"), each).otherwise(F.flatten(F.transform(polygons, rings)))
    return F.when(c != "[]", some).otherwise(F.array().cast(_PARTS))


def geojson_parts(json: Column) -> Column:
    """All parts of a GeoJSON geometry, its nested members in order (a polygon's holes follow it)."""
    simple = "|".join(SIMPLE.values())
    objects = F.regexp_extract_all(json, F.lit(rf'\{{"type":"(?:{simple})","coordinates":\[[^{{}}"]*\]\}}'), 0)
    # an object on its own may be followed by a crs member
    objects = let(objects, lambda found: F.when(F.size(found) > 0, found).otherwise(F.regexp_extract_all(
        json, F.lit(rf'\{{"type":"(?:{simple})","coordinates":\[[^{{}}"]*\]'), 0)))
    return F.flatten(F.transform(objects, _parts_of_object))
