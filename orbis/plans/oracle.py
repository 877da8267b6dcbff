"""Equivalent DuckDB SQL for every registered query (the correctness oracle).

The SQL restates each query from the driver tables alone: fixture views, geometry
building, rings of relations, geohash cells, covers, box tests.  It shares the
fixed values (alphabet, bit widths, fixture parameters) and the rule for scaling a
coordinate with the Spark side; cells are printed character by character from
bit tests here, while the Spark side uses Morton spreading.
"""

from __future__ import annotations

from orbis.functions.geohash import (BITS, GEOHASH_ALPHABET, MAX_CELL_LENGTH, MIN_CELL_LENGTH,
                                     lat_bits, lon_bits)
from orbis.plans import params as P
from orbis.plans.oracle_blocks import added_region, blocks, overlapping_regions
from orbis.sources import fixtures as FX

# ------------------------------------------------------------------ fixtures

STAT_CSV = f"""
stat_g AS (
  SELECT n_name, year(o_orderdate) AS y, o_orderpriority AS p, count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey
              JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2, 3),
stat_csv AS (
  SELECT n_name AS CITIES, CAST(y AS VARCHAR) AS TIME, p AS INDIC_UR,
         CASE WHEN n % 3 = 0 THEN ':'
              ELSE concat(CAST(n // 10 AS VARCHAR), ',', CAST(n % 10 AS VARCHAR)) END AS Value
  FROM stat_g),
loc AS (SELECT c_nationkey, min(c_custkey) AS k FROM customer
        WHERE c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') GROUP BY c_nationkey),
names AS (SELECT CAST(loc.k AS VARCHAR) AS id, n_name AS name
          FROM nation LEFT JOIN loc ON loc.c_nationkey = n_nationkey)"""


def to_int_sql(s: str) -> str:
    t = f"replace({s}, ',', '.')"
    return (f"COALESCE(CASE WHEN regexp_matches({t}, '^[+-]?[0-9]+$') "
            f"THEN TRY_CAST({t} AS INTEGER) END, 0)")


def to_double_sql(s: str) -> str:
    t = f"replace({s}, ',', '.')"
    return (f"COALESCE(CASE WHEN regexp_full_match(trim({t}), "
            f"'[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') "
            f"THEN TRY_CAST(trim({t}) AS DOUBLE) END, 0.0)")


STATS = STAT_CSV + f""",
stats AS (
  SELECT 'r' || nm.id AS id, nm.name,
         s.INDIC_UR AS indicator,
         CASE WHEN s.CITIES IS NOT NULL THEN {to_int_sql('s.TIME')} END AS year,
         CASE WHEN s.CITIES IS NOT NULL THEN {to_double_sql('s.Value')} END AS value,
         s.Value AS value_raw
  FROM names nm LEFT JOIN stat_csv s ON s.CITIES = nm.name
  WHERE nm.id IS NOT NULL)"""


def _stats_query(body: str) -> str:
    return f"WITH {STATS}\n{body}"


# ------------------------------------------------------------------ queries

def stat_series() -> str:
    return _stats_query("SELECT id, name, indicator, year, value, value_raw FROM stats")


def stats_upsert() -> str:
    a = P.UPSERT
    value = "CASE WHEN s.Value = ':' THEN '0,5' ELSE '1' || s.Value END"
    return f"""WITH {STAT_CSV},
csv AS (
  SELECT s.CITIES, s.TIME, s.INDIC_UR,
         CASE WHEN n.n_regionkey = {a['region']} AND s.TIME >= '{a['until']}' THEN {value} ELSE s.Value END AS Value
  FROM stat_csv s JOIN nation n ON n.n_name = s.CITIES
  WHERE s.TIME <= '{a['until']}' OR n.n_regionkey = {a['region']})
SELECT 'r' || nm.id AS id, nm.name, c.INDIC_UR AS indicator, CASE WHEN c.CITIES IS NOT NULL THEN {to_int_sql('c.TIME')} END AS year,
       CASE WHEN c.CITIES IS NOT NULL THEN {to_double_sql('c.Value')} END AS value, c.Value AS value_raw
FROM names nm LEFT JOIN csv c ON c.CITIES = nm.name WHERE nm.id IS NOT NULL"""


def stat_maps() -> str:
    a = P.MULTI_COMPARE
    return _stats_query(f"""
SELECT id, name, CAST(count(DISTINCT indicator) AS INTEGER) AS n_indicators,
       CAST(count(*) FILTER (WHERE indicator = '{a['indicator']}') AS INTEGER) AS n_years,
       coalesce(string_agg(year || '=' || {fmt_sql('value')}, ' ' ORDER BY year) FILTER (WHERE indicator = '{a['indicator']}'), '') AS series
FROM stats WHERE indicator IS NOT NULL GROUP BY id, name""")


def stat_from_all() -> str:
    a = P.STAT_FROM_ALL
    return _stats_query(f"""
SELECT id AS city_id, name AS city, year, value FROM stats
WHERE indicator = '{a['indicator']}' AND year = {a['year']} AND value {a['op']} {float(a['threshold'])}""")


def stat_from_all_equal() -> str:
    a = P.STAT_FROM_ALL_EQUAL
    return _stats_query(f"""
SELECT id AS city_id, name AS city, year, value FROM stats
WHERE indicator = '{a['indicator']}' AND year = {a['year']} AND value = {float(a['threshold'])}""")


def stat_from_all_first_year() -> str:
    a = P.STAT_FROM_ALL_FIRST_YEAR
    return _stats_query(f"""
, first AS (
  SELECT id, name, min(year) AS year FROM stats WHERE indicator = '{a['indicator']}'
  GROUP BY id, name),
pick AS (
  SELECT f.id, f.name, f.year, min(s.value) AS value
  FROM first f JOIN stats s ON s.id = f.id AND s.name = f.name AND s.year = f.year
                            AND s.indicator = '{a['indicator']}'
  GROUP BY f.id, f.name, f.year)
SELECT id AS city_id, name AS city, year, value FROM pick
WHERE value {a['op']} {float(a['threshold'])}""")


def multi_compare_stat() -> str:
    a = P.MULTI_COMPARE
    return _stats_query(f"""
, cities AS (SELECT DISTINCT id, name FROM stats),
s AS (SELECT id, year, value,
             CAST(row_number() OVER (PARTITION BY id ORDER BY year, value) - 1 AS INTEGER) AS pos
      FROM stats WHERE indicator = '{a['indicator']}')
SELECT c.id AS city_id, c.name AS city, s.pos, s.year, s.value
FROM cities c LEFT JOIN s ON s.id = c.id""")


def stat_in_range() -> str:
    a = P.STAT_IN_RANGE
    return _stats_query(f"""
SELECT id AS city_id, name AS city, year, value FROM stats
WHERE indicator = '{a['indicator']}' AND year BETWEEN {a['start']} AND {a['end']}""")


def stats_in_range() -> str:
    a = P.STATS_IN_RANGE
    inds = ", ".join(f"('{i}')" for i in a["indicators"])
    return _stats_query(f"""
, cities AS (SELECT DISTINCT id, name FROM stats),
wanted AS (SELECT c.id, c.name, i.indicator FROM cities c, (VALUES {inds}) AS i(indicator)),
s AS (SELECT id, indicator, year, value FROM stats
      WHERE year BETWEEN {a['start']} AND {a['end']})
SELECT w.id AS city_id, w.name AS city, w.indicator, s.year, s.value
FROM wanted w LEFT JOIN s ON s.id = w.id AND s.indicator = w.indicator""")


# ------------------------------------------------------------ geometry SQL

def fmt_sql(x: str) -> str:
    return f"regexp_replace(CAST({x} AS VARCHAR), '\\.0$', '')"


def _scaled_sql(v: str, lo: float, span: float) -> str:
    """Count of grid boundaries lo + i*span/2^30 at or below v (interval
    halving), corrected by one step against the exact boundary."""
    top = (1 << BITS) - 1
    step = f"({span}e0 / {float(1 << BITS)}e0)"

    def clamp(e):
        return f"greatest(least({e}, {top}), 0)"
    i0 = clamp(f"CAST(floor(({v} - ({lo}e0)) / {span}e0 * {float(1 << BITS)}e0) AS BIGINT)")
    b0 = f"(({lo}e0) + ({i0}) * {step})"
    return clamp(f"CASE WHEN {v} < {b0} THEN ({i0}) - 1 WHEN {v} >= {b0} + {step} "
                 f"THEN ({i0}) + 1 ELSE ({i0}) END")


def lon_int_sql(x: str) -> str:
    return _scaled_sql(x, -180.0, 360.0)


def lat_int_sql(y: str) -> str:
    return _scaled_sql(y, -90.0, 180.0)


def geohash_ints_sql(xi: str, yi: str) -> str:
    """12-character cell of two 30-bit integers, one character at a time:
    bit p of the interleaved code is longitude bit 29 - p/2 (p even) or
    latitude bit 29 - (p-1)/2 (p odd)."""
    chars = []
    for k in range(MAX_CELL_LENGTH):
        terms = []
        for j in range(5):
            p = 5 * k + j
            src = xi if p % 2 == 0 else yi
            terms.append(f"((((({src}) >> {BITS - 1 - p // 2}) & 1)) << {4 - j})")
        chars.append(f"substr('{GEOHASH_ALPHABET}', CAST(({' | '.join(terms)}) AS INTEGER) + 1, 1)")
    return " || ".join(chars)


def geohash_sql(x: str, y: str) -> str:
    return geohash_ints_sql(lon_int_sql(x), lat_int_sql(y))


def cover_ctes(name: str, src: str) -> str:
    """CTEs ``{name}_cl`` (gid, L, n_cells) and ``{name}_cells`` (gid, cell)
    for boxes ``src(gid, minx, miny, maxx, maxy)``."""
    def n(L):
        sx, sy = BITS - lon_bits(L), BITS - lat_bits(L)
        return f"(((x1 >> {sx}) - (x0 >> {sx}) + 1) * ((y1 >> {sy}) - (y0 >> {sy}) + 1))"
    picks = ", ".join(f"CASE WHEN {n(L)} <= {n(MIN_CELL_LENGTH)} THEN {L} ELSE {MIN_CELL_LENGTH} END"
                      for L in range(MIN_CELL_LENGTH + 1, MAX_CELL_LENGTH + 1))
    return f"""
{name}_ci AS (
  SELECT gid, {lon_int_sql('minx')} AS x0, {lon_int_sql('maxx')} AS x1,
              {lat_int_sql('miny')} AS y0, {lat_int_sql('maxy')} AS y1 FROM {src}),
{name}_cl AS (
  SELECT gid, x0, x1, y0, y1, greatest({MIN_CELL_LENGTH}, {picks}) AS L FROM {name}_ci),
{name}_cg AS (
  SELECT gid, L, {BITS} - (5 * L + 1) // 2 AS sx, {BITS} - (5 * L) // 2 AS sy,
         x0 >> ({BITS} - (5 * L + 1) // 2) AS c0, x1 >> ({BITS} - (5 * L + 1) // 2) AS c1,
         y0 >> ({BITS} - (5 * L) // 2) AS r0, y1 >> ({BITS} - (5 * L) // 2) AS r1
  FROM {name}_cl),
{name}_cc AS (SELECT gid, L, sx, sy, r0, r1, unnest(range(c0, c1 + 1)) AS c FROM {name}_cg),
{name}_cr AS (SELECT gid, L, sx, sy, c, unnest(range(r0, r1 + 1)) AS r FROM {name}_cc),
{name}_cells AS (
  SELECT gid, L, left({geohash_ints_sql('(c << sx)', '(r << sy)')}, CAST(L AS INTEGER)) AS cell
  FROM {name}_cr)"""


VALID_TYPES_SQL = "('route', 'site', 'public_transport', 'street', 'waterway')"

GEOM = f"""
nodes_raw AS (
  SELECT p_partkey AS id,
         {FX.LON0}e0 + CAST((p_partkey * {FX.NODE_LON_MUL}) % {FX.LON_SPAN} AS DOUBLE) / 1000.0e0 AS x,
         {FX.LAT0}e0 + CAST((p_partkey * {FX.NODE_LAT_MUL}) % {FX.LAT_SPAN} AS DOUBLE) / 1000.0e0 AS y,
         p_size % 2 = 0 AS tagged, p_type AS place, p_brand AS brand
  FROM part),
refs AS (
  SELECT l_orderkey AS way_id,
         CAST(row_number() OVER (PARTITION BY l_orderkey
              ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS INTEGER) AS idx,
         l_partkey AS node_id FROM lineitem),
refn AS (
  SELECT way_id, count(*) AS n, count(DISTINCT node_id) AS dn, arg_min(node_id, idx) AS first_node
  FROM refs GROUP BY way_id),
allrefs AS (
  SELECT way_id, idx, node_id FROM refs
  UNION ALL
  SELECT way_id, CAST(n AS INTEGER), first_node FROM refn WHERE way_id % 3 = 0 AND dn >= 3),
wpts AS (SELECT r.way_id, r.idx, n.x, n.y FROM allrefs r JOIN nodes_raw n ON n.id = r.node_id),
wseg AS (
  SELECT way_id, idx, x, y,
         lead(x) OVER (PARTITION BY way_id ORDER BY idx) AS nx,
         lead(y) OVER (PARTITION BY way_id ORDER BY idx) AS ny FROM wpts),
whead AS (
  SELECT way_id, count(*) AS np, arg_min(x, idx) AS x0, arg_min(y, idx) AS y0,
         arg_max(x, idx) AS xl, arg_max(y, idx) AS yl,
         min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy,
         string_agg({fmt_sql('x')} || ' ' || {fmt_sql('y')}, ', ' ORDER BY idx) AS coords
  FROM wpts GROUP BY way_id),
wcls AS (
  SELECT *, CASE WHEN x0 = xl AND y0 = yl AND np >= 4 THEN 'pl'
                 WHEN NOT (x0 = xl AND y0 = yl) AND np >= 2 THEN 'ls' END AS cls
  FROM whead),
wraw AS (
  SELECT w.way_id,
    sum((s.x - w.x0) * (s.ny - w.y0) - (s.nx - w.x0) * (s.y - w.y0)) AS a,
    sum(((s.x - w.x0) * (s.ny - w.y0) - (s.nx - w.x0) * (s.y - w.y0)) * (w.x0 + s.x + s.nx)) AS cx,
    sum(((s.x - w.x0) * (s.ny - w.y0) - (s.nx - w.x0) * (s.y - w.y0)) * (w.y0 + s.y + s.ny)) AS cy,
    sum(sqrt((s.nx - s.x) * (s.nx - s.x) + (s.ny - s.y) * (s.ny - s.y))) AS len,
    sum(sqrt((s.nx - s.x) * (s.nx - s.x) + (s.ny - s.y) * (s.ny - s.y)) * (s.x + s.nx) / 2) AS lx,
    sum(sqrt((s.nx - s.x) * (s.nx - s.x) + (s.ny - s.y) * (s.ny - s.y)) * (s.y + s.ny) / 2) AS ly
  FROM wcls w JOIN wseg s ON s.way_id = w.way_id AND s.nx IS NOT NULL
  WHERE w.cls IS NOT NULL GROUP BY w.way_id),
ways AS (
  SELECT c.way_id, 'w' || c.way_id AS id, c.cls, c.np, c.minx, c.miny, c.maxx, c.maxy,
         CASE WHEN c.cls = 'pl' THEN sign(r.a) ELSE 0 END * r.a AS a,
         CASE WHEN c.cls = 'pl' THEN sign(r.a) ELSE 0 END * r.cx AS cx,
         CASE WHEN c.cls = 'pl' THEN sign(r.a) ELSE 0 END * r.cy AS cy,
         r.len, r.lx, r.ly,
         CASE WHEN r.len = 0 THEN 1.0e0 ELSE 0.0e0 END AS pn,
         CASE WHEN r.len = 0 THEN c.x0 ELSE 0.0e0 END AS px,
         CASE WHEN r.len = 0 THEN c.y0 ELSE 0.0e0 END AS py,
         CASE WHEN c.cls = 'ls' THEN 'LINESTRING (' || c.coords || ')'
              ELSE 'POLYGON ((' || c.coords || '))' END AS wkt,
         o.o_orderpriority AS priority, o.o_orderstatus AS status
  FROM wcls c JOIN wraw r ON r.way_id = c.way_id
  LEFT JOIN orders o ON o.o_orderkey = c.way_id
  WHERE c.cls IS NOT NULL),
rel AS (
  SELECT c_custkey AS rel_id, c_name AS name,
         CASE c_mktsegment {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in FX.SEGMENT_TO_RELATION_TYPE.items())}
              ELSE '{FX.OTHER_RELATION_TYPE}' END AS rel_type
  FROM customer),
rmem AS (
  SELECT o_custkey AS rel_id, o_orderkey AS pos, o_orderkey AS member_id, 'Way' AS member_type FROM orders
  UNION ALL
  SELECT c_custkey, -1, c_custkey, 'Node' FROM customer),
rm AS (
  SELECT m.rel_id, m.pos, m.member_id, m.member_type FROM rmem m JOIN rel r ON r.rel_id = m.rel_id
  WHERE r.rel_type IN {VALID_TYPES_SQL} AND NOT starts_with(m.member_type, 'R')),
rparts AS (
  SELECT rm.rel_id, rm.pos, 'p' AS t, 1 AS np, n.x AS minx, n.y AS miny, n.x AS maxx, n.y AS maxy,
         0.0e0 AS a, 0.0e0 AS cx, 0.0e0 AS cy, 0.0e0 AS len, 0.0e0 AS lx, 0.0e0 AS ly,
         1.0e0 AS pn, n.x AS px, n.y AS py,
         'POINT (' || {fmt_sql('n.x')} || ' ' || {fmt_sql('n.y')} || ')' AS wkt
  FROM rm JOIN nodes_raw n ON rm.member_type = 'Node' AND n.id = rm.member_id
  UNION ALL
  SELECT rm.rel_id, rm.pos, w.cls, w.np, w.minx, w.miny, w.maxx, w.maxy, w.a, w.cx, w.cy,
         w.len, w.lx, w.ly, w.pn, w.px, w.py, w.wkt
  FROM rm JOIN ways w ON rm.member_type = 'Way' AND w.way_id = rm.member_id),
rsum AS (
  SELECT rel_id, count(*) AS n_parts, sum(np) AS np, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx,
         max(maxy) AS maxy, sum(a) AS a, sum(cx) AS cx, sum(cy) AS cy, sum(len) AS len,
         sum(lx) AS lx, sum(ly) AS ly, sum(pn) AS pn, sum(px) AS px, sum(py) AS py,
         'GEOMETRYCOLLECTION (' || string_agg(wkt, ', ' ORDER BY pos) || ')' AS wkt
  FROM rparts GROUP BY rel_id),
rels AS (
  SELECT s.*, 'r' || s.rel_id AS id, r.rel_type, r.name FROM rsum s JOIN rel r ON r.rel_id = s.rel_id),
ring AS (
  SELECT m.rel_id, w.way_id, w.a AS area, w.np, w.minx, w.miny, w.maxx, w.maxy, w.a, w.cx, w.cy,
         w.len, w.lx, w.ly, w.pn, w.px, w.py, h.x0, h.y0, h.coords
  FROM rmem m JOIN rel r ON r.rel_id = m.rel_id AND r.rel_type IN ('multipolygon', 'boundary')
  JOIN ways w ON m.member_type = 'Way' AND w.way_id = m.member_id AND w.cls = 'pl'
  JOIN whead h ON h.way_id = w.way_id),
ring_pair AS (
  SELECT i.rel_id, i.way_id AS i, j.way_id AS j, j.area AS j_area
  FROM ring i JOIN ring j ON j.rel_id = i.rel_id AND j.area > i.area
   AND i.minx >= j.minx AND i.maxx <= j.maxx AND i.miny >= j.miny AND i.maxy <= j.maxy),
ring_free AS (
  SELECT p.rel_id, p.i, p.j, arg_min(v.x, v.idx) AS x, arg_min(v.y, v.idx) AS y
  FROM ring_pair p JOIN wpts v ON v.way_id = p.i
  WHERE NOT EXISTS (SELECT 1 FROM wseg s WHERE s.way_id = p.j AND s.nx IS NOT NULL
    AND (s.nx - s.x) * (v.y - s.y) - (s.ny - s.y) * (v.x - s.x) = 0
    AND v.x BETWEEN least(s.x, s.nx) AND greatest(s.x, s.nx)
    AND v.y BETWEEN least(s.y, s.ny) AND greatest(s.y, s.ny))
  GROUP BY p.rel_id, p.i, p.j),
ring_test AS (
  SELECT p.*, coalesce(f.x, (s0.x + s0.nx) / 2) AS x, coalesce(f.y, (s0.y + s0.ny) / 2) AS y
  FROM ring_pair p JOIN wseg s0 ON s0.way_id = p.i AND s0.idx = 0
  LEFT JOIN ring_free f ON f.rel_id = p.rel_id AND f.i = p.i AND f.j = p.j),
ring_in AS (
  SELECT t.rel_id, t.i, t.j, t.j_area FROM ring_test t JOIN wseg s ON s.way_id = t.j AND s.nx IS NOT NULL
  WHERE (s.y > t.y) <> (s.ny > t.y) AND t.x < s.x + (t.y - s.y) * (s.nx - s.x) / (s.ny - s.y)
  GROUP BY t.rel_id, t.i, t.j, t.j_area HAVING count(*) % 2 = 1),
ring_parent AS (SELECT rel_id, i, arg_min(j, j_area) AS parent FROM ring_in GROUP BY rel_id, i),
shell AS (SELECT rel_id, arg_max(way_id, area) AS way_id FROM ring GROUP BY rel_id),
poly_ring AS (
  SELECT r.*, 1 AS sign FROM ring r JOIN shell s ON s.rel_id = r.rel_id AND s.way_id = r.way_id
  UNION ALL
  SELECT r.*, -1 FROM ring r JOIN shell s ON s.rel_id = r.rel_id
  JOIN ring_parent p ON p.rel_id = r.rel_id AND p.i = r.way_id AND p.parent = s.way_id),
psum AS (
  SELECT rel_id, count(*) AS n_rings, sum(np) AS np, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx,
         max(maxy) AS maxy, sum(sign * a) AS a, sum(sign * cx) AS cx, sum(sign * cy) AS cy, sum(len) AS len,
         sum(lx) AS lx, sum(ly) AS ly, sum(pn) AS pn, sum(px) AS px, sum(py) AS py,
         'POLYGON (' || string_agg('(' || coords || ')', ', ' ORDER BY sign DESC, x0, y0) || ')' AS wkt
  FROM poly_ring GROUP BY rel_id),
polys AS (
  SELECT s.*, 'r' || s.rel_id AS id, r.rel_type, r.name FROM psum s JOIN rel r ON r.rel_id = s.rel_id),
geoms AS (
  SELECT 'n' AS kind, 'n' || id AS id, x AS minx, y AS miny, x AS maxx, y AS maxy,
         x AS cx_c, y AS cy_c FROM nodes_raw WHERE tagged
  UNION ALL
  SELECT 'w', id, minx, miny, maxx, maxy, {{CX}}, {{CY}} FROM ways
  UNION ALL
  SELECT 'r', id, minx, miny, maxx, maxy, {{CX}}, {{CY}} FROM rels
  UNION ALL
  SELECT 'r', id, minx, miny, maxx, maxy, {{CX}}, {{CY}} FROM polys),
gbox AS (SELECT id AS gid, minx, miny, maxx, maxy FROM geoms WHERE kind <> 'n'),
{cover_ctes('gcov', 'gbox').strip()},
cell_index AS (
  SELECT cell, gid AS id FROM gcov_cells
  UNION ALL
  SELECT {geohash_sql('minx', 'miny')} AS cell, id FROM geoms WHERE kind = 'n')"""

CENTROID_X = ("CASE WHEN abs(a) > 0 THEN cx / 3.0e0 / a WHEN len > 0 THEN lx / len "
              "WHEN pn > 0 THEN px / pn END")
CENTROID_Y = ("CASE WHEN abs(a) > 0 THEN cy / 3.0e0 / a WHEN len > 0 THEN ly / len "
              "WHEN pn > 0 THEN py / pn END")
GEOM = GEOM.replace("{CX}", CENTROID_X).replace("{CY}", CENTROID_Y)


def _geom_query(body: str) -> str:
    return f"WITH {GEOM}\n{body}"


def nodes() -> str:
    return _geom_query(f"""
SELECT 'n' || id AS id, 'p' AS class,
       'POINT (' || {fmt_sql('x')} || ' ' || {fmt_sql('y')} || ')' AS wkt, x, y,
       {geohash_sql('x', 'y')} AS cell, place, brand
FROM nodes_raw WHERE tagged""")


def ways() -> str:
    return _geom_query(f"""
, cells AS (SELECT gid, min(L) AS cover_len, count(*) AS n_cells,
                   string_agg(cell, ' ' ORDER BY cell) AS cells
            FROM gcov_cells WHERE starts_with(gid, 'w') GROUP BY gid)
SELECT w.id, w.cls AS class, CAST(w.np AS INTEGER) AS n_points, w.wkt,
       round({CENTROID_X}, 6) AS cx, round({CENTROID_Y}, 6) AS cy,
       w.minx, w.miny, w.maxx, w.maxy,
       CAST(c.cover_len AS INTEGER) AS cover_len, CAST(c.n_cells AS INTEGER) AS n_cells, c.cells,
       w.priority, w.status
FROM ways w JOIN cells c ON c.gid = w.id""")


def relations() -> str:
    return _geom_query(f"""
, cells AS (SELECT gid, min(L) AS cover_len, count(*) AS n_cells,
                   string_agg(cell, ' ' ORDER BY cell) AS cells
            FROM gcov_cells WHERE starts_with(gid, 'r') GROUP BY gid)
SELECT r.id, 'gc' AS class, r.rel_type, r.name, CAST(r.n_parts AS INTEGER) AS n_parts, r.wkt,
       round({CENTROID_X}, 6) AS cx, round({CENTROID_Y}, 6) AS cy,
       r.minx, r.miny, r.maxx, r.maxy,
       CAST(c.cover_len AS INTEGER) AS cover_len, CAST(c.n_cells AS INTEGER) AS n_cells, c.cells
FROM rels r JOIN cells c ON c.gid = r.id""")


def relation_rings() -> str:
    """Stored polygons (closed member ways) and the faces between the streets of the blocks."""
    return f"""WITH RECURSIVE {GEOM.strip()},
{blocks().strip()},
bbox AS (SELECT id AS gid, minx, miny, maxx, maxy FROM block_polys),
{cover_ctes('bcov', 'bbox').strip()},
cells AS (SELECT gid, min(L) AS cover_len, count(*) AS n_cells
          FROM (SELECT gid, L FROM gcov_cells WHERE starts_with(gid, 'r') UNION ALL SELECT gid, L FROM bcov_cells)
          GROUP BY gid),
all_polys AS (
  SELECT id, rel_type, n_rings, wkt, {CENTROID_X} AS cx, {CENTROID_Y} AS cy, minx, miny, maxx, maxy FROM polys
  UNION ALL SELECT id, rel_type, n_rings, wkt, cx, cy, minx, miny, maxx, maxy FROM block_polys)
SELECT r.id, 'pl' AS class, r.rel_type, CAST(r.n_rings AS INTEGER) AS n_rings, r.wkt,
       round(cx, 6) AS cx, round(cy, 6) AS cy, r.minx, r.miny, r.maxx, r.maxy,
       CAST(c.cover_len AS INTEGER) AS cover_len, CAST(c.n_cells AS INTEGER) AS n_cells
FROM all_polys r JOIN cells c ON c.gid = r.id"""


def cell_index() -> str:
    return _geom_query("""
SELECT cell, count(*) AS n_ids, min(id) AS min_id, max(id) AS max_id
FROM cell_index GROUP BY cell""")


# ------------------------------------------------------------ spatial SQL

def _points_sql() -> str:
    a = P.FIND_BY_TAGS
    n_s, n_r = len(a["searches"]), len(a["radii_m"])
    keys = " ".join(f"WHEN {i} THEN '{k}'" for i, (k, _) in enumerate(a["searches"]))
    vals = " ".join(f"WHEN {i} THEN '{v}'" for i, (_, v) in enumerate(a["searches"]))
    rads = " ".join(f"WHEN {i} THEN {r}" for i, r in enumerate(a["radii_m"]))
    return f"""
pts0 AS (
  SELECT s_suppkey AS qid,
         {FX.LON0}e0 + CAST((s_suppkey * {FX.POINT_LON_MUL}) % {FX.LON_SPAN} AS DOUBLE) / 1000.0e0
           + {FX.POINT_OFFSET}e0 AS lon,
         {FX.LAT0}e0 + CAST((s_suppkey * {FX.POINT_LAT_MUL}) % {FX.LAT_SPAN} AS DOUBLE) / 1000.0e0
           + {FX.POINT_OFFSET}e0 AS lat,
         CASE s_suppkey % {n_s} {keys} END AS key,
         CASE s_suppkey % {n_s} {vals} END AS value,
         CASE (s_suppkey // {n_s}) % {n_r} {rads} END AS meters
  FROM supplier)"""


def _box_sql(src: str, meters: str) -> str:
    lat = "greatest(least(lat, 89.999999e0), -89.999999e0)"
    dx = f"(CAST({meters} AS DOUBLE) / (6378137.0e0 * cos(pi() * {lat} / 180.0e0))) * 180.0e0 / pi()"
    dy = f"(CAST({meters} AS DOUBLE) / 6378137.0e0) * 180.0e0 / pi()"
    return f"""SELECT *, lon - {dx} AS bx0, lat - {dy} AS by0, lon + {dx} AS bx1, lat + {dy} AS by1
  FROM {src}"""


# point parts, polygon flags and line segments of every searchable geometry
PARTS = """
gpts AS (
  SELECT 'n' || id AS id, x, y FROM nodes_raw WHERE tagged
  UNION ALL
  SELECT 'r' || rm.rel_id, n.x, n.y FROM rm JOIN nodes_raw n
    ON rm.member_type = 'Node' AND n.id = rm.member_id),
gpoly AS (
  SELECT id FROM ways WHERE cls = 'pl'
  UNION
  SELECT 'r' || rm.rel_id FROM rm JOIN ways w
    ON rm.member_type = 'Way' AND w.way_id = rm.member_id AND w.cls = 'pl'
  UNION
  SELECT id FROM polys),
gsegs AS (
  SELECT w.id, s.x, s.y, s.nx, s.ny FROM ways w JOIN wseg s
    ON s.way_id = w.way_id AND s.nx IS NOT NULL WHERE w.cls = 'ls'
  UNION ALL
  SELECT 'r' || rm.rel_id, s.x, s.y, s.nx, s.ny FROM rm JOIN ways w
    ON rm.member_type = 'Way' AND w.way_id = rm.member_id AND w.cls = 'ls'
    JOIN wseg s ON s.way_id = w.way_id AND s.nx IS NOT NULL),
gtags AS (
  SELECT 'n' || id AS id, 'place' AS key, place AS value FROM nodes_raw WHERE tagged
  UNION ALL SELECT 'n' || id, 'brand', brand FROM nodes_raw WHERE tagged
  UNION ALL SELECT id, 'priority', priority FROM ways
  UNION ALL SELECT id, 'status', status FROM ways
  UNION ALL SELECT id, 'type', rel_type FROM rels
  UNION ALL SELECT id, 'name', name FROM rels
  UNION ALL SELECT id, 'type', rel_type FROM polys
  UNION ALL SELECT id, 'name', name FROM polys)"""


def _contains_sql(p: str, g: str) -> str:
    """F13 between box columns of ``p`` and geometry ``g`` (by id)."""
    inside = (f"{g}.minx >= {p}.bx0 AND {g}.maxx <= {p}.bx1 AND "
              f"{g}.miny >= {p}.by0 AND {g}.maxy <= {p}.by1")
    on_edge = (f"((s.x = {p}.bx0 AND s.nx = {p}.bx0) OR (s.x = {p}.bx1 AND s.nx = {p}.bx1) OR "
               f"(s.y = {p}.by0 AND s.ny = {p}.by0) OR (s.y = {p}.by1 AND s.ny = {p}.by1))")
    interior = (f"(EXISTS (SELECT 1 FROM gpoly q WHERE q.id = {g}.id) OR "
                f"EXISTS (SELECT 1 FROM gpts t WHERE t.id = {g}.id AND t.x > {p}.bx0 AND "
                f"t.x < {p}.bx1 AND t.y > {p}.by0 AND t.y < {p}.by1) OR "
                f"EXISTS (SELECT 1 FROM gsegs s WHERE s.id = {g}.id AND NOT {on_edge}))")
    return f"({inside} AND {interior})"


def _by_tags_sql(points: str, op: str, meters: str) -> str:
    return f"""WITH {GEOM},
{PARTS.strip()},
{_points_sql().strip()},
pts AS ({_box_sql(points, meters)})
SELECT p.qid, g.id, g.kind,
       CASE WHEN g.kind = 'n' THEN 'p' WHEN g.id IN (SELECT id FROM polys) THEN 'pl' WHEN g.kind = 'r' THEN 'gc'
            ELSE (SELECT cls FROM ways w WHERE w.id = g.id) END AS class
FROM pts p JOIN gtags t ON t.key = p.key AND t.value {op} p.value
JOIN geoms g ON g.id = t.id
WHERE {_contains_sql('p', 'g')}"""


def find_by_tags() -> str:
    return _by_tags_sql("pts0", P.FIND_BY_TAGS["op"], "meters")


def find_by_tags_not() -> str:
    a = P.FIND_BY_TAGS_NOT
    pts = f"(SELECT qid, lon, lat, '{a['key']}' AS key, '{a['value']}' AS value FROM pts0)"
    point = f"'POINT (' || {fmt_sql('n.x')} || ' ' || {fmt_sql('n.y')} || ')'"
    return f"""SELECT f.*, {point} AS wkt FROM ({_by_tags_sql(pts, "<>", str(a["meters"]))}) f
JOIN (WITH {GEOM} SELECT 'n' || id AS nid, x, y FROM nodes_raw) n ON n.nid = f.id"""


def _samples_sql(a) -> str:
    return f"""WITH {STATS},
{GEOM.strip()},
{PARTS.strip()},
{_points_sql().strip()},
pts AS ({_box_sql('pts0', str(a['meters']))}),
samples AS (
  SELECT id, value FROM stats WHERE indicator = '{a['indicator']}' AND year = {a['year']}
    AND value_raw IS NOT NULL AND value_raw <> ''),
pairs AS (
  SELECT p.qid, g.id, s.value,
         CASE WHEN p.lon = g.cx_c AND p.lat = g.cy_c THEN 0.0e0 ELSE
         6371.01e0 * acos(greatest(least(
           sin(radians(p.lat)) * sin(radians(g.cy_c))
           + cos(radians(p.lat)) * cos(radians(g.cy_c)) * cos(radians(p.lon) - radians(g.cx_c)),
           1.0e0), -1.0e0)) END AS d
  FROM pts p JOIN geoms g ON {_contains_sql('p', 'g')}
  JOIN samples s ON s.id = g.id)"""


def find_by_stats() -> str:
    return _samples_sql(P.FIND_BY_STATS) + """
SELECT qid, id, round(d, 6) AS distance_km, value FROM pairs"""


def interpolate() -> str:
    a = P.INTERPOLATE
    w = f"(1.0e0 / pow(d, {float(a['power'])}e0))"
    return _samples_sql(a) + f""",
agg AS (
  SELECT qid, sum(CASE WHEN d <> 0 THEN value * {w} END) AS zw,
         sum(CASE WHEN d <> 0 THEN {w} END) AS sw,
         avg(CASE WHEN d = 0 THEN value END) AS hit, count(*) AS n
  FROM pairs GROUP BY qid)
SELECT p.qid, p.lon, p.lat, round(coalesce(a.hit, a.zw / a.sw), 6) AS value,
       coalesce(a.n, 0) AS n_samples
FROM pts p LEFT JOIN agg a ON a.qid = p.qid"""


def interpolation_geojson() -> str:
    def feature(fid: str, lon: str, lat: str, inferred: str) -> str:
        num = lambda c: f"CAST(round({c}, 6) AS VARCHAR)"
        return (f"'{{\"type\":\"Feature\",\"properties\":{{\"id\":\"' || {fid} || '\",' || "
                f"CASE WHEN value IS NULL THEN '' ELSE '\"value\":' || {num('value')} || ',' END || "
                f"'\"inferred\":{inferred}}},\"geometry\":{{\"type\":\"Point\",\"coordinates\":[' || "
                f"{num(lon)} || ',' || {num(lat)} || ']}}}}' AS json")
    return f"""WITH est AS ({interpolate()}),
obs AS ({_samples_sql(P.INTERPOLATE)}
SELECT g.id, g.cx_c AS lon, g.cy_c AS lat, s.value FROM samples s JOIN geoms g ON g.id = s.id)
SELECT {feature('qid', 'lon', 'lat', 'true')} FROM est
UNION ALL SELECT {feature('id', 'lon', 'lat', 'false')} FROM obs"""


def _density_sql(src: str, length: int) -> str:
    return _geom_query(f"""
, pts AS ({src})
SELECT left({geohash_sql('x', 'y')}, {length}) AS cell, count(*) AS n,
       round(avg(x), 6) AS x, round(avg(y), 6) AS y
FROM pts GROUP BY 1""")


def density() -> str:
    return _density_sql(f"SELECT cx_c AS x, cy_c AS y FROM geoms",
                        P.DENSITY["length"])


def clusters() -> str:
    return _density_sql("SELECT x, y FROM nodes_raw WHERE tagged", P.CLUSTERS["length"])


def _pixel_cells_sql(zooms, size) -> str:
    values = ", ".join(f"({z})" for z in zooms)
    lat = "radians(greatest(least(cy_c, 85.05e0), -85.05e0))"
    world = "(256.0e0 * pow(2.0e0, zoom))"
    return f"""
pix AS (
  SELECT zoom, cx_c AS x, cy_c AS y, round((cx_c + 180.0e0) / 360.0e0 * {world}, 6) AS px,
         round((0.5e0 - ln(tan({lat}) + 1.0e0 / cos({lat})) / (2 * pi())) * {world}, 6) AS py
  FROM geoms, (VALUES {values}) z(zoom) WHERE cx_c IS NOT NULL),
pcell AS MATERIALIZED (
  SELECT zoom, CAST(floor(px / {float(size)}e0) AS BIGINT) AS gx, CAST(floor(py / {float(size)}e0) AS BIGINT) AS gy, count(*) AS n,
         avg(px) AS px, avg(py) AS py, avg(x) AS x, avg(y) AS y FROM pix GROUP BY 1, 2, 3)"""


def radius_clusters() -> str:
    a = P.RADIUS_CLUSTERS
    near = "b.zoom = a.zoom AND b.gx BETWEEN a.gx - 1 AND a.gx + 1 AND b.gy BETWEEN a.gy - 1 AND a.gy + 1"
    return _geom_query(f""",{_pixel_cells_sql(a['zooms'], a['radius'])},
head AS (
  SELECT a.* FROM pcell a WHERE NOT EXISTS (
    SELECT 1 FROM pcell b WHERE {near} AND (b.n > a.n OR (b.n = a.n AND (b.gx < a.gx OR (b.gx = a.gx AND b.gy < a.gy)))))),
owner AS (
  SELECT a.zoom, a.gx, a.gy, b.gx AS hx, b.gy AS hy FROM pcell a JOIN head b ON {near}
   AND pow(a.px - b.px, 2.0e0) + pow(a.py - b.py, 2.0e0) <= {float(a['radius']) ** 2}e0
  QUALIFY row_number() OVER (PARTITION BY a.zoom, a.gx, a.gy ORDER BY b.n DESC, b.gx, b.gy) = 1)
SELECT c.zoom, coalesce(o.hx, c.gx) AS gx, coalesce(o.hy, c.gy) AS gy, CAST(sum(c.n) AS BIGINT) AS n, count(*) AS n_cells,
       round(sum(c.x * c.n) / sum(c.n), 5) AS x, round(sum(c.y * c.n) / sum(c.n), 5) AS y
FROM pcell c LEFT JOIN owner o ON o.zoom = c.zoom AND o.gx = c.gx AND o.gy = c.gy GROUP BY 1, 2, 3""")


def heat_surface() -> str:
    a = P.HEAT
    reach = range(-int(a["radius"] // a["size"]), int(a["radius"] // a["size"]) + 1)
    steps = ", ".join(f"({i}, {j})" for i in reach for j in reach)
    dist = f"sqrt(CAST(i * i + j * j AS DOUBLE)) * {float(a['size'])}e0"
    return _geom_query(f""",{_pixel_cells_sql(a['zooms'], a['size'])},
kernel AS (SELECT i, j, round(1.0e0 - {dist} / {float(a['radius'])}e0, 6) AS w FROM (VALUES {steps}) s(i, j)
           WHERE {dist} < {float(a['radius'])}e0)
SELECT zoom, gx + i AS gx, gy + j AS gy, round(sum(n * w), 6) AS heat FROM pcell, kernel GROUP BY 1, 2, 3""")


# ------------------------------------------------------------ lookups SQL

def locality_geometries() -> str:
    return f"""WITH {STAT_CSV.strip()},
{GEOM.strip()}
SELECT r.id, nm.name, 'gc' AS class, round({CENTROID_X}, 6) AS cx,
       round({CENTROID_Y}, 6) AS cy, sha1(r.id) AS key
FROM names nm JOIN rels r ON r.id = 'r' || nm.id
WHERE nm.id IS NOT NULL"""


def get_filtered() -> str:
    return f"""WITH {STAT_CSV.strip()},
{GEOM.strip()}
SELECT w.id, w.cls AS class, w.wkt FROM ways w JOIN orders o ON o.o_orderkey = w.way_id
WHERE w.cls = 'ls' AND CAST(o.o_custkey AS VARCHAR) IN (SELECT id FROM names WHERE id IS NOT NULL)"""


def index_prefix_scan() -> str:
    cond = " OR ".join(f"starts_with(cell, '{p}')" for p in P.INDEX_PREFIXES)
    return _geom_query(f"SELECT cell, id FROM cell_index WHERE {cond}")


def cell_postings() -> str:
    return _geom_query("SELECT cell, id FROM cell_index")


def posting_blocks() -> str:
    return _geom_query(f"""
, placed AS (SELECT cell, id, (row_number() OVER (PARTITION BY cell ORDER BY id) - 1) // {P.POSTING_BLOCK} AS block FROM cell_index)
SELECT cell, CAST(block AS BIGINT) AS block, string_agg(id, ' ' ORDER BY id) AS ids, CAST(count(*) AS INTEGER) AS n_ids,
       min(id) AS min_id, max(id) AS max_id FROM placed GROUP BY cell, block""")


def wkt_roundtrip() -> str:
    return _geom_query("""
SELECT id, cls AS class, CAST(np AS BIGINT) AS n_points, minx, miny, maxx, maxy FROM ways
UNION ALL SELECT 'n' || id, 'p', 1, x, y, x, y FROM nodes_raw WHERE tagged
UNION ALL SELECT id, 'gc', CAST(np AS BIGINT), minx, miny, maxx, maxy FROM rels
UNION ALL SELECT id, 'pl', CAST(np AS BIGINT), minx, miny, maxx, maxy FROM polys""")


def wkt_geojson() -> str:
    """Both texts written directly from the line items."""
    def js(kind, coords):
        return f"'{{\"type\":\"{kind}\",\"coordinates\":' || {coords} || '}}'"

    def jgc(*members):
        return "'{\"type\":\"GeometryCollection\",\"geometries\":[' || " + " || ',' || ".join(members) + " || ']}'"
    jr, wr = "'[' || jp || ',' || j1 || ']'", "'(' || wp || ', ' || w1 || ')'"
    jmp, wmp = js("MultiPoint", "'[' || jp || ']'"), "'MULTIPOINT (' || wp || ')'"
    jpoly, wpoly = js("MultiPolygon", f"'[[' || {jr} || '],[' || {jr} || ',' || {jr} || ']]'"), \
        f"'MULTIPOLYGON ((' || {wr} || '), (' || {wr} || ', ' || {wr} || '))'"
    inner = jgc(js("Polygon", f"'[' || {jr} || ']'"), js("Point", "'[]'"))
    jn = jgc(js("Point", "j1"), jgc(js("LineString", "'[' || jp || ']'"), jmp, inner), jpoly)
    wn = f"""'GEOMETRYCOLLECTION (POINT (' || w1 || '), GEOMETRYCOLLECTION (LINESTRING (' || wp || '), ' || {wmp} ||
      ', GEOMETRYCOLLECTION (POLYGON (' || {wr} || '), POINT EMPTY)), ' || {wpoly} || ')'"""
    kinds = [
        ("p", js("Point", "j1"), "'POINT (' || w1 || ')'", "'p'", "1"),
        ("ls", js("LineString", "'[' || jp || ']'"), "'LINESTRING (' || wp || ')'", "'ls'", "n"),
        ("pl", js("Polygon", f"'[' || {jr} || ',' || {jr} || ']'"), f"'POLYGON (' || {wr} || ', ' || {wr} || ')'", "'pl h'", "2 * n + 2"),
        ("mp", jmp, wmp, "points", "n"),
        ("ml", js("MultiLineString", "'[[' || jp || '],[' || jp || ']]'"), "'MULTILINESTRING ((' || wp || '), (' || wp || '))'", "'ls ls'", "2 * n"),
        ("mg", jpoly, wpoly, "'pl pl h'", "3 * n + 3"),
        ("gc", jn, wn, "'p ls ' || points || ' pl pl pl h'", "1 + 2 * n + 4 * (n + 1)")]
    pick = lambda i: "CASE k % 7 " + " ".join(f"WHEN {r} THEN {x[i]}" for r, x in enumerate(kinds)) + " END"
    classes = "CASE k % 7 " + " ".join(f"WHEN {r} THEN '{x[0]}'" for r, x in enumerate(kinds)) + " END"
    srid = "k % 5 = 0"
    crs = ',"crs":{"type":"name","properties":{"name":"urn:ogc:def:crs:EPSG::4326"}}}'
    return f"""
WITH l AS (SELECT l_orderkey AS k, l_partkey % 1000 AS x, l_suppkey AS y,
                  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i FROM lineitem),
g AS (SELECT k, count(*) AS n, string_agg('[' || x || ',' || y || ']', ',' ORDER BY i) AS jp,
             string_agg(x || ' ' || y, ', ' ORDER BY i) AS wp, string_agg('p', ' ') AS points,
             arg_min('[' || x || ',' || y || ']', i) AS j1, arg_min(x || ' ' || y, i) AS w1 FROM l GROUP BY k),
t AS (SELECT k, {classes} AS class, {pick(1)} AS geojson, {pick(2)} AS wkt, {pick(3)} AS kinds, {pick(4)} AS n_points FROM g)
SELECT k, CASE WHEN k % 13 = 0 THEN NULL WHEN k % 17 = 0 THEN 'ml' ELSE class END AS class,
  CASE WHEN k % 13 = 0 THEN NULL WHEN k % 17 = 0 THEN '{{"type":"MultiLineString","coordinates":[]}}'
       WHEN {srid} THEN left(geojson, length(geojson) - 1) || '{crs}' ELSE geojson END AS geojson,
  CASE WHEN k % 13 = 0 THEN NULL WHEN k % 17 = 0 THEN 'MULTILINESTRING EMPTY'
       WHEN {srid} THEN 'SRID=4326;' || wkt ELSE wkt END AS wkt,
  CASE WHEN k % 13 = 0 THEN NULL WHEN k % 17 = 0 THEN '' ELSE kinds END AS kinds,
  CASE WHEN k % 13 = 0 THEN NULL WHEN k % 17 = 0 THEN 0 ELSE n_points END AS n_points
FROM t"""


def locality_first_match() -> str:
    a = P.FIRST_MATCH
    return f"""
WITH cand AS (
  SELECT n_name AS name, c_custkey AS osm_id,
         (c_custkey * {a['rank_mul']}) % {a['rank_mod']} AS rank
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  WHERE n_name NOT IN (SELECT n_name FROM nation WHERE n_regionkey = {a['done_region']})),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY rank, osm_id) AS k FROM cand)
SELECT name, osm_id, rank FROM ranked WHERE k = 1"""


def url_regions() -> str:
    return """
WITH urls AS (
  SELECT page_id, url FROM pages
  UNION ALL
  SELECT -n_nationkey - 1, 'https://extracts.example.org/' || lower(replace(r_name, ' ', '-')) || '/' ||
         lower(replace(n_name, ' ', '-')) || '-latest.osm.pbf'
  FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT CAST(page_id AS BIGINT) AS page_id, url, regexp_extract(url, '([^/]+)-latest', 1) AS region,
       regexp_extract(url, '.+/', 0) AS parent
FROM urls"""


def compare_with_geometry() -> str:
    a = P.MULTI_COMPARE
    return f"""WITH {STATS},
{GEOM.strip()},
cities AS (SELECT DISTINCT id, name FROM stats),
vals AS (SELECT id, count(*) AS n, sum(value) AS total FROM stats
         WHERE indicator = '{a['indicator']}' GROUP BY id)
SELECT c.id AS city_id, c.name AS city, CAST(coalesce(v.n, 0) AS INTEGER) AS n_values,
       round(coalesce(v.total, 0.0), 6) AS total, r.wkt
FROM cities c LEFT JOIN vals v ON v.id = c.id LEFT JOIN rels r ON r.id = c.id"""


def stat_json() -> str:
    """The K7 JSON lines, written out as text by hand (keys in year and
    indicator order, the same number text)."""
    a = P.STAT_JSON
    inds = ", ".join(f"('{i}')" for i in a["indicators"])
    return _stats_query(f"""
, cities AS (SELECT DISTINCT id, name FROM stats),
wanted AS (SELECT c.id, c.name, i.indicator FROM cities c, (VALUES {inds}) AS i(indicator)),
s AS (SELECT id, indicator, year, value FROM stats WHERE year BETWEEN {a['start']} AND {a['end']}),
per AS (
  SELECT w.id, w.name, w.indicator,
         '{{' || coalesce(string_agg('"' || CAST(s.year AS VARCHAR) || '":' || CAST(s.value AS VARCHAR),
                                     ',' ORDER BY s.year), '') || '}}' AS years
  FROM wanted w LEFT JOIN s ON s.id = w.id AND s.indicator = w.indicator
  GROUP BY w.id, w.name, w.indicator),
city AS (
  SELECT id, name, '{{' || string_agg('"' || indicator || '":' || years, ',' ORDER BY indicator) || '}}' AS st
  FROM per GROUP BY id, name)
SELECT '{{"' || name || '":' || st || '}}' AS json FROM city""")


def _document(entries: str, order: str, head: str, tail: str) -> str:
    """The lines of a document: head, entries with a comma before all but the first, tail."""
    return f"""
SELECT CASE WHEN row_number() OVER (ORDER BY {order}) = 1 THEN e ELSE ',' || e END AS line FROM ({entries})
UNION ALL SELECT '{head}' UNION ALL SELECT '{tail}'"""


def geojson_document() -> str:
    return _document(f"SELECT json AS e FROM ({interpolation_geojson()})", "e", '{"type":"FeatureCollection","features":[', "]}")


def stat_document() -> str:
    a = P.STAT_FROM_ALL
    head = f'{{"_1":{{"_1":"{a["indicator"]}","_2":"{a["op"]}","_3":{float(a["threshold"])},"_4":{a["year"]}}},"_2":{{'
    return _document(f"""SELECT city AS k, '"' || city || '":' || CAST(value AS VARCHAR) AS e FROM ({stat_from_all()})""",
                     "k, e", head, "}}")


def range_document() -> str:
    return _document(f"SELECT substr(json, 2, length(json) - 2) AS e FROM ({stat_json()})", "e", "{", "}")


def compare_document() -> str:
    a = P.MULTI_COMPARE
    entries = f"""WITH {STATS},
{GEOM.strip()},
vals AS (SELECT id, string_agg(CAST(value AS VARCHAR), ',' ORDER BY year, value) AS v FROM stats
         WHERE indicator = '{a['indicator']}' GROUP BY id)
SELECT '"' || c.name || '":{{"_1":[' || coalesce(v.v, '') || '],' || '"_2":"' || r.wkt || '"}}' AS e
FROM (SELECT DISTINCT id, name FROM stats) c LEFT JOIN vals v ON v.id = c.id JOIN rels r ON r.id = c.id"""
    return _document(entries, "e", "{", "}")


def all_sql() -> dict[str, str]:
    return {
        "nodes": nodes(),
        "ways": ways(),
        "relations": relations(),
        "relation_rings": relation_rings(),
        "overlapping_regions": overlapping_regions(),
        "added_region": added_region(cover_ctes, geohash_sql),
        "cell_index": cell_index(),
        "find_by_tags": find_by_tags(),
        "find_by_tags_not": find_by_tags_not(),
        "find_by_stats": find_by_stats(),
        "interpolate": interpolate(),
        "interpolation_geojson": interpolation_geojson(),
        "density": density(),
        "clusters": clusters(),
        "radius_clusters": radius_clusters(),
        "heat_surface": heat_surface(),
        "get_filtered": get_filtered(),
        "locality_geometries": locality_geometries(),
        "index_prefix_scan": index_prefix_scan(),
        "cell_postings": cell_postings(),
        "posting_blocks": posting_blocks(),
        "wkt_roundtrip": wkt_roundtrip(),
        "wkt_geojson": wkt_geojson(),
        "locality_first_match": locality_first_match(),
        "url_regions": url_regions(),
        "stat_json": stat_json(),
        "geojson_document": geojson_document(),
        "stat_document": stat_document(),
        "range_document": range_document(),
        "compare_document": compare_document(),
        "stat_series": stat_series(),
        "stats_upsert": stats_upsert(),
        "stat_maps": stat_maps(),
        "stat_from_all": stat_from_all(),
        "stat_from_all_equal": stat_from_all_equal(),
        "stat_from_all_first_year": stat_from_all_first_year(),
        "multi_compare_stat": multi_compare_stat(),
        "compare_with_geometry": compare_with_geometry(),
        "stat_in_range": stat_in_range(),
        "stats_in_range": stats_in_range(),
    }
