"""DuckDB SQL for the street blocks (orbis.sources.fixtures): raw nodes, ways and relations, and the polygon
faces between the streets by walking half-edges in recursive queries."""

from __future__ import annotations

from orbis.sources import fixtures as FX


def _pick(values, at: str) -> str:
    return "CASE " + at + " " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


_MID = FX.BLOCK_STEP + FX.BLOCK_STEP // 2
_KINDS = ", ".join(f"'{k}'" for k in FX.SEGMENT_TO_RELATION_TYPE)

def blocks(shift: str = "0") -> str:
    """CTEs of the blocks and their polygons (``block_polys``); ``shift``: units that an owner lies further east."""
    return f"""
blk AS (SELECT c_custkey AS c, c_name AS name FROM customer WHERE c_mktsegment NOT IN ({_KINDS})),
bn AS MATERIALIZED (
  SELECT c, k, name,
    CAST({int(FX.LON0) * FX.BLOCK_UNIT} + c * {FX.POINT_LON_MUL} % {FX.LON_SPAN // 1000 * FX.BLOCK_UNIT} +
      CASE WHEN k < 25 THEN k % 5 * {FX.BLOCK_STEP} ELSE {_MID} + {_pick([g[0] for g in FX.GARDEN], 'k - 25')} END
      + {shift} AS DOUBLE) / {float(FX.BLOCK_UNIT)}e0 AS x,
    CAST({int(FX.LAT0) * FX.BLOCK_UNIT} + c * {FX.POINT_LAT_MUL} % {FX.LAT_SPAN // 1000 * FX.BLOCK_UNIT} +
      CASE WHEN k < 25 THEN k // 5 * {FX.BLOCK_STEP} ELSE {_MID} + {_pick([g[1] for g in FX.GARDEN], 'k - 25')} END
      AS DOUBLE) / {float(FX.BLOCK_UNIT)}e0 AS y
  FROM blk, range(29) r(k) WHERE k < 25 OR c % 3 = 0),
be AS MATERIALIZED (
  SELECT DISTINCT c, CAST(l_partkey % {FX.BLOCK_STREETS} AS INTEGER) AS e
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN blk ON o_custkey = c),
ends AS (
  SELECT c, e, CASE WHEN e < 20 THEN e // 4 * 5 + e % 4 WHEN e < 40 THEN e - 20
                    ELSE {_pick([a for a, _ in FX.DIAGONALS], 'e - 40')} END AS a,
         CASE WHEN e < 20 THEN e // 4 * 5 + e % 4 + 1 WHEN e < 40 THEN e - 15
              ELSE {_pick([b for _, b in FX.DIAGONALS], 'e - 40')} END AS b FROM be),
halves AS MATERIALIZED (
  SELECT h.*, p.x, p.y, q.x AS nx, q.y AS ny,
         CASE WHEN atan2(q.y - p.y, q.x - p.x) < 0 THEN atan2(q.y - p.y, q.x - p.x) + 2 * pi()
              ELSE atan2(q.y - p.y, q.x - p.x) END AS ang
  FROM (SELECT c, 2 * e AS h, a AS u, b AS v FROM ends UNION ALL SELECT c, 2 * e + 1, b, a FROM ends) h
  JOIN bn p ON p.c = h.c AND p.k = h.u JOIN bn q ON q.c = h.c AND q.k = h.v),
-- the half after another one: clockwise next to its twin
after1 AS MATERIALIZED (
  SELECT c, CASE WHEN h % 2 = 0 THEN h + 1 ELSE h - 1 END AS h,
         coalesce(lag(h) OVER w, last_value(h) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS nxt
  FROM halves WINDOW w AS (PARTITION BY c, u ORDER BY ang)),
walk1 AS (
  SELECT c, h AS start, h FROM after1
  UNION SELECT w.c, w.start, a.nxt FROM walk1 w JOIN after1 a ON a.c = w.c AND a.h = w.h),
face1 AS MATERIALIZED (SELECT c, start AS h, min(h) AS f FROM walk1 GROUP BY c, start),
live AS MATERIALIZED (
  SELECT s.* FROM halves s JOIN face1 f ON f.c = s.c AND f.h = s.h
  JOIN face1 g ON g.c = s.c AND g.h = CASE WHEN s.h % 2 = 0 THEN s.h + 1 ELSE s.h - 1 END WHERE f.f <> g.f),
after2 AS MATERIALIZED (
  SELECT c, CASE WHEN h % 2 = 0 THEN h + 1 ELSE h - 1 END AS h,
         coalesce(lag(h) OVER w, last_value(h) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS nxt
  FROM live WINDOW w AS (PARTITION BY c, u ORDER BY ang)),
walk2 AS (
  SELECT c, h AS start, h FROM after2
  UNION SELECT w.c, w.start, a.nxt FROM walk2 w JOIN after2 a ON a.c = w.c AND a.h = w.h),
face2 AS MATERIALIZED (SELECT c, start AS h, min(h) AS f FROM walk2 GROUP BY c, start),
-- rings that touch no node twice: within a face, the half counter-clockwise next to the twin
after3 AS MATERIALIZED (
  SELECT i.c, i.h, coalesce(min_by(o.h, o.ang) FILTER (WHERE o.ang > t.ang), min_by(o.h, o.ang)) AS nxt
  FROM live i JOIN face2 f ON f.c = i.c AND f.h = i.h
  JOIN live t ON t.c = i.c AND t.h = CASE WHEN i.h % 2 = 0 THEN i.h + 1 ELSE i.h - 1 END
  JOIN live o ON o.c = i.c AND o.u = i.v JOIN face2 g ON g.c = o.c AND g.h = o.h AND g.f = f.f
  GROUP BY i.c, i.h),
walk3 AS (
  SELECT c, h AS start, h, 0 AS n FROM after3
  UNION ALL SELECT w.c, w.start, a.nxt, n + 1 FROM walk3 w JOIN after3 a ON a.c = w.c AND a.h = w.h
  WHERE a.nxt <> w.start),
ring3 AS MATERIALIZED (
  SELECT w.c, w.start AS ring, w.n, s.x, s.y, s.nx, s.ny FROM walk3 w JOIN live s ON s.c = w.c AND s.h = w.h
  WHERE w.start = (SELECT min(m.h) FROM walk3 m WHERE m.c = w.c AND m.start = w.start)),
turn AS (
  SELECT c, ring, count(*) AS len, sum((x - x0) * (ny - y0) - (nx - x0) * (y - y0)) AS turn, arg_min(n, (x, y)) AS n0
  FROM (SELECT *, first_value(x) OVER (PARTITION BY c, ring ORDER BY n) AS x0,
               first_value(y) OVER (PARTITION BY c, ring ORDER BY n) AS y0 FROM ring3) GROUP BY c, ring),
placed AS (
  SELECT r.c, r.ring, t.turn, r.x, r.y,
         CASE WHEN t.turn > 0 THEN (r.n - t.n0 + t.len) % t.len ELSE (t.n0 - r.n + t.len) % t.len END AS pos
  FROM ring3 r JOIN turn t ON t.c = r.c AND t.ring = r.ring),
rings AS MATERIALIZED (
  SELECT c, ring, turn, list([x, y] ORDER BY pos) AS pts FROM placed GROUP BY c, ring, turn
  UNION ALL
  SELECT c, 1000 + s, s * {2 * 2 * 2 * 2} / {float(FX.BLOCK_UNIT ** 2)}e0, list([x, y] ORDER BY k)
  FROM bn, (VALUES (1), (-1)) v(s) WHERE k >= 25 GROUP BY c, s),
shells AS (
  SELECT c, ring, turn, pts FROM rings WHERE turn > 0
  QUALIFY row_number() OVER (PARTITION BY c ORDER BY turn DESC, pts) = 1),
edges AS (
  SELECT c, ring, turn, i, pts[i][1] AS x, pts[i][2] AS y, pts[i % len(pts) + 1][1] AS nx, pts[i % len(pts) + 1][2] AS ny
  FROM (SELECT *, unnest(range(1, len(pts) + 1)) AS i FROM rings)),
pairs AS MATERIALIZED (
  SELECT i.c, i.ring AS inner_ring, o.ring AS outer_ring, o.turn, o.pts FROM rings i JOIN rings o
  ON o.c = i.c AND i.turn < 0 AND o.turn > 0 AND o.turn > -i.turn),
free AS (
  SELECT p.c, p.inner_ring, p.outer_ring, arg_min([v.x, v.y], v.i) AS at FROM pairs p
  JOIN edges v ON v.c = p.c AND v.ring = p.inner_ring
  WHERE NOT EXISTS (SELECT 1 FROM edges s WHERE s.c = p.c AND s.ring = p.outer_ring
    AND (s.nx - s.x) * (v.y - s.y) - (s.ny - s.y) * (v.x - s.x) = 0
    AND v.x BETWEEN least(s.x, s.nx) AND greatest(s.x, s.nx) AND v.y BETWEEN least(s.y, s.ny) AND greatest(s.y, s.ny))
  GROUP BY p.c, p.inner_ring, p.outer_ring),
probe AS (
  SELECT p.*, coalesce(f.at, [(m.x + m.nx) / 2, (m.y + m.ny) / 2]) AS at FROM pairs p
  JOIN edges m ON m.c = p.c AND m.ring = p.inner_ring AND m.i = 1
  LEFT JOIN free f ON f.c = p.c AND f.inner_ring = p.inner_ring AND f.outer_ring = p.outer_ring),
inside AS (
  SELECT p.c, p.inner_ring, p.outer_ring, p.turn, p.pts FROM probe p JOIN edges s ON s.c = p.c AND s.ring = p.outer_ring
  WHERE (s.y > p.at[2]) <> (s.ny > p.at[2]) AND p.at[1] < s.x + (p.at[2] - s.y) * (s.nx - s.x) / (s.ny - s.y)
  GROUP BY p.c, p.inner_ring, p.outer_ring, p.turn, p.pts HAVING count(*) % 2 = 1),
around AS (
  SELECT c, inner_ring, outer_ring FROM inside
  QUALIFY row_number() OVER (PARTITION BY c, inner_ring ORDER BY turn, pts) = 1),
bring AS (
  SELECT c, ring, 1 AS sign, pts FROM shells
  UNION ALL
  SELECT s.c, a.inner_ring, -1, r.pts FROM shells s JOIN around a ON a.c = s.c AND a.outer_ring = s.ring
  JOIN rings r ON r.c = a.c AND r.ring = a.inner_ring),
bseg AS (
  SELECT b.c, b.ring, b.sign, b.pts, p[1] AS x, p[2] AS y, b.pts[i % len(b.pts) + 1] AS q, b.pts[1] AS o
  FROM (SELECT *, unnest(range(1, len(pts) + 1)) AS i, unnest(pts) AS p FROM bring) b),
bsum AS (
  SELECT c, ring, sign, pts, sum((x - o[1]) * (q[2] - o[2]) - (q[1] - o[1]) * (y - o[2])) AS a,
    sum(((x - o[1]) * (q[2] - o[2]) - (q[1] - o[1]) * (y - o[2])) * (o[1] + x + q[1])) AS cx,
    sum(((x - o[1]) * (q[2] - o[2]) - (q[1] - o[1]) * (y - o[2])) * (o[2] + y + q[2])) AS cy,
    min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy,
    '(' || array_to_string(list_transform(pts || [pts[1]], lambda z:
      regexp_replace(CAST(z[1] AS VARCHAR), '\\.0$', '') || ' ' || regexp_replace(CAST(z[2] AS VARCHAR), '\\.0$', '')),
      ', ') || ')' AS txt
  FROM bseg GROUP BY c, ring, sign, pts),
block_polys AS MATERIALIZED (
  SELECT b.c, 'r' || ({FX.BLOCK_BASE} + b.c) AS id, CASE WHEN b.c % 2 = 0 THEN 'boundary' ELSE 'multipolygon' END AS rel_type,
    count(*) AS n_rings, 'POLYGON (' || string_agg(txt, ', ' ORDER BY sign DESC, pts) || ')' AS wkt,
    sum(sign * sign(a) * cx) / 3.0e0 / sum(sign * abs(a)) AS cx, sum(sign * sign(a) * cy) / 3.0e0 / sum(sign * abs(a)) AS cy,
    min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy
  FROM bsum b WHERE b.c IN (SELECT c FROM be) OR b.c % 3 = 0 GROUP BY b.c)"""


def overlapping_regions() -> str:
    """Owners of remainder 0 as the first extract has them, all others as the second has them."""
    later = "(c % 3 <> 0)"
    mark = f"CASE WHEN {later} THEN '{FX.BLOCK_MARK}' ELSE '' END"
    num = lambda v: f"regexp_replace(CAST({v} AS VARCHAR), '\\.0$', '')"
    xy = lambda p: f"{num(p + '.x')} || ' ' || {num(p + '.y')}"
    return f"""WITH RECURSIVE {blocks(f"CASE WHEN {later} THEN 1 ELSE 0 END").strip()},
garden AS (
  SELECT c, string_agg({xy('bn')}, ', ' ORDER BY k) || ', ' || arg_min({xy('bn')}, k) AS txt FROM bn WHERE k >= 25 GROUP BY c)
SELECT 'n' || ({FX.BLOCK_BASE} + c * 32) AS id, 'n' AS kind, 'p' AS class, 'POINT (' || {xy('bn')} || ')' AS wkt,
       name || {mark} AS tag, 1 AS n_rows FROM bn WHERE k = 0
UNION ALL
SELECT 'w' || ({FX.BLOCK_BASE} + s.c * 64 + e), 'w', 'ls',
       'LINESTRING (' || CASE WHEN e % 2 = 0 THEN {xy('p')} || ', ' || {xy('q')} ELSE {xy('q')} || ', ' || {xy('p')} END || ')',
       'street' || CASE WHEN s.c % 3 <> 0 THEN '{FX.BLOCK_MARK}' ELSE '' END, 1
FROM ends s JOIN bn p ON p.c = s.c AND p.k = s.a JOIN bn q ON q.c = s.c AND q.k = s.b
UNION ALL
SELECT 'w' || ({FX.BLOCK_BASE} + c * 64 + {FX.BLOCK_STREETS}), 'w', 'pl', 'POLYGON ((' || txt || '))', 'garden' || {mark}, 1 FROM garden
UNION ALL
SELECT id, 'r', 'pl', wkt, name || CASE WHEN p.c % 3 <> 0 THEN '{FX.BLOCK_MARK}' ELSE '' END, 1
FROM block_polys p JOIN blk ON blk.c = p.c"""


def added_region(cover_ctes, geohash_sql) -> str:
    """The covers of all geometries of both extracts, from their boxes."""
    return f"""WITH RECURSIVE {blocks("CASE WHEN c % 3 <> 0 THEN 1 ELSE 0 END").strip()},
box AS (
  SELECT 'w' || ({FX.BLOCK_BASE} + s.c * 64 + e) AS gid, least(p.x, q.x) AS minx, least(p.y, q.y) AS miny,
         greatest(p.x, q.x) AS maxx, greatest(p.y, q.y) AS maxy
  FROM ends s JOIN bn p ON p.c = s.c AND p.k = s.a JOIN bn q ON q.c = s.c AND q.k = s.b
  UNION ALL
  SELECT 'w' || ({FX.BLOCK_BASE} + c * 64 + {FX.BLOCK_STREETS}), min(x), min(y), max(x), max(y) FROM bn WHERE k >= 25 GROUP BY c
  UNION ALL SELECT id, minx, miny, maxx, maxy FROM block_polys),
{cover_ctes('cov', 'box').strip()},
flat AS (
  SELECT cell, gid AS id, maxx FROM cov_cells JOIN box USING (gid)
  UNION ALL SELECT {geohash_sql('x', 'y')}, 'n' || ({FX.BLOCK_BASE} + c * 32), x FROM bn WHERE k = 0)
SELECT cell, count(*) AS n_ids, min(id) AS min_id, max(id) AS max_id, round(sum(maxx), 6) AS east FROM flat GROUP BY cell"""
