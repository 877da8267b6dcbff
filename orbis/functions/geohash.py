"""Geohash cells as column expressions.

A position is scaled to two 30-bit integers (longitude and latitude), the
bits are interleaved (longitude first) into a 60-bit Morton code, and the
code is printed five bits per character in the geohash alphabet.  A cell of length L is the top 5L bits: the
longitude keeps ceil(5L/2) bits and the latitude floor(5L/2).  Covers of a
box use the very same integers, so a point's cell and a box's cover always
agree at cell edges.

The cover of a box follows the rule "raise the cell budget from one until
every cell has at least three characters": with n(L) the number of
length-L cells the box touches (never falling as L grows), the cover length
is the longest L <= 12 with n(L) <= n(3).  It is computed in closed form,
one candidate length per expression -- no loop, no driver work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbis.functions.common import col_of, let, memo_expr

# The geohash alphabet, the longest cell and the shortest
# cell an index keeps.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
MAX_CELL_LENGTH = 12
MIN_CELL_LENGTH = 3

BITS = 30
SCALE = float(1 << BITS)
TOP = (1 << BITS) - 1


def lon_bits(cell_length: int) -> int:
    return (5 * cell_length + 1) // 2


def lat_bits(cell_length: int) -> int:
    return (5 * cell_length) // 2


def _clamp(v: Column) -> Column:
    return F.greatest(F.least(v, F.lit(TOP).cast("long")), F.lit(0).cast("long"))


def _scaled(v, lo: float, span: float) -> Column:
    """Number of grid boundaries lo + i*span/2^30 at or below ``v`` -- what
    halving the interval 30 times decides.  The scaled floor can be one off
    next to a boundary (``v + lo`` rounds), so it is corrected against the
    boundary itself, which is an exact double (a multiple of span/2^30)."""
    v = col_of(v)
    step = span / SCALE
    i0 = _clamp(F.floor((v - F.lit(lo)) / F.lit(span) * F.lit(SCALE)))
    b0 = F.lit(lo) + i0 * F.lit(step)
    return _clamp(F.when(v < b0, i0 - 1).when(v >= b0 + F.lit(step), i0 + 1).otherwise(i0))


def lon_int(lon) -> Column:
    """Longitude → 30-bit integer, clamped to the valid range (lon 180 is the
    last cell)."""
    return _scaled(lon, -180.0, 360.0)


def lat_int(lat) -> Column:
    return _scaled(lat, -90.0, 180.0)


def _spread(v: Column) -> Column:
    """Move bit i of a 30-bit value to bit 2i (Morton spreading)."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF),
                        (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333),
                        (1, 0x5555555555555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
    return v


def morton(lon_i, lat_i) -> Column:
    """60-bit interleaved code of two 30-bit integers (longitude bits first)."""
    return F.shiftleft(_spread(col_of(lon_i).cast("long")), 1).bitwiseOR(
        _spread(col_of(lat_i).cast("long")))


def cell_text(z, length: Column | None = None) -> Column:
    """Cell text of an interleaved code ``z``: one alphabet lookup per 5
    bits.  With ``length`` (a column) only that many characters are made --
    ``concat_ws`` skips the nulls past it.  ``z`` should be a column or a
    bound variable: it is read once per character."""
    z = col_of(z)
    chars = []
    for k in range(MAX_CELL_LENGTH):
        idx = F.shiftright(z, 5 * (MAX_CELL_LENGTH - 1 - k)).bitwiseAND(F.lit(31)) + 1
        ch = F.substring(F.lit(GEOHASH_ALPHABET), idx.cast("int"), F.lit(1))
        chars.append(ch if length is None else F.when(F.lit(k) < length, ch))
    return F.concat_ws("", *chars)


def geohash_from_ints(lon_i, lat_i, length: Column | None = None) -> Column:
    """Cell text of two 30-bit integers (the code is bound once with ``let``)."""
    return let(morton(lon_i, lat_i), lambda z: cell_text(z, length))


def geohash(lon, lat, length: int | Column = MAX_CELL_LENGTH) -> Column:
    """cell of a point; 12 characters unless ``length`` says otherwise."""
    if isinstance(length, int) and length == MAX_CELL_LENGTH:
        return geohash_from_ints(lon_int(lon), lat_int(lat))
    return geohash_from_ints(lon_int(lon), lat_int(lat),
                             length if isinstance(length, Column) else F.lit(length))


def with_geohash(df: DataFrame, lon, lat, out: str = "cell",
                 length: int = MAX_CELL_LENGTH) -> DataFrame:
    """F1 for a DataFrame: the interleaved code is a staged column and the
    text is read from it, so the whole computation stays in codegen (the
    ``geohash`` expression form binds the code with ``let`` instead)."""
    z = f"__{out}_z"
    df = df.withColumn(z, morton(lon_int(lon), lat_int(lat)))
    ln = None if length == MAX_CELL_LENGTH else F.lit(length)
    return df.withColumn(out, cell_text(z, ln)).drop(z)


def _grid(lo_i: Column, hi_i: Column, bits: int) -> tuple[Column, Column]:
    s = BITS - bits
    return F.shiftright(lo_i, s), F.shiftright(hi_i, s)


def box_ints(env) -> Column:
    """Box → its corner integers ``struct<x0,x1,y0,y1>`` (stage 1 of a cover)."""
    e = col_of(env)
    return F.struct(lon_int(e["minx"]).alias("x0"), lon_int(e["maxx"]).alias("x1"),
                    lat_int(e["miny"]).alias("y0"), lat_int(e["maxy"]).alias("y1"))


def cover_length_of(ints) -> Column:
    """Cover length L* from the corner integers (stage 2)."""
    b = col_of(ints)

    def n(L: int) -> Column:
        c0, c1 = _grid(b["x0"], b["x1"], lon_bits(L))
        r0, r1 = _grid(b["y0"], b["y1"], lat_bits(L))
        return (c1 - c0 + 1) * (r1 - r0 + 1)

    # cells of a length lie in those of a shorter one, so n(L) never falls: the first length
    # with more cells ends the search (a large box is settled by one comparison)
    n3 = n(MIN_CELL_LENGTH)
    out = F.when(n3.isNull(), F.lit(MIN_CELL_LENGTH))
    for L in range(MIN_CELL_LENGTH + 1, MAX_CELL_LENGTH + 1):
        out = out.when(n(L) > n3, F.lit(L - 1))
    return out.otherwise(F.lit(MAX_CELL_LENGTH))


def cover_grid(ints, L) -> Column:
    """Cell-grid ranges at length L: ``struct<L,c0,c1,r0,r1,fx,fy>``; fx, fy
    turn a column/row number back into corner integers (stage 3)."""
    b, L = col_of(ints), col_of(L)

    def at_length(f):
        out = None
        for k in range(MIN_CELL_LENGTH, MAX_CELL_LENGTH + 1):
            v = f(k)
            out = F.when(L == k, v) if out is None else out.when(L == k, v)
        return out

    return F.struct(
        L.alias("L"),
        at_length(lambda k: F.shiftright(b["x0"], BITS - lon_bits(k))).alias("c0"),
        at_length(lambda k: F.shiftright(b["x1"], BITS - lon_bits(k))).alias("c1"),
        at_length(lambda k: F.shiftright(b["y0"], BITS - lat_bits(k))).alias("r0"),
        at_length(lambda k: F.shiftright(b["y1"], BITS - lat_bits(k))).alias("r1"),
        at_length(lambda k: F.lit(1 << (BITS - lon_bits(k))).cast("long")).alias("fx"),
        at_length(lambda k: F.lit(1 << (BITS - lat_bits(k))).cast("long")).alias("fy"))


def cover_cells(grid, L) -> Column:
    """All cells of the grid ranges, each cut to length L (stage 4)."""
    g, L = col_of(grid), col_of(L)
    return F.flatten(F.transform(
        F.sequence(g["c0"], g["c1"]),
        lambda c: F.transform(
            F.sequence(g["r0"], g["r1"]),
            lambda r: geohash_from_ints(c * g["fx"], r * g["fy"], L))))


@memo_expr
def cover_grid_of(env) -> Column:
    """F9 as a grid: ``struct<L, c0, c1, r0, r1, fx, fy>`` -- the cover length
    L* (the longest L <= 12 with n(L) <= n(3)), the column and row ranges of
    the length-L cells the box touches, and the factors that turn a column
    or row number back into corner integers.  Arithmetic only; null box →
    null grid (Q9).  Each stage is bound once with ``let``."""
    e = col_of(env)
    grid = let(box_ints(e), lambda b: let(
        F.struct(b.alias("b"), cover_length_of(b).alias("L")),
        lambda s: cover_grid(s["b"], s["L"])))
    return F.when(e.isNotNull(), grid)


def with_cover_grid(df: DataFrame, env: str, out: str = "cover") -> DataFrame:
    """``cover_grid_of`` for a DataFrame: corner integers and length are staged columns, so the
    whole computation stays in codegen (the expression form binds them with ``let``)."""
    e, ints = F.col(env), {c: f"__{out}_{c}" for c in ("x0", "x1", "y0", "y1")}
    df = df.withColumns({ints["x0"]: lon_int(e["minx"]), ints["x1"]: lon_int(e["maxx"]),
                         ints["y0"]: lat_int(e["miny"]), ints["y1"]: lat_int(e["maxy"])})
    b, L = {c: F.col(name) for c, name in ints.items()}, f"__{out}_L"
    df = df.withColumn(L, cover_length_of(b))
    return df.withColumn(out, F.when(e.isNotNull(), cover_grid(b, L))).drop(L, *ints.values())


@memo_expr
def grid_size(grid) -> Column:
    """Number of cells of a cover grid, without making them."""
    g = col_of(grid)
    return (g["c1"] - g["c0"] + 1) * (g["r1"] - g["r0"] + 1)


@memo_expr
def grid_cells(grid) -> Column:
    """The cells of a cover grid as an array (higher-order functions)."""
    g = col_of(grid)
    return F.when(g.isNotNull(), cover_cells(g, g["L"]))


def explode_grid(df: DataFrame, grid: str, out: str = "cell") -> DataFrame:
    """One row per cell of the cover grid column ``grid``.  The column and
    row numbers come from two ``explode(sequence(..))`` generators and the
    cell text is computed in the projection above them, so the per-cell work
    runs in whole-stage codegen rather than in an interpreted lambda."""
    c, r, z = f"__{out}_c", f"__{out}_r", f"__{out}_z"
    g = F.col(grid)
    df = df.where(g.isNotNull()) \
        .withColumn(c, F.explode(F.sequence(g["c0"], g["c1"]))) \
        .withColumn(r, F.explode(F.sequence(g["r0"], g["r1"])))
    # the code is its own column, read by each character (codegen keeps it
    # computed once); measured 2x faster than printing it with conv()
    df = df.withColumn(z, morton(F.col(c) * g["fx"], F.col(r) * g["fy"]))
    return df.withColumn(out, cell_text(z, g["L"])).drop(c, r, z)


def cover_blocks(df: DataFrame, grid: str, side: int, out: str) -> DataFrame:
    """The cover grid column ``grid`` cut along squares of ``side`` 3-character cells: one row for each
    square that it touches, numbered in ``out``.  The cells of the pieces are the cells of the grid,
    each once."""
    g, c, r = F.col(grid), f"__{out}_c", f"__{out}_r"
    wide, high = side << (BITS - lon_bits(MIN_CELL_LENGTH)), side << (BITS - lat_bits(MIN_CELL_LENGTH))

    def square(n: Column, f: Column, size: int) -> Column:
        return F.floor(n * f / F.lit(size))
    df = df.where(g.isNotNull()) \
        .withColumn(c, F.explode(F.sequence(square(g["c0"], g["fx"], wide), square(g["c1"], g["fx"], wide)))) \
        .withColumn(r, F.explode(F.sequence(square(g["r0"], g["fy"], high), square(g["r1"], g["fy"], high))))
    # cells of 3 characters or more lie in one square, whose side is a multiple of theirs
    part = F.struct(
        g["L"].alias("L"),
        F.greatest(g["c0"], (F.col(c) * wide / g["fx"]).cast("long")).alias("c0"),
        F.least(g["c1"], ((F.col(c) + 1) * wide / g["fx"]).cast("long") - 1).alias("c1"),
        F.greatest(g["r0"], (F.col(r) * high / g["fy"]).cast("long")).alias("r0"),
        F.least(g["r1"], ((F.col(r) + 1) * high / g["fy"]).cast("long") - 1).alias("r1"),
        g["fx"].alias("fx"), g["fy"].alias("fy"))
    across = (1 << BITS) // wide
    return df.withColumn(grid, part).withColumn(out, F.col(r) * across + F.col(c)).drop(c, r)


def with_anchor_cell(df: DataFrame, grid: str, out: str = "cell") -> DataFrame:
    """The first cell of the cover grid column ``grid`` (that of the box's smallest corner).

    Where a box lies in another one, *each* of its cells is under a cell of the outer box's cover, so
    a search for contained geometries finds them by this one cell."""
    g, z = F.col(grid), f"__{out}_z"
    df = df.where(g.isNotNull()).withColumn(z, morton(g["c0"] * g["fx"], g["r0"] * g["fy"]))
    return df.withColumn(out, cell_text(z, g["L"])).drop(z)


@memo_expr
def cover(env) -> Column:
    """the cells covering box column ``env`` as an array, all of length L*."""
    return let(cover_grid_of(env), grid_cells)
