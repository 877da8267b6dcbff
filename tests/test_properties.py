"""Property tests: cells against an independent geohash,
covers against their geometries."""

from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orbis.functions import geohash as GH
from orbis.plans.catalog import Inputs

from conftest import SF_SMALL

ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def bisect_geohash(lat: float, lon: float, length: int = 12) -> str:
    """Textbook geohash by interval halving (longitude first)."""
    lat_lo, lat_hi, lon_lo, lon_hi = -90.0, 90.0, -180.0, 180.0
    bits, out, even = [], [], True
    while len(out) < length:
        if even:
            mid = (lon_lo + lon_hi) / 2
            bit = lon >= mid
            lon_lo, lon_hi = (mid, lon_hi) if bit else (lon_lo, mid)
        else:
            mid = (lat_lo + lat_hi) / 2
            bit = lat >= mid
            lat_lo, lat_hi = (mid, lat_hi) if bit else (lat_lo, mid)
        bits.append(int(bit))
        even = not even
        if len(bits) == 5:
            out.append(ALPHABET[int("".join(map(str, bits)), 2)])
            bits = []
    return "".join(out)


@settings(max_examples=5, deadline=None, phases=[Phase.explicit, Phase.generate])
@given(st.lists(st.tuples(st.floats(-179.999, 179.999), st.floats(-89.999, 89.999)),
                min_size=50, max_size=50))
def test_geohash_matches_bisection(spark, pts):
    df = spark.createDataFrame(pts, "lon double, lat double")
    got = [r.g for r in df.select(GH.geohash("lon", "lat").alias("g")).collect()]
    assert got == [bisect_geohash(lat, lon) for lon, lat in pts]


def test_every_geometry_is_under_its_cover(spark):
    g = Inputs(spark, SF_SMALL).geometries()
    corners = g.select("id", GH.geohash("envelope.minx", "envelope.miny").alias("lo"),
                       GH.geohash("envelope.maxx", "envelope.maxy").alias("hi"))
    cells = GH.explode_grid(g.select("id", "cover"), "cover").select("id", "cell")
    hits = cells.join(corners, "id").groupBy("id").agg(
        F.max(F.col("lo").startswith(F.col("cell")).cast("int")).alias("lo_ok"),
        F.max(F.col("hi").startswith(F.col("cell")).cast("int")).alias("hi_ok"),
        F.min(F.length("cell")).alias("shortest"))
    assert hits.count() == g.count()
    assert hits.where("lo_ok = 0 or hi_ok = 0 or shortest < 3").count() == 0
