"""Statistic queries on the reference's sample outputs and
the Q-rules that concern them."""

import pytest

from orbis.operators import statistics as ST

POP = "Population on the 1st of January, total"


@pytest.fixture(scope="module")
def stats(spark):
    rows = []
    # comparison sample: population > 700 in 2010 (thousand-comma text)
    pop2010 = {"Sevilla": "704,198", "Köln": "998,105", "Leeds": "745,7", "Torino": "877,359",
               "Cardiff": "341,1", "Lund": ":"}
    for city, v in pop2010.items():
        rows.append(("2010", city, POP, v))
    # one stat in a range: Cardiff 2013-2018
    for y, v in zip(range(2013, 2019), ["350,1", "353", "355,727", "359,314", "361,962", "363,502"]):
        rows.append((str(y), "Cardiff", POP, v))
    rows.append(("2019", "Cardiff", POP, "365,0"))
    # several stats: Venezia
    for y, a, b in [(2013, "129,014", "22,344"), (2014, "129,324", "22,191"),
                    (2015, "128,86", "22,278"), (2016, "128,194", "22,654")]:
        rows.append((str(y), "Venezia", "private households", a))
        rows.append((str(y), "Venezia", "all companies", b))
    csv = spark.createDataFrame(rows, "TIME string, CITIES string, INDIC_UR string, Value string")
    names = spark.createDataFrame(
        [("1", "Sevilla"), ("2", "Köln"), ("3", "Leeds"), ("4", "Torino"), ("5", "Cardiff"),
         ("6", "Lund"), ("7", "Venezia"), ("8", "Maribor"), ("9", "Torino"), (None, "Nowhere")],
        "id string, name string")
    return ST.build_stats(csv, names).cache()


def test_stat_from_all_sample(stats):
    got = {r.city: r.value for r in ST.stat_from_all(stats, POP, ">", 700.0, 2010).collect()}
    # two ids share the name Torino: both pass, kept apart (Q17)
    assert sorted(got) == ["Köln", "Leeds", "Sevilla", "Torino"]
    assert got["Sevilla"] == pytest.approx(704.198)
    assert len(ST.stat_from_all(stats, POP, ">", 700.0, 2010).collect()) == 5


def test_missing_mark_is_zero_q24(stats):
    r = stats.where("name = 'Lund' and year = 2010").first()
    assert r.value == 0.0 and r.value_raw == ":"


def test_unknown_operator_q16(stats):
    with pytest.raises(ValueError):
        ST.stat_from_all(stats, POP, ">=", 1.0, 2010)


def test_first_year_q15(stats):
    got = {r.city: (r.year, r.value) for r in ST.stat_from_all(stats, POP, ">", 0.0, 0).collect()}
    assert got["Cardiff"] == (2010, pytest.approx(341.1))


def test_stat_in_range_cardiff(stats):
    got = {r.year: r.value for r in ST.stat_in_range(stats, POP, 2013, 2018, ids=["r5"]).collect()}
    assert got == pytest.approx({2013: 350.1, 2014: 353.0, 2015: 355.727, 2016: 359.314,
                                 2017: 361.962, 2018: 363.502})


def test_stats_in_range_venezia(stats):
    out = ST.stats_in_range(stats, ["private households", "all companies", "nothing"],
                            2013, 2016, ids=["r7"]).collect()
    ph = {r.year: r.value for r in out if r.indicator == "private households"}
    assert ph == pytest.approx({2013: 129.014, 2014: 129.324, 2015: 128.86, 2016: 128.194})
    empty = [r for r in out if r.indicator == "nothing"]
    assert len(empty) == 1 and empty[0].year is None     # A9: empty map kept


def test_range_map_shape(stats):
    r = ST.range_map(stats, ["all companies"], 2013, 2016, ids=["r7"]).first()
    assert r.stats["all companies"][2016] == pytest.approx(22.654)


def test_multi_compare_ordered_and_empty(stats):
    got = {r.city_id: r["values"] for r in ST.multi_compare_stat(stats, POP).collect()}
    assert got["r5"][:2] == pytest.approx([341.1, 350.1])     # year order
    assert got["r8"] == []                                     # Maribor: no data
    assert "rNone" not in got                                  # P10


def test_stat_maps(stats):
    r = ST.stat_maps(stats).where("id = 'r7'").first()
    assert r.stats["all companies"][2013] == pytest.approx(22.344)


def test_multi_compare_with_geometry(spark, stats):
    geoms = spark.createDataFrame([("r5", "POINT (1 2)")], "id string, wkt string")
    got = {r.city_id: r.wkt for r in ST.multi_compare_stat(stats, POP, geometries=geoms).collect()}
    assert got["r5"] == "POINT (1 2)" and got["r8"] is None


def test_get_stat_f18(stats):
    from orbis.functions.parse import get_stat
    m = ST.stat_maps(stats).where("id = 'r7'")
    r = m.select(get_stat("stats", "all companies").alias("a"),
                 get_stat("stats", "missing").alias("b")).first()
    assert r.a[2013] == pytest.approx(22.344) and len(r.b) == 0
