"""Parameters of the registered queries (shared by the Spark plans and the
SQL oracle, so both ask the same question)."""

STAT_FROM_ALL = {"indicator": "1-URGENT", "op": ">", "threshold": 1.5, "year": 1997}
# passes cities whose first value is there (a missing one counts as 0.0) and is not the smallest
STAT_FROM_ALL_FIRST_YEAR = {"indicator": "5-LOW", "op": ">", "threshold": 0.1, "year": 0}
STAT_FROM_ALL_EQUAL = {"indicator": "1-URGENT", "op": "=", "threshold": 0.0, "year": 1997}
# a later delivery: nations of one region, from the year `until` on
UPSERT = {"until": 1998, "region": 2}
MULTI_COMPARE = {"indicator": "2-HIGH"}
STAT_IN_RANGE = {"indicator": "3-MEDIUM", "start": 1996, "end": 1999}
STATS_IN_RANGE = {"indicators": ["1-URGENT", "4-NOT SPECIFIED", "9-NO SUCH"],
                  "start": 1997, "end": 2000}

# spatial search: each supplier point searches around itself; radius and
# the tag asked for vary with the supplier key so several cover lengths and
# both geometry kinds (tagged nodes, ways) are exercised
FIND_BY_TAGS = {
    "radii_m": [400000, 150000, 60000, 20000],
    "searches": [("brand", "Brand#7"), ("priority", "1-URGENT"),
                 ("place", "PROMO"), ("status", "F"), ("type", "boundary")],
    "op": "=",
}
# the coded form of the search (Q1): the tag is there and differs
FIND_BY_TAGS_NOT = {"key": "brand", "value": "Brand#7", "meters": 60000, "op": "!="}
# a radius that selects: some points have no sample, some one, some several
FIND_BY_STATS = {"indicator": "3-MEDIUM", "year": 1998, "meters": 750000}
INTERPOLATE = {"indicator": "3-MEDIUM", "year": 1998, "meters": 750000, "power": 1}
DENSITY = {"length": 4}
CLUSTERS = {"length": 3}
# the pages draw clusters of 50 pixels and heat of 10
RADIUS_CLUSTERS = {"zooms": [4, 6, 8], "radius": 50}
HEAT = {"zooms": [5, 7], "radius": 10, "size": 4}

# of several lengths; one extends another
INDEX_PREFIXES = ["u0k", "u0m", "spu", "u1", "u0k7", "srb2"]
POSTING_CHUNKS = 8
POSTING_BLOCK = 100
# locality search: a nation's candidate localities are its customers, in a
# pseudo search-result order; nations of region 0 count as already resolved
FIRST_MATCH = {"rank_mul": 7919, "rank_mod": 101, "done_region": 0}
STAT_JSON = {"indicators": ["1-URGENT", "5-LOW"], "start": 1996, "end": 1998}
