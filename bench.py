"""Benchmark: headline queries on the driver tables.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line.  Every query is forced through the ``noop`` sink, so
all of its columns are computed (``count()`` would let Catalyst prune them).
``ingest`` builds and writes the geometry table and cell index from scratch
into a fresh folder; the spatial queries after it read that store.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = ["nodes", "ways", "relations", "relation_rings", "cell_index", "find_by_tags",
            "find_by_stats", "interpolate", "density", "clusters", "stat_series",
            "stat_from_all", "multi_compare_stat", "stat_in_range", "stats_in_range"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from orbis.session import local_session
    from orbis.plans import catalog, store

    from orbis.session import checkpoint_root

    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * int(cpus)), app="orbis-bench")
    # a fresh folder under the shared checkpoint root, so ingest is timed whole
    fresh = f"{checkpoint_root(spark)}/orbis-bench-{uuid.uuid4().hex[:12]}"

    times: dict[str, float] = {}
    t0 = time.time()
    store.use(spark, sf_dir, store.ingest(spark, sf_dir, root=fresh))
    times["ingest"] = round(time.time() - t0, 3)

    names = [n for n in HEADLINE if n in catalog.QUERIES]
    names += [n for n in catalog.QUERIES if n not in names]
    for name in names:
        t0 = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
