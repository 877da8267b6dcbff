"""The plan properties the README claims, read from the physical plans."""

import uuid

import pytest
from pyspark.sql import functions as F

from orbis.operators import lookup as LK
from orbis.operators import spatial as SP
from orbis.plans import catalog, store
from orbis.session import checkpoint_root

from conftest import SF_SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture(scope="module")
def stored(spark):
    root = f"{checkpoint_root(spark)}/plans-{uuid.uuid4().hex[:8]}"
    store.use(spark, SF_SMALL, store.ingest(spark, SF_SMALL, root=root))
    return store.geometry_store(spark, SF_SMALL)


def test_prefix_scan_pushes_filters(spark, stored):
    idx = store.cell_index(spark, SF_SMALL)
    text = formatted(LK.scan_index_by_prefixes(idx, ["u0k", "spu"]).select("cell", "id"))
    assert "GreaterThanOrEqual(cell,u0k)" in text and "LessThan(cell,u0l)" in text
    assert "GreaterThanOrEqual(cell,spu)" in text and "LessThan(cell,spv)" in text
    assert "ReadSchema: struct<cell:string,id:string>" in text


def test_prefix_scan_reads_its_partitions_only(spark, stored):
    idx = store.cell_index(spark, SF_SMALL)
    text = formatted(LK.scan_index_by_prefixes(idx, ["u0k", "spu7"]).select("cell", "id"))
    filters = next(x for x in text.splitlines() if x.startswith("PartitionFilters"))
    assert "cell3" in filters and "u0k" in filters and "spu" in filters


def test_point_search_prunes_index_partitions(spark, stored):
    geoms, idx = stored
    pts = spark.createDataFrame([(1, 10.0, 45.0)], "qid int, lon double, lat double")
    df = SP.find_by_tags(geoms, idx, pts, "status", "F", 20000)
    assert "dynamicpruningexpression(cell3" in formatted(df)
    everywhere = SP.find_by_tags(geoms, idx.drop("cell3"), pts, "status", "F", 20000)
    assert sorted(r.id for r in df.collect()) == sorted(r.id for r in everywhere.collect())


def test_small_query_side_is_broadcast(spark, stored):
    text = plan_of(catalog.q_find_by_tags(spark, SF_SMALL))
    assert "BroadcastExchange" in text or "BroadcastHashJoin" in text


def test_geometry_lookup_prunes_kind_partitions(spark, stored):
    text = formatted(catalog.q_find_by_stats(spark, SF_SMALL))
    assert "dynamicpruningexpression(kind" in text


def scans(df) -> int:
    return plan_of(df).count("FileScan parquet")


def test_statistics_queries_scan_the_stored_table_once(spark):
    text = formatted(catalog.q_stat_in_range(spark, SF_SMALL))
    assert scans(catalog.q_stat_in_range(spark, SF_SMALL)) == 1 and "EqualTo(indicator," in text
    assert "value_raw" not in text.split("ReadSchema")[1].splitlines()[0]
    # the dictionary and the statistics, each once
    for q in (catalog.q_multi_compare_stat, catalog.q_stats_in_range, catalog.q_stat_json):
        assert scans(q(spark, SF_SMALL)) == 2, q.__name__


def test_facts_are_scanned_once_when_stored(spark):
    from orbis.operators import statistics as ST
    from orbis.sources import fixtures as FX
    text = plan_of(ST.stat_facts(FX.stat_csv(spark, SF_SMALL), FX.names(spark, SF_SMALL)))
    assert text.count("orders.parquet") == 1


def test_members_are_joined_once(spark):
    from orbis.operators import build as B
    from orbis.sources import fixtures as FX
    g, _ = store.geometry_store(spark, SF_SMALL)
    ways = g.where("kind = 'w'")
    rels = B.build_relations(FX.relation_members(spark, SF_SMALL), FX.relation_tags(spark, SF_SMALL),
                             FX.raw_nodes(spark, SF_SMALL), ways)
    text = plan_of(rels)
    assert text.count("orders.parquet") == 1 and text.count("part.parquet") == 1
