"""Reports and ranks when one order, part and supplier hold a third of all flights.

Every join is a shuffle join and the limits of AQE are low enough for it to split the hot
partitions of these small tables.
"""

import __spark_entry__ as entry
import duckdb
import pytest
from compare import connect, differences

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000",
}
KEYS = [
    "carrier_performance", "route_analysis", "airport_performance", "airport_metrics_join",
    "time_based_analysis", "distance_based_analysis", "overall_performance_metrics",
    "delay_severity_analysis", "graph_vertices", "graph_counts", "airport_pagerank",
    "ml_features", "string_index", "classification_metrics",
]


@pytest.fixture(scope="module")
def skewed_dir(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in ("orders", "customer", "supplier", "part", "nation", "region"):
        con.execute(f"COPY (FROM '{sf_dir}/{name}.parquet') TO '{folder}/{name}.parquet'")
    con.execute(f"""COPY (SELECT * EXCLUDE (n) REPLACE (
        CASE WHEN n % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN n % 3 = 0 THEN 11 ELSE l_partkey END AS l_partkey,
        CASE WHEN n % 3 = 0 THEN 3 ELSE l_suppkey END AS l_suppkey)
      FROM (SELECT *, row_number() OVER () AS n FROM '{sf_dir}/lineitem.parquet'))
      TO '{folder}/hot.parquet'""")
    # several files, since a partition is split between the tasks that wrote it
    hot = spark.read.parquet(f"{folder}/hot.parquet")
    hot.repartition(6).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def shuffle_joins(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.mark.parametrize("key", KEYS)
def test_hot_keys(spark, skewed_dir, shuffle_joins, key):
    found = entry.queries()[key](spark, skewed_dir)
    assert differences(found, connect(skewed_dir), entry.oracle_sql()[key]) == []


def test_hot_partitions_are_split(spark, skewed_dir, shuffle_joins):
    df = entry.queries()["carrier_performance"](spark, skewed_dir)
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
