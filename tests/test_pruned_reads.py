"""Clustered layers: a filtered read takes in fewer row groups, and the same rows."""

import pytest
from pyspark.sql import functions as F

from incidentlake.layers import commit_layer
from incidentlake.operators.silver import to_silver
from incidentlake.sources import raw_log, read_layer

from conftest import SF_SMALL


def scanned_rows(df):
    """Rows that the scan gives after whole row groups were skipped."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        if "Scan" in node.nodeName():
            found.append(node)
        for child in (node.executedPlan(),) if node.nodeName().startswith("AdaptiveSparkPlan") else [node.children().apply(i) for i in range(node.children().size())]:
            walk(child)

    df.collect()
    walk(plan)
    return sum(n.metrics().apply("numOutputRows").value() for n in found)


@pytest.fixture(scope="module")
def silver(spark):
    log = to_silver(raw_log(spark, SF_SMALL), stamps=False)
    return log.unionByName(log).unionByName(log).unionByName(log).repartition(2).cache()


def pruned(spark, path):
    return read_layer(spark, path).where((F.col("attack_type") == "MALWARE") & (F.col("severity_level") == "HIGH"))


@pytest.mark.parametrize("partitions", [None, 4])
def test_a_filter_skips_row_groups(spark, silver, scratch, partitions):
    commit_layer(silver, f"{scratch}/plain", rows_per_group=100)
    commit_layer(silver, f"{scratch}/sorted", rows_per_group=100, cluster_by=["attack_type", "severity_level"], cluster_partitions=partitions)
    plain, clustered = pruned(spark, f"{scratch}/plain"), pruned(spark, f"{scratch}/sorted")
    assert sorted(map(str, clustered.collect())) == sorted(map(str, plain.collect()))
    n = plain.count()
    assert n > 0 and scanned_rows(pruned(spark, f"{scratch}/plain")) == silver.count()
    assert scanned_rows(pruned(spark, f"{scratch}/sorted")) < silver.count() / 4
    assert read_layer(spark, f"{scratch}/sorted").count() == silver.count()


def test_bloom_filters_skip_look_ups(spark, scratch):
    """Values among many; where a dictionary holds them all, Parquet needs no filter."""
    rows = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("key")).repartition(2)
    commit_layer(rows, f"{scratch}/bloom", bloom_columns=["key"], rows_per_group=30_000)
    commit_layer(rows, f"{scratch}/plain", rows_per_group=30_000)
    look = lambda name, v: read_layer(spark, f"{scratch}/{name}").where(F.col("key") == v)
    one = rows.first()["key"]
    assert [r["key"] for r in look("bloom", one).collect()] == [one]
    absent = "7" * 64
    assert scanned_rows(look("plain", absent)) == 60_000 and scanned_rows(look("bloom", absent)) == 0


def test_clustered_and_partitioned(spark, silver, scratch):
    commit_layer(silver, f"{scratch}/both", partition_by=["protocol"], cluster_by=["attack_type"], rows_per_group=100)
    got = read_layer(spark, f"{scratch}/both")
    assert got.columns == silver.columns and sorted(map(str, got.collect())) == sorted(map(str, silver.collect()))
