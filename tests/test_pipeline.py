"""Stored pipeline on the sf0.001 raw log: counts, invariants and re-runs."""

import pathlib
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from incidentlake.config import LayerConfig
from incidentlake.plans.pipeline import reports_frame, run_pipeline
from incidentlake.schemas import GOLD_COLUMNS, GOLD_CREATED_AT, PII_COLUMNS, SILVER_COLUMNS
from incidentlake.sinks import write_csv, write_layer
from incidentlake.sources import raw_log, read_layer

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lake"))
    write_csv(raw_log(spark, SF_SMALL).repartition(3), f"{base}/raw")
    cfg = LayerConfig.under(f"{base}/lake", f"{base}/raw")
    reports = run_pipeline(spark, cfg)
    return cfg, reports


def test_layer_reports(lake):
    cfg, reports = lake
    by = {r.layer: r for r in reports}
    assert [r.layer for r in reports] == ["bronze", "silver", "gold"]
    assert (by["bronze"].rows, by["bronze"].details["rejected"]) == (1000, 0)
    assert by["silver"].rows == 950
    assert by["silver"].details["null_timestamp"] == 20
    assert by["silver"].details["null_source_port"] == 34
    assert len(by["silver"].details["top_attacks"]) == 5
    assert by["gold"].rows == 473
    assert by["gold"].details["total_incidents"] == 950


def test_silver_contract(spark, lake):
    cfg, _ = lake
    silver = read_layer(spark, cfg.silver)
    assert tuple(silver.columns) == SILVER_COLUMNS
    assert not set(PII_COLUMNS) & set(silver.columns)
    types = dict(silver.dtypes)
    assert types["timestamp"] == "timestamp_ntz"
    assert types["source_port"] == "int" and types["anomaly_score"] == "double"
    assert types["_processed_at"] == "timestamp"
    ips = silver.select("source_ip_masked", "destination_ip_masked").collect()
    # the first address of each value is masked (a second one is not the mask's business)
    first_ip = re.compile(r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}")
    assert not any(first_ip.search(v or "") for r in ips for v in r)
    assert silver.where("attack_type IS NULL OR trim(attack_type) = ''").count() == 0


def test_gold_invariants(spark, lake):
    cfg, _ = lake
    gold = read_layer(spark, cfg.gold)
    assert tuple(gold.columns) == GOLD_COLUMNS
    row = gold.agg(
        F.sum("total_incidents").alias("n"),
        F.min("malware_pct").alias("lo"),
        F.max("malware_pct").alias("hi"),
        F.count_if(F.col("first_seen") > F.col("last_seen")).alias("bad_span"),
        F.count_if(F.col("duration_hours") < 0).alias("neg"),
    ).first()
    assert row["n"] == 950 and 0 <= row["lo"] <= row["hi"] <= 100
    assert row["bad_span"] == 0 and row["neg"] == 0
    # NULL dimension values are groups of their own in Gold
    assert gold.where("severity_level IS NULL OR protocol IS NULL").count() > 0


def test_rerun_is_idempotent_and_partitioning_independent(spark, lake):
    cfg, _ = lake
    before = read_layer(spark, cfg.gold).drop(GOLD_CREATED_AT).collect()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        reports = run_pipeline(spark, cfg, ["gold"])  # re-run one layer alone
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert [r.layer for r in reports] == ["gold"]
    after = read_layer(spark, cfg.gold).drop(GOLD_CREATED_AT).collect()
    assert sorted(map(tuple, before), key=str) == sorted(map(tuple, after), key=str)


def test_unknown_layer_rejected(spark, lake):
    cfg, _ = lake
    with pytest.raises(ValueError):
        run_pipeline(spark, cfg, ["platinum"])


def test_reports_frame(spark, lake):
    _, reports = lake
    df = reports_frame(spark, reports)
    assert [r.layer for r in df.collect()] == ["bronze", "silver", "gold"]


def test_row_group_size(spark, scratch):
    df = spark.range(250_000).coalesce(1)
    write_layer(df, f"{scratch}/rg", rows_per_group=100_000)
    files = [p for p in __import__("glob").glob(f"{scratch}/rg/*.parquet")]
    md = pq.ParquetFile(files[0]).metadata
    assert [md.row_group(i).num_rows for i in range(md.num_row_groups)] == [100_000, 100_000, 50_000]
    assert md.row_group(0).column(0).compression == "SNAPPY"


def test_bronze_takes_column_order_from_header(spark, scratch):
    from incidentlake.plans.pipeline import run_bronze, run_silver
    from incidentlake.schemas import RAW_COLUMNS

    shuffled = list(reversed(RAW_COLUMNS))
    write_csv(raw_log(spark, SF_SMALL).select(*[f"`{c}`" for c in shuffled]), f"{scratch}/raw")
    cfg = LayerConfig.under(f"{scratch}/lake", f"{scratch}/raw")
    assert run_bronze(spark, cfg).rows == 1000
    assert run_silver(spark, cfg).rows == 950


def test_register_layers_for_sql(spark, lake):
    from incidentlake.sources import register_layers

    cfg, _ = lake
    assert register_layers(spark, cfg) == ["bronze", "bronze_rejects", "silver", "gold"]
    row = spark.sql("SELECT SUM(total_incidents) AS n FROM gold").first()
    assert row["n"] == spark.sql("SELECT COUNT(*) AS n FROM silver").first()["n"] == 950
    assert spark.sql("SELECT COUNT(*) AS n FROM bronze_rejects").first()["n"] == 0


def test_failed_rerun_keeps_the_old_layer(spark, scratch):
    path = f"{scratch}/layer"
    assert write_layer(spark.range(10), path) == 10
    with pytest.raises(Exception, match="(?i)broken"):
        write_layer(spark.range(5).select(F.raise_error(F.lit("broken")).alias("id")), path)
    with pytest.raises(ValueError, match="refused"):
        write_layer(spark.range(5), path, check=lambda stored: (_ for _ in ()).throw(ValueError("refused")))
    assert read_layer(spark, path).count() == 10
    assert write_layer(spark.range(7), path) == 7
    assert read_layer(spark, path).count() == 7
    assert [p.name for p in pathlib.Path(scratch).iterdir()] == ["layer"]


def test_line_breaks_in_the_stored_log(spark, scratch):
    log = raw_log(spark, SF_SMALL)
    broken = F.when(F.col("`Log Source`") == "Firewall", "Fire\nwall").otherwise("Server").alias("Log Source")
    write_csv(log.withColumn("Log Source", broken), f"{scratch}/raw")
    cfg = LayerConfig.under(f"{scratch}/lake", f"{scratch}/raw")
    report = run_pipeline(spark, cfg, ["bronze"])[0]
    assert (report.rows, report.details["rejected"]) == (1000, 0)
    assert {r[0] for r in read_layer(spark, cfg.bronze).select("`Log Source`").distinct().collect()} == {"Fire\nwall", "Server"}
    split = LayerConfig.under(f"{scratch}/split", f"{scratch}/raw", multiline_csv=False)
    with pytest.raises(ValueError, match="line break"):
        run_pipeline(spark, split, ["bronze"])
