"""Every Gold-reading query on a random Gold table against its oracle SQL:
more than 12 attack types (the top-12 cut), tied totals, unknown and NULL
severities, NULL protocols and actions."""

import itertools
import random

import duckdb

from incidentlake.operators import marts
from compare import compare
from incidentlake.plans.oracle import GOLD_FILTER_SUBSET, HEATMAP_PROTOCOLS, mart_sql

SCHEMA = (
    "attack_type string, severity_level string, protocol string, action_taken string, "
    "network_segment string, total_incidents bigint, avg_anomaly_score double, "
    "max_anomaly_score double, avg_packet_length double, max_packet_length int, "
    "malware_detected_count bigint, malware_pct double, unique_source_networks bigint, "
    "unique_dest_networks bigint"
)


def random_gold(seed=3):
    rng = random.Random(seed)
    attacks = [f"A{i:02d}" for i in range(20)] + ["DDOS", "MALWARE", "INTRUSION", None]
    combos = list(itertools.product(attacks, ["LOW", "MEDIUM", "HIGH", "CRITICAL", "SEVERE", None],
                                    ["TCP", "UDP", "ICMP", None], ["LOGGED", "BLOCKED", None], ["Segment A"]))
    rows = []
    for dims in rng.sample(combos, 700):
        n = rng.randint(1, 6)
        mal = rng.randint(0, n)
        rows.append((*dims, n, rng.choice([round(rng.uniform(0, 100), 4), 50.0, None]),
                     round(rng.uniform(0, 100), 4), round(rng.uniform(64, 1500), 2), rng.randint(64, 1500),
                     mal, round(100.0 * mal / n, 2), rng.randint(0, 5), rng.randint(0, 5)))
    return rows


def spark_marts(gold):
    sub = GOLD_FILTER_SUBSET
    f = marts.filter_gold(gold)
    k = marts.kpis(f)
    return {
        "opt_severity": marts.dimension_options(gold, "severity_level"),
        "opt_attack": marts.dimension_options(gold, "attack_type"),
        "opt_protocol": marts.dimension_options(gold, "protocol"),
        "opt_all": marts.all_dimension_options(gold),
        "gold_filtered": marts.filter_gold(gold, sub["severities"], sub["attacks"], sub["protocols"]),
        "kpis": k,
        "kpis_formatted": marts.kpis_formatted(k),
        "mart_attack_volume": marts.attack_volume(f, 12),
        "mart_severity_share": marts.severity_share(f),
        "mart_attack_protocol": marts.attack_protocol(f),
        "mart_heatmap": marts.heatmap(f, HEATMAP_PROTOCOLS),
        "mart_heatmap_cells": marts.heatmap_cells(f),
        "mart_anomaly": marts.anomaly_by_attack(f),
        "mart_severity_action": marts.severity_action(f),
        "mart_malware_pct": marts.malware_by_attack(f),
        "mart_top_incidents": marts.top_incidents(f, 50),
        "mart_top_incidents_labelled": marts.top_incidents(f, 50, marts.DISPLAY_LABELS),
    }


def test_marts_on_random_gold_match_oracle(spark):
    rows = random_gold()
    gold = spark.createDataFrame(rows, SCHEMA)
    frame = gold.toPandas()
    con = duckdb.connect()
    con.register("t", frame)
    cte = "gold AS (SELECT * FROM t)"
    sqls = mart_sql(cte)
    results = spark_marts(gold)
    assert set(results) == set(sqls)
    assert results["mart_attack_volume"].count() == 12
    failed = {}
    for name, df in results.items():
        ok, msg = compare(df.toPandas(), con.execute(sqls[name]).df())
        if not ok:
            failed[name] = msg
    assert not failed, failed
