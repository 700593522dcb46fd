"""Gold on skewed input: one group holds a third of all rows. Checked against
a brute-force pandas computation on the same rows."""

import datetime as dt
import random

import pandas as pd

from incidentlake.operators.gold import aggregate_incidents, incident_base
from incidentlake.schemas import GOLD_DIMS

SILVER_COLS = (
    "attack_type string, severity_level string, protocol string, action_taken string, "
    "network_segment string, anomaly_score double, packet_length int, timestamp timestamp_ntz, "
    "source_ip_masked string, destination_ip_masked string, malware_indicators string"
)


def make_rows(n=30000, seed=5):
    rng = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        hot = i % 3 == 0  # a third of all rows in one group
        dims = ("DDOS", "HIGH", "TCP", "BLOCKED", "Segment A") if hot else (
            rng.choice(["MALWARE", "INTRUSION", None]), rng.choice(["LOW", "CRITICAL"]),
            rng.choice(["UDP", "ICMP", None]), rng.choice(["LOGGED", "IGNORED"]), rng.choice(["Segment B", "Segment C"]))
        src = None if rng.random() < 0.05 else f"{rng.randint(10, 60)}.{rng.randint(0, 40)}.*.*"
        dst = None if rng.random() < 0.05 else f"{rng.randint(100, 120)}.{rng.randint(0, 8)}.*.*"
        rows.append((*dims, None if rng.random() < 0.02 else round(rng.uniform(0, 100), 2),
                     rng.randint(64, 1500), base + dt.timedelta(seconds=rng.randint(0, 30 * 86400)),
                     src, dst, rng.choice(["IOC DETECTED", "MALWARE DETECTED", "CLEAN", None])))
    return rows


def test_gold_on_hot_group_matches_brute_force(spark):
    rows = make_rows()
    silver = spark.createDataFrame(rows, SILVER_COLS).repartition(7)
    measures = ["total_incidents", "max_packet_length", "malware_detected_count",
                "unique_source_networks", "unique_dest_networks", "first_seen", "last_seen",
                "avg_anomaly_score"]
    got = aggregate_incidents(incident_base(silver), measures).toPandas()

    pdf = pd.DataFrame(rows, columns=[c.split()[0] for c in SILVER_COLS.split(", ")])
    pdf = pdf[pdf["attack_type"].notna()].copy()  # Gold's guard (W5)
    pdf["has_malware"] = pdf["malware_indicators"].isin(["IOC DETECTED", "MALWARE DETECTED"]).astype(int)
    want = pdf.groupby(list(GOLD_DIMS), dropna=False).agg(
        total_incidents=("has_malware", "size"),
        max_packet_length=("packet_length", "max"),
        malware_detected_count=("has_malware", "sum"),
        unique_source_networks=("source_ip_masked", "nunique"),
        unique_dest_networks=("destination_ip_masked", "nunique"),
        first_seen=("timestamp", "min"),
        last_seen=("timestamp", "max"),
        avg_anomaly_score=("anomaly_score", "mean"),
    ).reset_index()

    key = lambda df: df.fillna({d: "<null>" for d in GOLD_DIMS}).sort_values(list(GOLD_DIMS)).reset_index(drop=True)
    got, want = key(got), key(want)
    assert len(got) == len(want)
    hot = got[got["attack_type"] == "DDOS"]
    assert int(hot["total_incidents"].iloc[0]) == 10000
    for m in measures:
        if m == "avg_anomaly_score":
            assert ((got[m] - want[m].round(4)).abs() < 1e-4 + 1e-9).all()
        else:
            assert got[m].astype(str).tolist() == want[m].astype(str).tolist(), m
