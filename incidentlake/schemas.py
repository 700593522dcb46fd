"""Column contract of the three layers.

Bronze keeps the source CSV as text, Silver is typed and privacy-safe, Gold is
the incident fact table. The Silver projection is declared once here
(``SILVER_SPEC``) and every Silver operator is built from it.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The 25 column names of the source CSV, in file order.
RAW_COLUMNS: tuple[str, ...] = (
    "Timestamp",
    "Source IP Address",
    "Destination IP Address",
    "Source Port",
    "Destination Port",
    "Protocol",
    "Packet Length",
    "Packet Type",
    "Traffic Type",
    "Payload Data",
    "Malware Indicators",
    "Anomaly Scores",
    "Alerts/Warnings",
    "Attack Type",
    "Attack Signature",
    "Action Taken",
    "Severity Level",
    "User Information",
    "Device Information",
    "Network Segment",
    "Geo-location Data",
    "Proxy Information",
    "Firewall Logs",
    "IDS/IPS Alerts",
    "Log Source",
)

# Every raw column is landed as text; typing is Silver's job.
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# Bronze metadata columns.
CORRUPT_RECORD = "_corrupt_record"
INGESTED_AT = "_ingested_at"
PROCESSED_AT = "_processed_at"
GOLD_CREATED_AT = "_gold_created_at"

# Raw columns holding personal or traceable data, removed in Silver.
PII_COLUMNS: tuple[str, ...] = ("Payload Data", "User Information", "Proxy Information")

# Silver projection as (silver name, raw name, rule), in output order.
# Rules: timestamp / int / double = lenient parse; mask = IPv4 network mask;
# upper = UPPER(TRIM); trim = TRIM.
SILVER_SPEC: tuple[tuple[str, str, str], ...] = (
    ("timestamp", "Timestamp", "timestamp"),
    ("source_port", "Source Port", "int"),
    ("destination_port", "Destination Port", "int"),
    ("packet_length", "Packet Length", "int"),
    ("anomaly_score", "Anomaly Scores", "double"),
    ("source_ip_masked", "Source IP Address", "mask"),
    ("destination_ip_masked", "Destination IP Address", "mask"),
    ("protocol", "Protocol", "upper"),
    ("packet_type", "Packet Type", "upper"),
    ("traffic_type", "Traffic Type", "upper"),
    ("attack_type", "Attack Type", "upper"),
    ("attack_signature", "Attack Signature", "upper"),
    ("action_taken", "Action Taken", "upper"),
    ("severity_level", "Severity Level", "upper"),
    ("malware_indicators", "Malware Indicators", "upper"),
    ("alerts_warnings", "Alerts/Warnings", "trim"),
    ("network_segment", "Network Segment", "trim"),
    ("geo_location", "Geo-location Data", "trim"),
    ("log_source", "Log Source", "trim"),
    ("device_info", "Device Information", "trim"),
    ("ids_ips_alerts", "IDS/IPS Alerts", "trim"),
    ("firewall_logs", "Firewall Logs", "trim"),
)
SILVER_DATA_COLUMNS: tuple[str, ...] = tuple(s for s, _, _ in SILVER_SPEC)
SILVER_COLUMNS: tuple[str, ...] = SILVER_DATA_COLUMNS + (INGESTED_AT, PROCESSED_AT)

# Gold grain (five dimensions) and measure names, in output order.
GOLD_DIMS: tuple[str, ...] = (
    "attack_type",
    "severity_level",
    "protocol",
    "action_taken",
    "network_segment",
)
GOLD_MEASURES: tuple[str, ...] = (
    "total_incidents",
    "avg_anomaly_score",
    "max_anomaly_score",
    "avg_packet_length",
    "max_packet_length",
    "malware_detected_count",
    "malware_pct",
    "unique_source_networks",
    "unique_dest_networks",
    "first_seen",
    "last_seen",
    "duration_hours",
)
GOLD_COLUMNS: tuple[str, ...] = GOLD_DIMS + GOLD_MEASURES + (GOLD_CREATED_AT,)

# Malware indicator values (after UPPER/TRIM) that count as a detection.
MALWARE_POSITIVE: tuple[str, ...] = ("IOC DETECTED", "MALWARE DETECTED")

# Severity levels from least to most severe.
SEVERITY_ORDER: tuple[str, ...] = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
CRITICAL = "CRITICAL"
