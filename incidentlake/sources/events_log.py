"""Raw 25-column attack log derived from the ``events`` table.

One log line per ``events`` row, deterministic, with dirt on purpose (NULLs,
unparsable values and dates of several forms, blanks, stray Unicode spaces,
mixed case, IPv6 and second IPv4 addresses, numerals of many forms, scores of
5e12, seven decimals and NaN, fourteen attack types). Each expression is plain SQL that Spark and DuckDB evaluate
identically, so the same text builds the Spark input and the SQL oracle's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from incidentlake.schemas import RAW_COLUMNS

# Raw column -> SQL expression over ``events``.
RAW_LOG_EXPRESSIONS: dict[str, str] = {
    "Timestamp": "CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'not-a-date' WHEN event_id % 31 = 3 THEN replace(substr(CAST(ts AS STRING),1,19),'-','/') "
    "WHEN event_id % 31 = 4 THEN concat(substr(CAST(ts AS STRING),1,10),'T',substr(CAST(ts AS STRING),12,8),'Z') WHEN event_id % 211 = 1 THEN '2024' WHEN event_id % 211 = 2 THEN '2024-01' "
    "WHEN event_id % 211 = 3 THEN '2024-01-02 10' WHEN event_id % 211 = 5 THEN '2024-01-02 24:00:00' WHEN event_id % 211 = 6 THEN 'epoch' ELSE substr(CAST(ts AS STRING),1,19) END",
    "Source IP Address": "concat(CAST(10 + user_id % 40 AS STRING),'.',CAST(event_id % 16 AS STRING),'.',CAST((event_id*7) % 256 AS STRING),'.',CAST((event_id*13) % 256 AS STRING),CASE WHEN event_id % 7 = 0 THEN ' via 10.20.30.40' ELSE '' END)",
    "Destination IP Address": "CASE WHEN event_id % 71 = 0 THEN '2001:db8::1' ELSE concat(CAST(100 + user_id % 20 AS STRING),'.',CAST((event_id*3) % 8 AS STRING),'.',CAST((event_id*5) % 256 AS STRING),'.',CAST((event_id*11) % 256 AS STRING)) END",
    "Source Port": "CASE WHEN event_id % 83 = 0 THEN 'n/a' WHEN event_id % 199 = 1 THEN '12.5d' WHEN event_id % 199 = 2 THEN '12.5f' WHEN event_id % 199 = 3 THEN '5F' WHEN event_id % 199 = 4 THEN '0x1p3' "
    "WHEN event_id % 199 = 5 THEN '1_000' WHEN event_id % 199 = 6 THEN '0x1F' WHEN event_id % 199 = 7 THEN '12.5' WHEN event_id % 199 = 8 THEN ' 1e3 ' ELSE CAST(1024 + (event_id*31) % 64511 AS STRING) END",
    "Destination Port": "CASE WHEN event_id % 79 = 0 THEN '99999999999' ELSE CAST(1 + (event_id*37) % 1023 AS STRING) END",
    "Protocol": "CASE WHEN event_id % 61 = 0 THEN NULL WHEN event_id % 3 = 0 THEN ' tcp ' WHEN event_id % 3 = 1 THEN 'UDP' ELSE 'Icmp' END",
    "Packet Length": "CAST(64 + (event_id*17) % 1437 AS STRING)",
    "Packet Type": "CASE WHEN event_id % 2 = 0 THEN 'Data' ELSE 'Control' END",
    "Traffic Type": "CASE WHEN event_id % 7 < 3 THEN 'HTTP' WHEN event_id % 7 < 5 THEN 'dns' ELSE ' FTP' END",
    "Payload Data": "props",
    "Malware Indicators": "CASE WHEN event_id % 5 < 2 THEN 'IoC Detected' WHEN event_id % 5 = 2 THEN ' malware detected ' WHEN event_id % 5 = 3 THEN 'Clean' ELSE NULL END",
    "Anomaly Scores": "CASE WHEN event_id % 53 = 0 THEN 'NaN' WHEN event_id % 173 = 0 THEN '5000000000000' WHEN event_id % 67 = 0 THEN NULL WHEN event_id % 193 = 1 THEN '12.5d' WHEN event_id % 193 = 2 THEN '1_0.5' "
    "WHEN event_id % 193 = 3 THEN '5F' WHEN event_id % 61 = 5 THEN '0.0000004' WHEN event_id % 61 = 6 THEN '37.1234567' ELSE CAST(value AS STRING) END",
    "Alerts/Warnings": "CASE WHEN event_id % 2 = 1 THEN ' Alert Triggered ' ELSE NULL END",
    "Attack Type": "CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 47 = 0 THEN '   ' WHEN event_id % 173 = 0 THEN 'Overflow Test' WHEN event_type = 'click' AND user_id % 12 < 4 THEN 'DDoS' "
    "WHEN event_type = 'click' THEN concat('Campaign ', CAST(user_id % 12 AS STRING)) WHEN event_type = 'view' THEN ' \u00a0malware\u3000' WHEN event_type = 'error' THEN 'Intrusion' WHEN event_type = 'purchase' THEN 'phishing' ELSE 'Ransomware' END",
    "Attack Signature": "CASE WHEN event_id % 2 = 0 THEN 'Known Pattern A' ELSE 'Known Pattern B' END",
    "Action Taken": "CASE WHEN event_id % 59 = 0 THEN NULL WHEN event_id % 11 < 4 THEN 'Logged' WHEN event_id % 11 < 8 THEN 'Blocked' ELSE ' ignored' END",
    "Severity Level": "CASE WHEN user_id % 37 = 0 OR event_id % 173 = 0 THEN NULL WHEN user_id % 4 = 0 THEN 'Low' WHEN user_id % 4 = 1 THEN 'Medium' WHEN user_id % 4 = 2 THEN 'High\u2003' ELSE 'critical' END",
    "User Information": "concat('User ', CAST(user_id AS STRING))",
    "Device Information": "' Mozilla/5.0 '",
    "Network Segment": "CASE WHEN user_id % 3 = 0 THEN 'Segment A' WHEN user_id % 3 = 1 THEN ' Segment B\u00a0' ELSE 'Segment C' END",
    "Geo-location Data": "concat('City ', CAST(user_id % 9 AS STRING))",
    "Proxy Information": "CASE WHEN event_id % 2 = 0 THEN '150.9.97.135' ELSE NULL END",
    "Firewall Logs": "CASE WHEN event_id % 2 = 0 THEN 'Log Data' ELSE NULL END",
    "IDS/IPS Alerts": "CASE WHEN event_id % 3 = 0 THEN 'Alert Data' ELSE NULL END",
    "Log Source": "CASE WHEN event_id % 2 = 0 THEN 'Server' ELSE 'Firewall' END",
}


def raw_log_select_sql(quote: str = '"') -> str:
    """SELECT list of the raw log, output names quoted with ``quote``."""
    return ",\n  ".join(
        f"{RAW_LOG_EXPRESSIONS[c]} AS {quote}{c}{quote}" for c in RAW_COLUMNS
    )


def raw_log_from_events(events: DataFrame) -> DataFrame:
    """Raw log (25 text columns) from an ``events`` DataFrame. Map-only."""
    return events.selectExpr(
        *(f"{RAW_LOG_EXPRESSIONS[c]} AS `{c}`" for c in RAW_COLUMNS)
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_log_from_events(read_events(spark, sf_dir))
