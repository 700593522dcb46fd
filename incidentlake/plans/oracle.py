"""Independent SQL statement of every registered query, for DuckDB.

Written from the meaning of the layers, with its own literals; only the raw log
itself (the fixture, SQL text over ``events``) is shared with the Spark side.
TRY_CAST parsing, first-match REGEXP_REPLACE, DATE_DIFF hour boundaries and SQL
ROUND are DuckDB's own, so a match checks the Spark re-expressions of those
semantics, not just the plumbing. Tables ``events`` and ``documents`` are views
registered by the checker.
"""

from __future__ import annotations

from incidentlake.sources.events_log import raw_log_select_sql

# The registered Bronze load writes every event whose id is a
# multiple of this number as a malformed line (one field too many).
MALFORMED_EVERY = 101

# The choices of the registered filter and heatmap queries.
GOLD_FILTER_SUBSET = {
    "severities": ("HIGH", "CRITICAL"),
    "attacks": ("DDOS", "MALWARE", "INTRUSION"),
    "protocols": ("TCP", "UDP"),
}
HEATMAP_PROTOCOLS = ("ICMP", "TCP", "UDP")

RAW_NAMES = (
    "Timestamp", "Source IP Address", "Destination IP Address", "Source Port", "Destination Port", "Protocol",
    "Packet Length", "Packet Type", "Traffic Type", "Payload Data", "Malware Indicators", "Anomaly Scores",
    "Alerts/Warnings", "Attack Type", "Attack Signature", "Action Taken", "Severity Level", "User Information",
    "Device Information", "Network Segment", "Geo-location Data", "Proxy Information", "Firewall Logs",
    "IDS/IPS Alerts", "Log Source",
)


def _avg(c: str) -> str:
    """Average of doubles: whole parts and fractions in units of 2^-60 summed as
    huge integers; NaN and infinities plainly."""
    unit = 2**60
    whole, fraction = f"TRY_CAST(trunc({c}) AS HUGEINT)", f"TRY_CAST(trunc(({c} - trunc({c})) * {unit}) AS HUGEINT)"
    total = f"CAST(sum({whole}) * {unit} + sum({fraction}) AS DOUBLE) / {unit}"
    return f"CASE WHEN bool_or(NOT isfinite({c})) THEN avg({c}) ELSE {total} / nullif(count({c}), 0) END"


def _network(c: str) -> str:
    # Fixed value: the pattern of the mask.
    return f"""REGEXP_REPLACE("{c}", '(\\d{{1,3}}\\.\\d{{1,3}})\\.\\d{{1,3}}\\.\\d{{1,3}}', '\\1.*.*')"""


TYPED = """TRY_CAST("Timestamp" AS TIMESTAMP) AS timestamp, TRY_CAST("Source Port" AS INTEGER) AS source_port,
  TRY_CAST("Destination Port" AS INTEGER) AS destination_port, TRY_CAST("Packet Length" AS INTEGER) AS packet_length,
  TRY_CAST("Anomaly Scores" AS DOUBLE) AS anomaly_score"""
MASKED = f"""{_network('Source IP Address')} AS source_ip_masked, {_network('Destination IP Address')} AS destination_ip_masked"""
NORMALISED = """upper(trim("Protocol")) AS protocol, upper(trim("Packet Type")) AS packet_type, upper(trim("Traffic Type")) AS traffic_type,
  upper(trim("Attack Type")) AS attack_type, upper(trim("Attack Signature")) AS attack_signature, upper(trim("Action Taken")) AS action_taken,
  upper(trim("Severity Level")) AS severity_level, upper(trim("Malware Indicators")) AS malware_indicators,
  trim("Alerts/Warnings") AS alerts_warnings, trim("Network Segment") AS network_segment, trim("Geo-location Data") AS geo_location,
  trim("Log Source") AS log_source, trim("Device Information") AS device_info, trim("IDS/IPS Alerts") AS ids_ips_alerts,
  trim("Firewall Logs") AS firewall_logs"""

DIMS = "attack_type, severity_level, protocol, action_taken, network_segment"

RAW_CTE = f"raw AS (\n  SELECT\n  {raw_log_select_sql()}\n  FROM events\n)"

QUALITY_WHERE = """"Timestamp" IS NOT NULL AND "Attack Type" IS NOT NULL AND trim("Attack Type") <> ''"""

SILVER_CTE = f"silver AS (\n  SELECT {TYPED},\n  {MASKED},\n  {NORMALISED}\n  FROM raw WHERE {QUALITY_WHERE}\n)"

# The rows that Gold counts, each with 1 or 0 for malware.
BASE_CTE = f"""base AS (
  SELECT {DIMS}, anomaly_score, packet_length, timestamp, source_ip_masked, destination_ip_masked,
         CAST(coalesce(malware_indicators = 'IOC DETECTED' OR malware_indicators = 'MALWARE DETECTED', false) AS INTEGER) AS has_malware
  FROM silver WHERE attack_type IS NOT NULL
)"""

GOLD_MEASURE_SQL = {
    "total_incidents": "count(*)",
    "avg_anomaly_score": f"round({_avg('anomaly_score')}, 4)",
    "max_anomaly_score": "round(max(anomaly_score), 4)",
    "avg_packet_length": "round(CAST(sum(packet_length) AS DOUBLE) / nullif(count(packet_length), 0), 2)",
    "max_packet_length": "max(packet_length)",
    "malware_detected_count": "CAST(sum(has_malware) AS BIGINT)",
    "malware_pct": "round(CAST(100.0 AS DOUBLE) * sum(has_malware) / nullif(count(*), 0), 2)",
    "unique_source_networks": "count(DISTINCT source_ip_masked)",
    "unique_dest_networks": "count(DISTINCT destination_ip_masked)",
    "first_seen": "min(timestamp)",
    "last_seen": "max(timestamp)",
    "duration_hours": "date_diff('hour', min(timestamp), max(timestamp))",
}


def gold_select(measures) -> str:
    cols = ",\n    ".join(f"{GOLD_MEASURE_SQL[m]} AS {m}" for m in measures)
    return f"SELECT {DIMS},\n    {cols}\n  FROM base\n  GROUP BY {DIMS}"


GOLD_CTE = f"gold AS (\n  {gold_select(list(GOLD_MEASURE_SQL))}\n)"

FILTERED_CTE = (
    "filtered AS (SELECT * FROM gold WHERE severity_level IS NOT NULL "
    "AND attack_type IS NOT NULL AND protocol IS NOT NULL)"
)


def _lit_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def over_raw(body: str) -> str:
    return with_ctes(RAW_CTE, body=body)


def over_silver(body: str) -> str:
    return with_ctes(RAW_CTE, SILVER_CTE, body=body)


def over_base(body: str) -> str:
    return with_ctes(RAW_CTE, SILVER_CTE, BASE_CTE, body=body)


def over_gold(body: str) -> str:
    return with_ctes(RAW_CTE, SILVER_CTE, BASE_CTE, GOLD_CTE, body=body)


def over_filtered(body: str) -> str:
    return with_ctes(RAW_CTE, SILVER_CTE, BASE_CTE, GOLD_CTE, FILTERED_CTE, body=body)


def _sev_rank_sql(c: str) -> str:
    return f"CASE {c} WHEN 'LOW' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'HIGH' THEN 3 WHEN 'CRITICAL' THEN 4 END"


def _gold_measures(*names: str) -> str:
    return over_base(gold_select(names))


_KPI_BODY = f"""kpis AS (
  SELECT CAST(COALESCE(SUM(total_incidents), 0) AS BIGINT) AS total_incidents,
         COUNT(DISTINCT attack_type) AS distinct_attacks,
         {_avg('avg_anomaly_score')} AS avg_anomaly,
         CAST(COALESCE(SUM(malware_detected_count), 0) AS BIGINT) AS total_malware,
         CAST(COALESCE(SUM(CASE WHEN severity_level = 'CRITICAL' THEN total_incidents END), 0) AS BIGINT) AS critical_count,
         CAST(COALESCE(SUM(unique_source_networks), 0) AS BIGINT) AS distinct_networks
  FROM filtered
)"""

_TABLE_COLS = (
    "attack_type, severity_level, protocol, action_taken, network_segment, total_incidents, "
    "avg_anomaly_score, malware_detected_count, malware_pct, unique_source_networks"
)

_TABLE_ORDER = ", ".join(f"{d} ASC NULLS LAST" for d in DIMS.split(", "))

_MALWARE_PCT = "round_even(100 * malware / total, 2)"


def _on_gold(ctes, body: str) -> str:
    return with_ctes(*ctes, body=body)


def _on_filtered(ctes, body: str) -> str:
    return with_ctes(*ctes, FILTERED_CTE, body=body)


def mart_sql(gold_cte: str | None = None) -> dict[str, str]:
    """SQL of the Gold-reading queries. ``gold_cte`` (``gold AS (...)``)
    replaces the raw -> Silver -> Gold chain, to check marts on any Gold."""
    ctes = (gold_cte,) if gold_cte else (RAW_CTE, SILVER_CTE, BASE_CTE, GOLD_CTE)
    sub = GOLD_FILTER_SUBSET
    return {
        "opt_severity": _on_gold(ctes, 
            "SELECT DISTINCT severity_level FROM gold WHERE severity_level IS NOT NULL ORDER BY 1"
        ),
        "opt_attack": _on_gold(ctes, 
            "SELECT DISTINCT attack_type FROM gold WHERE attack_type IS NOT NULL ORDER BY 1"
        ),
        "opt_protocol": _on_gold(ctes, 
            "SELECT DISTINCT protocol FROM gold WHERE protocol IS NOT NULL ORDER BY 1"
        ),
        "opt_all": _on_gold(ctes, 
            "SELECT DISTINCT dimension, value FROM ("
            + " UNION ALL ".join(
                f"SELECT '{d}' AS dimension, {d} AS value FROM gold"
                for d in ("severity_level", "attack_type", "protocol")
            )
            + ") WHERE value IS NOT NULL ORDER BY dimension, value"
        ),
        "gold_filtered": _on_gold(ctes, 
            f"SELECT * FROM gold WHERE severity_level IN ({_lit_list(sub['severities'])}) "
            f"AND attack_type IN ({_lit_list(sub['attacks'])}) "
            f"AND protocol IN ({_lit_list(sub['protocols'])})"
        ),
        "kpis": with_ctes(
            *ctes, FILTERED_CTE, _KPI_BODY,
            body="SELECT * FROM kpis",
        ),
        "kpis_formatted": with_ctes(
            *ctes, FILTERED_CTE, _KPI_BODY,
            body=(
                "SELECT format('{:,}', total_incidents) AS total_incidents, "
                "CAST(distinct_attacks AS VARCHAR) AS distinct_attacks, "
                "printf('%.2f', avg_anomaly) AS avg_anomaly, "
                "format('{:,}', total_malware) AS total_malware, "
                "format('{:,}', critical_count) AS critical_count, "
                "format('{:,}', distinct_networks) AS distinct_networks FROM kpis"
            ),
        ),
        "mart_attack_volume": _on_filtered(ctes, 
            "SELECT attack_type, total_incidents FROM ("
            "SELECT attack_type, CAST(SUM(total_incidents) AS BIGINT) AS total_incidents "
            "FROM filtered GROUP BY attack_type "
            "ORDER BY total_incidents DESC, attack_type DESC LIMIT 12) ORDER BY total_incidents, attack_type"
        ),
        "mart_severity_share": _on_filtered(ctes, 
            "SELECT severity_level, total_incidents, "
            "CAST(SUM(total_incidents) OVER () AS BIGINT) AS grand_total, "
            "CAST(100.0 AS DOUBLE) * total_incidents / CAST(SUM(total_incidents) OVER () AS BIGINT) AS share_pct "
            "FROM (SELECT severity_level, CAST(SUM(total_incidents) AS BIGINT) AS total_incidents "
            "FROM filtered GROUP BY severity_level)"
        ),
        "mart_attack_protocol": _on_filtered(ctes, 
            "SELECT attack_type, protocol, CAST(SUM(total_incidents) AS BIGINT) AS total_incidents "
            "FROM filtered GROUP BY attack_type, protocol"
        ),
        "mart_heatmap": _on_filtered(ctes,
            "SELECT attack_type, "
            + ", ".join(
                f"CAST(coalesce(sum(CASE WHEN protocol = '{p}' THEN total_incidents END), 0) AS BIGINT) AS \"{p}\""
                for p in HEATMAP_PROTOCOLS
            )
            + " FROM filtered GROUP BY attack_type"
        ),
        "mart_heatmap_cells": _on_filtered(ctes,
            "SELECT a.attack_type, p.protocol, CAST(coalesce(sum(f.total_incidents), 0) AS BIGINT) AS total_incidents "
            "FROM (SELECT DISTINCT attack_type FROM filtered) a CROSS JOIN (SELECT DISTINCT protocol FROM filtered) p "
            "LEFT JOIN filtered f ON f.attack_type = a.attack_type AND f.protocol = p.protocol GROUP BY 1, 2"
        ),
        "mart_anomaly": _on_filtered(ctes, 
            f"SELECT attack_type, {_avg('avg_anomaly_score')} AS avg_anomaly, "
            "MAX(max_anomaly_score) AS max_anomaly FROM filtered GROUP BY attack_type"
        ),
        "mart_severity_action": _on_filtered(ctes, 
            f"SELECT CASE WHEN {_sev_rank_sql('severity_level')} IS NOT NULL THEN severity_level END "
            "AS severity_level, action_taken, total_incidents, "
            f"{_sev_rank_sql('severity_level')} AS severity_rank FROM ("
            "SELECT severity_level, action_taken, CAST(SUM(total_incidents) AS BIGINT) AS total_incidents "
            "FROM filtered WHERE action_taken IS NOT NULL GROUP BY severity_level, action_taken)"
        ),
        "mart_malware_pct": _on_filtered(ctes, 
            f"SELECT attack_type, malware, total, {_MALWARE_PCT} AS pct, "
            f"printf('%.1f%%', {_MALWARE_PCT}) AS pct_label FROM ("
            "SELECT attack_type, CAST(SUM(malware_detected_count) AS BIGINT) AS malware, "
            "CAST(SUM(total_incidents) AS BIGINT) AS total FROM filtered GROUP BY attack_type)"
        ),
        "mart_top_incidents": _on_filtered(ctes, 
            f"SELECT {_TABLE_COLS} FROM filtered ORDER BY total_incidents DESC, "
            f"avg_anomaly_score DESC, {_TABLE_ORDER} LIMIT 50"
        ),
        "mart_top_incidents_labelled": _on_filtered(ctes,
            "SELECT attack_type AS \"Tipo de Ataque\", severity_level AS \"Severidade\", protocol AS \"Protocolo\", "
            "action_taken AS \"Ação Tomada\", network_segment AS \"Segmento de Rede\", total_incidents AS \"Total Incidentes\", "
            "avg_anomaly_score AS \"Score Médio\", malware_detected_count AS \"Malware Detectado\", malware_pct AS \"% Malware\", "
            "unique_source_networks AS \"Redes Origem\" FROM filtered ORDER BY total_incidents DESC, "
            f"avg_anomaly_score DESC, {_TABLE_ORDER} LIMIT 50"
        ),
    }


def oracle_sql() -> dict[str, str]:
    quoted = lambda names: ", ".join(f'"{c}"' for c in names)
    raw_cols = quoted(RAW_NAMES)
    kept = quoted(c for c in RAW_NAMES if c not in ("Payload Data", "User Information", "Proxy Information"))
    broken = ", ".join(
        f"concat(\"{c}\", chr(10), '\"end\"') AS \"{c}\"" if c in ("Payload Data", "Log Source") else f'"{c}"' for c in RAW_NAMES
    )
    return {
        "raw_log": over_raw(f"SELECT {raw_cols} FROM raw"),
        "bronze_roundtrip": over_raw(f"SELECT {raw_cols} FROM raw"),
        "bronze_linebreaks": over_raw(f"SELECT {broken} FROM raw"),
        "bronze_load_profile": (
            f"SELECT COUNT(*) FILTER (WHERE event_id % {MALFORMED_EVERY} <> 0) AS rows, "
            f"COUNT(*) FILTER (WHERE event_id % {MALFORMED_EVERY} = 0) AS rejected FROM events"
        ),
        "typed_columns": over_raw(f"SELECT {TYPED} FROM raw"),
        "masked_ips": over_raw(f"SELECT {MASKED} FROM raw"),
        "masked_ips_documents": (
            f"SELECT doc_id, {_network('text')} AS text_masked FROM documents"
        ),
        "normalised_text": over_raw(f"SELECT {NORMALISED} FROM raw"),
        "pii_dropped": over_raw(f"SELECT {kept} FROM raw"),
        "quality_filter": over_raw(f"SELECT {raw_cols} FROM raw WHERE {QUALITY_WHERE}"),
        "silver": over_silver("SELECT * FROM silver"),
        "streaming_silver": over_silver("SELECT * FROM silver"),
        "silver_count": over_silver("SELECT COUNT(*) AS rows FROM silver"),
        "silver_profile": over_silver(
            "SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE timestamp IS NULL) AS null_timestamp, "
            "COUNT(*) FILTER (WHERE source_port IS NULL) AS null_source_port, "
            "COUNT(*) FILTER (WHERE destination_port IS NULL) AS null_destination_port, "
            "COUNT(*) FILTER (WHERE anomaly_score IS NULL) AS null_anomaly_score FROM silver"
        ),
        "silver_top_attacks": over_silver(
            "SELECT attack_type, COUNT(*) AS total FROM silver GROUP BY attack_type "
            "ORDER BY total DESC, attack_type ASC NULLS LAST LIMIT 5"
        ),
        "malware_flag": over_base("SELECT * FROM base"),
        "gold_fact": over_gold(
            "SELECT * FROM gold ORDER BY total_incidents DESC, avg_anomaly_score DESC"
        ),
        "pipeline_gold": over_gold("SELECT * FROM gold"),
        "gold_volume": _gold_measures("total_incidents"),
        "gold_anomaly": _gold_measures("avg_anomaly_score", "max_anomaly_score"),
        "gold_packets": _gold_measures("avg_packet_length", "max_packet_length"),
        "gold_malware": _gold_measures("malware_detected_count", "malware_pct"),
        "gold_networks": _gold_measures("unique_source_networks", "unique_dest_networks"),
        "gold_time_span": _gold_measures("first_seen", "last_seen", "duration_hours"),
        "gold_summary": over_gold(
            "SELECT COUNT(*) AS total_rows, CAST(SUM(total_incidents) AS BIGINT) AS total_incidents, "
            "COUNT(DISTINCT attack_type) AS distinct_attack_types, "
            "COUNT(DISTINCT protocol) AS distinct_protocols, "
            f"ROUND({_avg('avg_anomaly_score')}, 3) AS overall_avg_anomaly FROM gold"
        ),
        **mart_sql(),
    }
