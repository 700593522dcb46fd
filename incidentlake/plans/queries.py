"""Registered queries: one per operator group, each over the driver's tables.

Every query starts from ``events`` (the raw attack log is derived from it
row by row) or ``documents``, so its work grows with the input. Queries that
exercise file I/O write into the shared scratch folder named by
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentlake.config import LayerConfig, scratch_root
from incidentlake.functions import mask_ipv4
from incidentlake.operators import marts
from incidentlake.operators.bronze import accepted, land, load_profile
from incidentlake.operators.gold import aggregate_incidents, incident_base, to_gold
from incidentlake.operators.quality import gold_summary, layer_count, silver_profile, top_attacks
from incidentlake.operators.silver import (
    drop_columns,
    masked_ips,
    normalised_text,
    quality_filter,
    to_silver,
    typed_columns,
)
from incidentlake.plans.oracle import GOLD_FILTER_SUBSET, MALFORMED_EVERY
from incidentlake.plans.pipeline import run_pipeline
from incidentlake.schemas import GOLD_CREATED_AT, INGESTED_AT, PROCESSED_AT, RAW_COLUMNS
from incidentlake.sinks import write_csv, write_layer
from incidentlake.sources import RAW_LOG_EXPRESSIONS, raw_log, read_events, read_layer, read_raw_csv

Query = Callable[[SparkSession, str], DataFrame]


def _scratch(spark: SparkSession, what: str) -> str:
    return f"{scratch_root(spark)}/{what}-{uuid.uuid4().hex}"


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(raw_log(spark, sf_dir), stamps=False)


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_gold(_silver(spark, sf_dir), stamp=False, sort=False)


def _filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.filter_gold(_gold(spark, sf_dir))


def _raw_as_csv(spark: SparkSession, sf_dir: str) -> str:
    path = _scratch(spark, "raw-csv")
    write_csv(raw_log(spark, sf_dir), path)
    return path


def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log -> CSV files -> CSV reader: every line back, value for value."""
    return accepted(read_raw_csv(spark, _raw_as_csv(spark, sf_dir))).select(
        *(f"`{c}`" for c in RAW_COLUMNS)
    )


def bronze_linebreaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log with a quoted line break (and quotes) in a middle and in the
    last column of every row -> CSV files -> reader; only accepted rows."""
    path = _scratch(spark, "raw-breaks")
    broken = lambda c: F.concat(F.coalesce(F.col(f"`{c}`"), F.lit("")), F.lit('\n"end"')).alias(c)
    log = raw_log(spark, sf_dir)
    write_csv(log.select(*(broken(c) if c in ("Payload Data", "Log Source") else F.col(f"`{c}`") for c in RAW_COLUMNS)), path)
    return accepted(read_raw_csv(spark, path)).select(*(f"`{c}`" for c in RAW_COLUMNS))


def _csv_field(c: Column) -> Column:
    quoted = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(c.isNull(), F.lit("")).otherwise(quoted)


def _raw_lines_with_malformed(spark: SparkSession, sf_dir: str) -> str:
    """Write the raw log as CSV lines built column by column (RFC 4180 quoting),
    every ``MALFORMED_EVERY``-th event with one field too many."""
    events = read_events(spark, sf_dir)
    line = F.concat_ws(",", *(_csv_field(F.col(f"`{c}`")) for c in RAW_COLUMNS))
    bad = (F.col("event_id") % F.lit(MALFORMED_EVERY)) == F.lit(0)
    header = ",".join(RAW_COLUMNS)  # written as the single column's name
    path = _scratch(spark, "raw-lines")
    (
        events.selectExpr("event_id", *(f"{RAW_LOG_EXPRESSIONS[c]} AS `{c}`" for c in RAW_COLUMNS))
        .select(F.when(bad, F.concat(line, F.lit(",extra"))).otherwise(line).alias(header))
        .write.mode("overwrite")
        .option("header", True)
        .option("sep", "\u0001")  # never in the data: lines are written verbatim
        .option("quote", "")
        .option("escape", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def bronze_load_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with some malformed lines -> stored Bronze, then the accepted and
    rejected line counts of the stored table."""
    bronze = _scratch(spark, "bronze")
    write_layer(land(read_raw_csv(spark, _raw_lines_with_malformed(spark, sf_dir))), bronze,
                rows_per_group=100_000)
    return load_profile(read_layer(spark, bronze))


def pipeline_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full stored pipeline (CSV -> Bronze -> Silver -> Gold), Gold read back."""
    cfg = LayerConfig.under(_scratch(spark, "pipeline"), _raw_as_csv(spark, sf_dir))
    run_pipeline(spark, cfg)
    return read_layer(spark, cfg.gold).drop(GOLD_CREATED_AT)


def _gold_measures(*names: str) -> Query:
    return lambda spark, sf: aggregate_incidents(incident_base(_silver(spark, sf)), names)


def _documents_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return docs.select("doc_id", mask_ipv4("text").alias("text_masked"))


def _kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.kpis(_filtered(spark, sf_dir))


def queries() -> dict[str, Query]:
    sub = GOLD_FILTER_SUBSET
    return {
        "raw_log": raw_log,
        "bronze_roundtrip": bronze_roundtrip,
        "bronze_linebreaks": bronze_linebreaks,
        "bronze_load_profile": bronze_load_profile,
        "typed_columns": lambda s, d: typed_columns(raw_log(s, d)),
        "masked_ips": lambda s, d: masked_ips(raw_log(s, d)),
        "masked_ips_documents": _documents_masked,
        "normalised_text": lambda s, d: normalised_text(raw_log(s, d)),
        "pii_dropped": lambda s, d: drop_columns(raw_log(s, d)),
        "quality_filter": lambda s, d: quality_filter(raw_log(s, d)),
        "silver": _silver,
        "streaming_silver": streaming_silver,
        "silver_count": lambda s, d: layer_count(_silver(s, d)),
        "silver_profile": lambda s, d: silver_profile(_silver(s, d)),
        "silver_top_attacks": lambda s, d: top_attacks(_silver(s, d), 5),
        "malware_flag": lambda s, d: incident_base(_silver(s, d)),
        "gold_fact": lambda s, d: to_gold(_silver(s, d), stamp=False),
        "pipeline_gold": pipeline_gold,
        "gold_volume": _gold_measures("total_incidents"),
        "gold_anomaly": _gold_measures("avg_anomaly_score", "max_anomaly_score"),
        "gold_packets": _gold_measures("avg_packet_length", "max_packet_length"),
        "gold_malware": _gold_measures("malware_detected_count", "malware_pct"),
        "gold_networks": _gold_measures("unique_source_networks", "unique_dest_networks"),
        "gold_time_span": _gold_measures("first_seen", "last_seen", "duration_hours"),
        "gold_summary": lambda s, d: gold_summary(_gold(s, d)),
        "opt_severity": lambda s, d: marts.dimension_options(_gold(s, d), "severity_level"),
        "opt_attack": lambda s, d: marts.dimension_options(_gold(s, d), "attack_type"),
        "opt_protocol": lambda s, d: marts.dimension_options(_gold(s, d), "protocol"),
        "opt_all": lambda s, d: marts.all_dimension_options(_gold(s, d)),
        "gold_filtered": lambda s, d: marts.filter_gold(
            _gold(s, d), sub["severities"], sub["attacks"], sub["protocols"]
        ),
        "kpis": _kpis,
        "kpis_formatted": lambda s, d: marts.kpis_formatted(_kpis(s, d)),
        "mart_attack_volume": lambda s, d: marts.attack_volume(_filtered(s, d), 12),
        "mart_severity_share": lambda s, d: marts.severity_share(_filtered(s, d)),
        "mart_attack_protocol": lambda s, d: marts.attack_protocol(_filtered(s, d)),
        "mart_heatmap": lambda s, d: marts.heatmap(_filtered(s, d)),
        "mart_heatmap_cells": lambda s, d: marts.heatmap_cells(_filtered(s, d)),
        "mart_anomaly": lambda s, d: marts.anomaly_by_attack(_filtered(s, d)),
        "mart_severity_action": lambda s, d: marts.severity_action(_filtered(s, d)),
        "mart_malware_pct": lambda s, d: marts.malware_by_attack(_filtered(s, d)),
        "mart_top_incidents": lambda s, d: marts.top_incidents(_filtered(s, d), 50),
        "mart_top_incidents_labelled": lambda s, d: marts.top_incidents(_filtered(s, d), 50, marts.DISPLAY_LABELS),
    }


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Gold fact table computed from the raw log, sorted."""
    return to_gold(_silver(spark, sf_dir), stamp=False)


def streaming_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV files landed incrementally (Structured Streaming, available-now
    trigger) through Bronze into Silver; the stored Silver read back."""
    from incidentlake.streaming import stream_bronze, stream_silver

    root = _scratch(spark, "stream")
    source = _raw_as_csv(spark, sf_dir)
    stream_bronze(spark, source, f"{root}/bronze", f"{root}/ckpt/bronze").awaitTermination()
    stream_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/ckpt/silver").awaitTermination()
    return read_layer(spark, f"{root}/silver").drop(INGESTED_AT, PROCESSED_AT)
