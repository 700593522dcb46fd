"""Incremental landing of new raw log files with Structured Streaming.

The same Bronze and Silver transforms as the batch jobs, run as streaming
queries over a directory of arriving CSV files: each file is landed once
(progress is kept in the checkpoint), so executor loss or a restart resumes
where it stopped and never lands a file twice. With ``available_now`` the
query drains what is there and stops -- a cheap scheduled incremental run.
Gold needs exact distinct counts, which streaming aggregation does not
support, so it follows in batch: the new Silver rows are folded into a stored
state (``plans.incremental``), and Silver is not read again.

A streaming sink keeps a log of its files, and readers then see only those. So
a stream refuses a target that a batch job wrote: land increments in layers of
their own, or run the batch jobs again over all files, which replace the target.
"""

from __future__ import annotations

import time

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from incidentlake.config import LayerConfig
from incidentlake.layers import is_versioned
from incidentlake.operators.bronze import accepted, land
from incidentlake.operators.quality import gold_summary
from incidentlake.operators.silver import to_silver
from incidentlake.plans.incremental import follow_silver, refresh_gold
from incidentlake.plans.pipeline import LayerReport, run_gold
from incidentlake.schemas import CORRUPT_RECORD, INGESTED_AT, RAW_COLUMNS
from incidentlake.sources import header_columns, path_exists, read_layer
from incidentlake.sources.csv import csv_options, raw_read_schema


def bronze_stream_schema() -> T.StructType:
    return raw_read_schema().add(T.StructField(INGESTED_AT, T.TimestampType(), True))


def _refuse_batch_target(spark: SparkSession, path: str) -> None:
    streamed = path_exists(spark, f"{path.rstrip('/')}/_spark_metadata") and not is_versioned(spark, path)
    if path_exists(spark, path) and not streamed:
        raise ValueError(f"{path} was written by a batch job; a stream into it would hide its rows")


def _start(df, path: str, checkpoint: str, available_now: bool):
    _refuse_batch_target(df.sparkSession, path)
    w = df.writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", checkpoint
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def stream_bronze(
    spark: SparkSession,
    source_dir: str,
    bronze_path: str,
    checkpoint: str,
    *,
    multiline: bool = True,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """New CSV files in ``source_dir`` -> Bronze Parquet (rejects flagged). The
    column order comes from a file's header; all files must have the same."""
    names = header_columns(spark, source_dir, multiline)
    missing = [c for c in RAW_COLUMNS if c not in names]
    if missing:
        raise ValueError(f"CSV header lacks columns: {missing}")
    reader = spark.readStream.options(**csv_options(multiline)).schema(raw_read_schema(names))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(source_dir).select(*(f"`{c}`" for c in RAW_COLUMNS), CORRUPT_RECORD)
    return _start(land(raw), bronze_path, checkpoint, available_now)


def stream_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    checkpoint: str,
    *,
    available_now: bool = True,
) -> StreamingQuery:
    """New Bronze files -> Silver Parquet (map-only, stateless)."""
    bronze = spark.readStream.schema(bronze_stream_schema()).parquet(bronze_path)
    return _start(to_silver(accepted(bronze)), silver_path, checkpoint, available_now)


def ingest_available(
    spark: SparkSession, cfg: LayerConfig, source_dir: str, checkpoint_root: str
) -> LayerReport:
    """Land every new file through Bronze and Silver, then fold the new Silver
    rows into Gold's state and finish Gold from it."""
    t0 = time.perf_counter()
    root = checkpoint_root.rstrip("/")
    q = stream_bronze(spark, source_dir, cfg.bronze, f"{root}/bronze",
                      multiline=cfg.multiline_csv)
    q.awaitTermination()
    q = stream_silver(spark, cfg.bronze, cfg.silver, f"{root}/silver")
    q.awaitTermination()
    if follow_silver(spark, cfg) is None:
        return run_gold(spark, cfg)
    refresh_gold(spark, cfg)
    summary = gold_summary(read_layer(spark, cfg.gold)).first().asDict()
    return LayerReport("gold", cfg.gold, int(summary.pop("total_rows")), time.perf_counter() - t0, summary)
