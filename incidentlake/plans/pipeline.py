"""Layer jobs: CSV -> Bronze -> Silver -> Gold, each stored as Parquet.

Layers are coupled only through their stored output, so any layer can be
re-run alone; a write is a version of its own, which a small commit makes
current when it is complete (``incidentlake.layers``), so re-runs are idempotent
and a failed or killed one leaves the old layer. Each job returns a
``LayerReport`` whose counts come from the footers of what is stored. Writing each
layer also cuts lineage: a lost executor never forces a recomputation further
back than the previous stored layer.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from incidentlake.config import LayerConfig
from incidentlake.layers import commit_layer
from incidentlake.operators.bronze import land, no_cut_values
from incidentlake.operators.gold import to_gold
from incidentlake.operators.quality import PROFILED, gold_summary, top_attacks
from incidentlake.operators.silver import to_silver
from incidentlake.schemas import CORRUPT_RECORD
from incidentlake.sources import first_existing, read_bronze, read_layer, read_raw_csv

log = logging.getLogger(__name__)

LAYERS: tuple[str, ...] = ("bronze", "silver", "gold")


def _layout(cfg: LayerConfig, layer: str) -> dict:
    """How a layer's rows are laid out in files."""
    return {
        "partition_by": cfg.partition_by.get(layer, ()),
        "cluster_by": cfg.cluster_by.get(layer, ()),
        "bloom_columns": cfg.bloom_columns.get(layer, ()),
    }


@dataclass(frozen=True)
class LayerReport:
    layer: str
    target: str
    rows: int
    seconds: float
    details: dict = field(default_factory=dict)


def run_bronze(spark: SparkSession, cfg: LayerConfig) -> LayerReport:
    """Land the raw CSV as Parquet (text columns + ``_ingested_at``).

    Column names and order come from the file header (as a header-driven CSV
    reader would take them); every expected column must be present and every
    file's header must agree. Malformed lines are stored too, flagged by
    ``_corrupt_record``, so the rejects stay inspectable. The accepted and
    rejected counts come from the footers of the stored table.
    """
    t0 = time.perf_counter()
    source = first_existing(spark, cfg.raw_csv)
    raw = read_raw_csv(
        spark, source, multiline=cfg.multiline_csv, from_header=cfg.columns_from_header
    )
    stored = commit_layer(
        land(raw),
        cfg.bronze,
        rows_per_group=cfg.row_group_rows,
        **_layout(cfg, "bronze"),
        counted=[CORRUPT_RECORD],
        check=None if cfg.multiline_csv else (lambda rows, _: no_cut_values(rows)),
    )
    rejected = stored.not_null[CORRUPT_RECORD]
    report = LayerReport(
        "bronze", cfg.bronze, stored.rows - rejected, time.perf_counter() - t0,
        {"source": source, "rejected": rejected},
    )
    log.info("bronze: %s rows (%s rejected) in %.2fs", f"{report.rows:,}",
             report.details["rejected"], report.seconds)
    return report


def run_silver(spark: SparkSession, cfg: LayerConfig, top_k: int = 5) -> LayerReport:
    """Bronze -> Silver. The row profile comes from the footers of what is
    stored; the top attacks read one column of it."""
    t0 = time.perf_counter()
    stored = commit_layer(
        to_silver(read_bronze(spark, cfg.bronze)),
        cfg.silver,
        rows_per_group=cfg.row_group_rows,
        **_layout(cfg, "silver"),
        counted=PROFILED,
    )
    prof = {f"null_{c}": stored.rows - n for c, n in stored.not_null.items()}
    top = [(r["attack_type"], int(r["total"])) for r in top_attacks(read_layer(spark, cfg.silver), top_k).collect()]
    rows = stored.rows
    report = LayerReport("silver", cfg.silver, rows, time.perf_counter() - t0,
                         {**prof, "top_attacks": top})
    log.info("silver: %s rows in %.2fs; top attacks %s", f"{rows:,}", report.seconds, top)
    return report


def run_gold(spark: SparkSession, cfg: LayerConfig) -> LayerReport:
    """Silver -> Gold fact table, then summarise the stored table."""
    t0 = time.perf_counter()
    commit_layer(to_gold(read_layer(spark, cfg.silver)), cfg.gold,
                 **_layout(cfg, "gold"))
    summary = gold_summary(read_layer(spark, cfg.gold)).first().asDict()
    rows = int(summary.pop("total_rows"))
    report = LayerReport("gold", cfg.gold, rows, time.perf_counter() - t0, summary)
    log.info("gold: %s rows in %.2fs; %s", f"{rows:,}", report.seconds, summary)
    return report


_RUNNERS = {"bronze": run_bronze, "silver": run_silver, "gold": run_gold}


def run_pipeline(
    spark: SparkSession, cfg: LayerConfig, layers: Sequence[str] = LAYERS
) -> list[LayerReport]:
    """Run the chosen layers in pipeline order (``"all"`` = every layer)."""
    wanted = set(LAYERS if "all" in layers else layers)
    unknown = wanted - set(LAYERS)
    if unknown:
        raise ValueError(f"unknown layers: {sorted(unknown)}")
    return [_RUNNERS[name](spark, cfg) for name in LAYERS if name in wanted]


REPORT_SCHEMA = T.StructType(
    [
        T.StructField("layer", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("details", T.StringType()),
    ]
)


def reports_frame(spark: SparkSession, reports: Sequence[LayerReport]) -> DataFrame:
    """Layer reports as a small DataFrame (one row per layer run)."""
    rows = []
    for r in reports:
        d = asdict(r)
        rows.append((d["layer"], d["target"], d["rows"], d["seconds"], repr(d["details"])))
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def main(argv: Sequence[str] | None = None) -> int:
    """Command line: ``python -m incidentlake.plans.pipeline --layer all``."""
    import argparse

    from incidentlake.config import object_store_conf

    parser = argparse.ArgumentParser(description="Bronze -> Silver -> Gold")
    parser.add_argument("--layer", choices=[*LAYERS, "all"], default="all")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(name)s: %(message)s")
    builder = SparkSession.builder.appName("incidentlake-pipeline").config(
        "spark.ui.enabled", "false"
    )
    for k, v in object_store_conf().items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    t0 = time.perf_counter()
    run_pipeline(spark, LayerConfig.from_env(), [args.layer])
    log.info("pipeline finished in %.2fs", time.perf_counter() - t0)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
