"""Reporting marts over the Gold fact table: dimension filters, key figures,
ranked and shared breakdowns, a pivoted heatmap and a top-incidents table.

Gold has one row per dimension combination, so its size is bounded by the
product of dimension cardinalities, not by the log volume. The marts still run
as Spark jobs (partial + final aggregation); only the finished, small results
are meant to be collected.

NULL handling follows the dashboard: the three filter dimensions drop NULLs
(membership tests never match NULL), and breakdowns drop rows whose grouping
key is NULL. Gold itself keeps NULL groups.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentlake.functions import (
    format_fixed,
    half_even_round,
    mean_by,
    percent_label,
    thousands,
)
from incidentlake.schemas import CRITICAL, GOLD_DIMS, SEVERITY_ORDER

# The filter dimensions and the columns of the incident table.
FILTER_DIMS: tuple[str, ...] = ("severity_level", "attack_type", "protocol")

TABLE_COLUMNS: tuple[str, ...] = (
    "attack_type",
    "severity_level",
    "protocol",
    "action_taken",
    "network_segment",
    "total_incidents",
    "avg_anomaly_score",
    "malware_detected_count",
    "malware_pct",
    "unique_source_networks",
)

# Protocols that the heatmap takes as columns at most.
HEATMAP_COLUMNS = 200

# The incident table's headings, by column.
DISPLAY_LABELS: dict[str, str] = {
    "attack_type": "Tipo de Ataque",
    "severity_level": "Severidade",
    "protocol": "Protocolo",
    "action_taken": "Ação Tomada",
    "network_segment": "Segmento de Rede",
    "total_incidents": "Total Incidentes",
    "avg_anomaly_score": "Score Médio",
    "malware_detected_count": "Malware Detectado",
    "malware_pct": "% Malware",
    "unique_source_networks": "Redes Origem",
}


# --------------------------------------------------------------------------- filters


def dimension_options(gold: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-NULL values of a dimension (the filter choices)."""
    return (
        gold.where(F.col(column).isNotNull())
        .select(column)
        .distinct()
        .orderBy(F.asc(column))
    )


def all_dimension_options(gold: DataFrame, dims: Sequence[str] = FILTER_DIMS) -> DataFrame:
    """Filter choices of several dimensions in one query: sorted distinct
    non-NULL ``(dimension, value)`` pairs."""
    pairs = F.explode(
        F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in dims))
    ).alias("pair")
    return (
        gold.select(pairs)
        .select("pair.dimension", "pair.value")
        .where(F.col("value").isNotNull())
        .distinct()
        .orderBy("dimension", "value")
    )


def _member(column: str, allowed: Sequence[str] | None) -> Column:
    c = F.col(column)
    if allowed is None:  # every option selected: all non-NULL values
        return c.isNotNull()
    if len(allowed) == 0:
        return F.lit(False)
    return c.isin(*allowed)


def filter_gold(
    gold: DataFrame,
    severities: Sequence[str] | None = None,
    attacks: Sequence[str] | None = None,
    protocols: Sequence[str] | None = None,
) -> DataFrame:
    """severity in S AND attack in A AND protocol in P. ``None`` selects every
    option; NULL never matches. Pushed into the Gold scan as ``In`` filters."""
    return gold.where(
        _member("severity_level", severities)
        & _member("attack_type", attacks)
        & _member("protocol", protocols)
    )


def is_empty(df: DataFrame) -> bool:
    """Empty-result guard (reads at most one row)."""
    return df.isEmpty()


# --------------------------------------------------------------------------- key figures


def kpis(filtered: DataFrame) -> DataFrame:
    """One row of key figures.

    ``avg_anomaly`` is the unweighted mean of group means and
    ``distinct_networks`` sums per-group distinct counts (a network seen in two
    groups counts twice) -- both as the dashboard defines them.
    """
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    critical = F.when(F.col("severity_level") == F.lit(CRITICAL), F.col("total_incidents"))
    mean = mean_by(filtered, [], "avg_anomaly_score", "avg_anomaly", {}, {}).scalar()
    sums = filtered.agg(
        total("total_incidents").alias("total_incidents"),
        F.count_distinct("attack_type").alias("distinct_attacks"),
        total("malware_detected_count").alias("total_malware"),
        total(critical).alias("critical_count"),
        total("unique_source_networks").alias("distinct_networks"),
    )
    return sums.select("total_incidents", "distinct_attacks", mean.alias("avg_anomaly"), "total_malware", "critical_count", "distinct_networks")


def kpis_formatted(kpi_row: DataFrame) -> DataFrame:
    """Key figures as display text: thousands separators, two decimals."""
    return kpi_row.select(
        thousands("total_incidents").alias("total_incidents"),
        F.col("distinct_attacks").cast("string").alias("distinct_attacks"),
        format_fixed("avg_anomaly", 2).alias("avg_anomaly"),
        thousands("total_malware").alias("total_malware"),
        thousands("critical_count").alias("critical_count"),
        thousands("distinct_networks").alias("distinct_networks"),
    )


# --------------------------------------------------------------------------- breakdowns


def _sum_by(filtered: DataFrame, keys: Sequence[str], measure: str = "total_incidents") -> DataFrame:
    df = filtered
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df.groupBy(*keys).agg(F.sum(measure).cast("bigint").alias(measure))


def attack_volume(filtered: DataFrame, top: int = 12) -> DataFrame:
    """Incidents per attack type, the ``top`` largest, listed ascending."""
    ranked = (
        _sum_by(filtered, ["attack_type"])
        .orderBy(F.desc("total_incidents"), F.desc("attack_type"))
        .limit(top)
    )
    return ranked.orderBy(F.asc("total_incidents"), F.asc("attack_type"))


def severity_share(filtered: DataFrame) -> DataFrame:
    """Incidents per severity, the grand total and each severity's percent
    share, largest first.

    The grand total is a scalar subquery (a global partial aggregate, one row
    per task), so no step gathers the per-severity rows into one partition.
    """
    per = _sum_by(filtered, ["severity_level"])
    total = per.agg(F.sum("total_incidents").cast("bigint")).scalar()
    return per.select(
        "severity_level",
        "total_incidents",
        total.alias("grand_total"),
        (F.lit(100.0) * F.col("total_incidents") / total).alias("share_pct"),
    ).orderBy(F.desc("total_incidents"), F.asc("severity_level"))


def attack_protocol(filtered: DataFrame) -> DataFrame:
    """Incidents per attack type x protocol."""
    return _sum_by(filtered, ["attack_type", "protocol"]).orderBy("attack_type", "protocol")


def _cells(filtered: DataFrame) -> DataFrame:
    return filtered.where(F.col("attack_type").isNotNull() & F.col("protocol").isNotNull())


def heatmap(filtered: DataFrame, protocols: Sequence[str] | None = None, max_columns: int = HEATMAP_COLUMNS) -> DataFrame:
    """Attack types as rows, protocols as columns, incidents in the cells
    (missing combinations are 0).

    Without a list the protocols are those of the data, in order: a first, small
    job lists them (two phases, as a plan has to know its columns). A table with
    more than ``max_columns`` of them is better read by cells, and raises.
    """
    cells = _cells(filtered)
    if protocols is None:
        found = cells.select("protocol").distinct().orderBy("protocol").limit(max_columns + 1).collect()
        if len(found) > max_columns:
            raise ValueError(f"more than {max_columns} protocols; use heatmap_cells, a row for every cell")
        protocols = [r["protocol"] for r in found]
    if not protocols:
        return cells.select("attack_type").distinct().orderBy("attack_type")
    pivoted = cells.groupBy("attack_type").pivot("protocol", list(protocols)).agg(
        F.sum("total_incidents").cast("bigint")
    )
    filled = [F.coalesce(F.col(f"`{p}`"), F.lit(0)).alias(p) for p in (p.replace("`", "``") for p in protocols)]
    return pivoted.select("attack_type", *filled).orderBy("attack_type")


def heatmap_cells(filtered: DataFrame) -> DataFrame:
    """The heatmap with one row per cell, zero-filled: every attack type with
    every protocol present. No column per protocol, so no limit to their number."""
    found = _sum_by(filtered, ["attack_type", "protocol"])
    protocols = found.agg(F.collect_set("protocol")).scalar()
    grid = found.select("attack_type").distinct().select("attack_type", F.explode(protocols).alias("protocol"))
    return (
        grid.join(found, ["attack_type", "protocol"], "left")
        .select("attack_type", "protocol", F.coalesce("total_incidents", F.lit(0)).alias("total_incidents"))
        .orderBy("attack_type", "protocol")
    )


def anomaly_by_attack(filtered: DataFrame) -> DataFrame:
    """Mean of group mean scores and the maximum score per attack type,
    highest mean first."""
    means = mean_by(
        filtered.where(F.col("attack_type").isNotNull()), ["attack_type"], "avg_anomaly_score", "avg_anomaly",
        first={"max_anomaly": F.max("max_anomaly_score")}, second={"max_anomaly": F.max("max_anomaly")},
    )
    return means.select("attack_type", "avg_anomaly", "max_anomaly").orderBy(F.desc_nulls_last("avg_anomaly"), F.asc("attack_type"))


def severity_rank(c: Column | str = "severity_level") -> Column:
    """1 for LOW .. 4 for CRITICAL, NULL for anything else."""
    col = F.col(c) if isinstance(c, str) else c
    expr = None
    for i, level in enumerate(SEVERITY_ORDER, start=1):
        expr = (F.when if expr is None else expr.when)(col == F.lit(level), F.lit(i))
    return expr


def severity_action(filtered: DataFrame) -> DataFrame:
    """Incidents per severity x action in severity order. Severity values
    outside the known levels are shown as NULL and sorted last."""
    per = _sum_by(filtered, ["severity_level", "action_taken"])
    rank = severity_rank("severity_level")
    return per.select(
        F.when(rank.isNotNull(), F.col("severity_level")).alias("severity_level"),
        "action_taken",
        "total_incidents",
        rank.alias("severity_rank"),
    ).orderBy(F.asc_nulls_last("severity_rank"), F.asc("action_taken"))


def malware_by_attack(filtered: DataFrame) -> DataFrame:
    """Malware detections and incidents per attack type, the re-derived
    percentage (rounded half to even, two decimals) and its label, lowest
    percentage first."""
    per = (
        filtered.where(F.col("attack_type").isNotNull())
        .groupBy("attack_type")
        .agg(
            F.sum("malware_detected_count").cast("bigint").alias("malware"),
            F.sum("total_incidents").cast("bigint").alias("total"),
        )
    )
    pct = half_even_round(F.lit(100) * F.col("malware") / F.col("total"), 2)
    return (
        per.withColumn("pct", pct)
        .withColumn("pct_label", percent_label("pct", 1))
        .orderBy(F.asc_nulls_last("pct"), F.asc("attack_type"))
    )


def top_incidents(
    filtered: DataFrame, n: int = 50, labels: Mapping[str, str] | None = None
) -> DataFrame:
    """The ``n`` Gold rows with most incidents (then highest mean score), with
    the table columns; ``labels`` renames them for display."""
    out = (
        filtered.select(*TABLE_COLUMNS)
        .orderBy(
            F.desc_nulls_last("total_incidents"),
            F.desc_nulls_last("avg_anomaly_score"),
            *(F.asc_nulls_last(d) for d in GOLD_DIMS),
        )
        .limit(n)
    )
    return out.withColumnsRenamed(dict(labels)) if labels else out
