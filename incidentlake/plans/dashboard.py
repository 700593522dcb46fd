"""Read side: filter Gold once and derive every report dataset from it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from incidentlake.operators import marts


@dataclass(frozen=True)
class Selection:
    """Chosen filter values; ``None`` means every option of that dimension."""

    severities: Sequence[str] | None = None
    attacks: Sequence[str] | None = None
    protocols: Sequence[str] | None = None


def filter_options(gold: DataFrame) -> DataFrame:
    """Sorted choices of every filter dimension in one query, as
    ``(dimension, value)`` rows; ``marts.dimension_options`` gives one list."""
    return marts.all_dimension_options(gold, marts.FILTER_DIMS)


def build_marts(
    gold: DataFrame,
    selection: Selection | None = None,
    *,
    top_attacks: int = 12,
    top_rows: int = 50,
    cache: bool = True,
) -> dict[str, DataFrame]:
    """Every report dataset over the filtered Gold table.

    The filtered frame is cached once and shared: Gold is bounded by the
    product of the dimension cardinalities, so it is small regardless of how
    many log lines produced it. An empty
    selection gives the filtered frame alone. The one-row key figures are cached too, so the
    formatted figures do not recompute them. ``release`` drops both.
    """
    sel = selection or Selection()
    filtered = marts.filter_gold(gold, sel.severities, sel.attacks, sel.protocols)
    if cache:
        filtered = filtered.cache()
    if marts.is_empty(filtered):  # nothing to show: no report is built
        return {"filtered": filtered}
    kpi = marts.kpis(filtered)
    if cache:
        kpi = kpi.cache()  # one row, shared with its formatted form
    return {
        "filtered": filtered,
        "kpis": kpi,
        "kpis_formatted": marts.kpis_formatted(kpi),
        "attack_volume": marts.attack_volume(filtered, top_attacks),
        "severity_share": marts.severity_share(filtered),
        "attack_protocol": marts.attack_protocol(filtered),
        "heatmap": marts.heatmap_cells(filtered),
        "anomaly_by_attack": marts.anomaly_by_attack(filtered),
        "severity_action": marts.severity_action(filtered),
        "malware_by_attack": marts.malware_by_attack(filtered),
        "top_incidents": marts.top_incidents(filtered, top_rows, marts.DISPLAY_LABELS),
    }


def release(bundle: dict[str, DataFrame]) -> None:
    """Drop the cached frames of a ``build_marts`` bundle."""
    for df in bundle.values():
        if df.is_cached:
            df.unpersist()
