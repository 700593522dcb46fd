"""Gold: the incident fact table, one row per attack type x severity x
protocol x action x network segment (NULL is a group of its own).

Plan (see README for measurements): one scan, two hash exchanges and a third of
a few rows a group, no join.

* Each row becomes one row with measures and one for either network
  (``_kind`` 0, 1, 2). They are aggregated together by group, kind, network and
  window of the score (``functions.exact``): map-side first, so a hot group is one
  row per task, window and network, and a hot group's networks spread over many
  tasks.
* What is left is one row per group and distinct network, and a few rows of
  partial measures per group. A second aggregation, by group and window, counts
  the former and merges the latter; a third joins a group's windows.

The rows between the two steps are mergeable: partial measures and distinct
networks of an increment and of all that came before add up to those of the
whole. ``gold_state`` gives them, ``merge_states`` folds two into one, and
``gold_from_state`` finishes; so Gold can follow Silver without reading it again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentlake.functions import hour_boundaries, safe_ratio, sql_round
from incidentlake.functions.exact import (
    NOT_FINITE,
    PARTIAL_SUMS,
    VALUES,
    WINDOW,
    mean_of,
    merged_windows,
    partial_inputs,
    window_column,
    with_digits,
)
from incidentlake.schemas import (
    GOLD_CREATED_AT,
    GOLD_DIMS,
    GOLD_MEASURES,
    MALWARE_POSITIVE,
)

# Silver columns Gold needs (Catalyst prunes the Silver scan to exactly these).
BASE_COLUMNS: tuple[str, ...] = GOLD_DIMS + (
    "anomaly_score",
    "packet_length",
    "timestamp",
    "source_ip_masked",
    "destination_ip_masked",
)


def malware_flag(c: Column | str = "malware_indicators") -> Column:
    """1 when the indicator reports IoC or malware, else 0 (NULL -> 0)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col.isin(*MALWARE_POSITIVE), F.lit(1)).otherwise(F.lit(0))


def incident_base(silver: DataFrame) -> DataFrame:
    """Narrow projection Gold aggregates over, with the ``has_malware`` flag."""
    return silver.where(F.col("attack_type").isNotNull()).select(
        *BASE_COLUMNS, malware_flag().alias("has_malware")
    )


# 0 for rows with measures; the others number the counted column, whose value
# is beside it.
_KIND, _VALUE = "_kind", "_value"


@dataclass(frozen=True)
class Partial:
    """A measure's partial: what is aggregated first, and how partials merge."""

    column: str
    first: Callable[[Column], Column]
    merge: Callable[[Column], Column]


PARTIALS: dict[str, Partial] = {
    "incidents": Partial("has_malware", F.count, F.sum),  # has_malware is never NULL
    "malware": Partial("has_malware", F.sum, F.sum),
    "max_score": Partial("anomaly_score", F.max, F.max),
    "packets": Partial("packet_length", F.count, F.sum),
    "packet_sum": Partial("packet_length", lambda c: F.sum(c.cast("bigint")), F.sum),
    "max_packet": Partial("packet_length", F.max, F.max),
    "first": Partial("timestamp", F.min, F.min),
    "last": Partial("timestamp", F.max, F.max),
}

# Measures: the partials that they need, and the value from the merged ones.
MEASURES: dict[str, tuple[tuple[str, ...], Callable[[], Column]]] = {
    "total_incidents": (("incidents",), lambda: F.col("incidents")),
    "avg_anomaly_score": (PARTIAL_SUMS, lambda: sql_round(mean_of("windows", VALUES, NOT_FINITE), 4)),
    "max_anomaly_score": (("max_score",), lambda: sql_round("max_score", 4)),
    "avg_packet_length": (
        ("packets", "packet_sum"),
        lambda: sql_round(safe_ratio(F.col("packet_sum").cast("double"), F.col("packets")), 2),
    ),
    "max_packet_length": (("max_packet",), lambda: F.col("max_packet")),
    "malware_detected_count": (("malware",), lambda: F.col("malware")),
    "malware_pct": (
        ("malware", "incidents"),
        lambda: sql_round(safe_ratio(F.lit(100.0) * F.col("malware"), F.col("incidents")), 2),
    ),
    "first_seen": (("first",), lambda: F.col("first")),
    "last_seen": (("last",), lambda: F.col("last")),
    "duration_hours": (("first", "last"), lambda: hour_boundaries(F.col("first"), F.col("last"))),
}

# Exact distinct counts: measure -> counted column.
DISTINCT_MEASURES: dict[str, str] = {
    "unique_source_networks": "source_ip_masked",
    "unique_dest_networks": "destination_ip_masked",
}


def _needed(measures: Sequence[str]) -> tuple[list[str], bool]:
    """Partials that the measures need, and whether the exact sums are among them."""
    names = dict.fromkeys(p for m in measures if m not in DISTINCT_MEASURES for p in MEASURES[m][0])
    return [p for p in names if p in PARTIALS], VALUES in names


def partial_measures(
    base: DataFrame,
    measures: Sequence[str] = GOLD_MEASURES,
    dims: Sequence[str] = GOLD_DIMS,
) -> DataFrame:
    """Partial measures per group (``_kind`` 0; several rows where the scores
    have several windows) and a row per group and distinct network."""
    names, summed = _needed(measures)
    none, no_window = F.lit(None).cast("string"), F.lit(None).cast("int")
    kinds = [F.struct(F.lit(0).alias(_KIND), none.alias(_VALUE), (window_column("anomaly_score") if summed else no_window).alias(WINDOW))]
    for i, counted in enumerate(DISTINCT_MEASURES.values(), 1):
        if any(DISTINCT_MEASURES.get(m) == counted for m in measures):
            kinds.append(F.struct(F.lit(i).alias(_KIND), F.col(counted).alias(_VALUE), no_window.alias(WINDOW)))
    inputs = dict.fromkeys([PARTIALS[n].column for n in names] + (["anomaly_score"] if summed else []))
    rows = base.select(*dims, *inputs, F.inline(F.array(*kinds)))
    own = F.col(_KIND) == 0
    rows = rows.where(own | F.col(_VALUE).isNotNull())
    aggs = [PARTIALS[n].first(F.when(own, F.col(PARTIALS[n].column))).alias(n) for n in names]
    if summed:
        aggs += [F.sum(F.when(own, c)).alias(n) for n, c in partial_inputs("anomaly_score").items()]
    if not aggs:
        aggs = [F.count(F.lit(1)).alias("rows")]
    return rows.groupBy(*dims, _KIND, _VALUE, WINDOW).agg(*aggs)


def merge_partials(partials: DataFrame, dims: Sequence[str] = GOLD_DIMS) -> DataFrame:
    """Partials of several parts of the log -> partials of all of it."""
    merge = {n: PARTIALS[n].merge if n in PARTIALS else F.sum for n in partials.columns if n not in (*dims, _KIND, _VALUE, WINDOW)}
    return partials.groupBy(*dims, _KIND, _VALUE, WINDOW).agg(*(f(F.col(n)).alias(n) for n, f in merge.items()))


def finish_measures(
    partials: DataFrame,
    measures: Sequence[str] = GOLD_MEASURES,
    dims: Sequence[str] = GOLD_DIMS,
) -> DataFrame:
    """Partials -> one row per group with the named measures."""
    names, summed = _needed(measures)
    counted = [m for m in DISTINCT_MEASURES if m in measures]
    merge = {n: PARTIALS[n].merge for n in names} | dict.fromkeys(counted, F.sum)
    kinds = {m: F.count_if(F.col(_KIND) == i).alias(m) for i, m in enumerate(DISTINCT_MEASURES, 1) if m in measures}
    aggs = [PARTIALS[n].merge(F.col(n)).alias(n) for n in names] + list(kinds.values())
    if summed:
        # the networks are counted beside the windows of the scores, then a few rows a group are left
        merge |= {VALUES: F.sum, NOT_FINITE: F.sum}
        by_window = partials.groupBy(*dims, WINDOW).agg(*aggs, *(F.sum(n).alias(n) for n in PARTIAL_SUMS))
        partials = with_digits(by_window)
        aggs = [f(F.col(n)).alias(n) for n, f in merge.items()] + [merged_windows().alias("windows")]
    value = lambda m: F.col(m) if m in DISTINCT_MEASURES else MEASURES[m][1]()
    return partials.groupBy(*dims).agg(*aggs).select(*dims, *(value(m).alias(m) for m in measures))


def aggregate_incidents(
    base: DataFrame,
    measures: Sequence[str] = GOLD_MEASURES,
    dims: Sequence[str] = GOLD_DIMS,
) -> DataFrame:
    """GROUP BY the Gold dimensions with the named measures (in that order)."""
    return finish_measures(partial_measures(base, measures, dims), measures, dims)


def gold_state(silver: DataFrame) -> DataFrame:
    """The mergeable state of some Silver rows."""
    return partial_measures(incident_base(silver))


def merge_states(*states: DataFrame) -> DataFrame:
    """One state from several: a union and an aggregation."""
    rows = states[0]
    for more in states[1:]:
        rows = rows.unionByName(more)
    return merge_partials(rows)


def gold_from_state(state: DataFrame, *, stamp: bool = True, sort: bool = True) -> DataFrame:
    """Gold fact table from the state of all Silver rows."""
    return _stamped(finish_measures(state), stamp, sort)


def sort_fact(gold: DataFrame) -> DataFrame:
    """Most incidents first, then highest mean anomaly; dimensions break ties."""
    return gold.orderBy(
        F.desc_nulls_last("total_incidents"),
        F.desc_nulls_last("avg_anomaly_score"),
        *(F.asc_nulls_last(d) for d in GOLD_DIMS),
    )


def _stamped(gold: DataFrame, stamp: bool, sort: bool) -> DataFrame:
    if stamp:
        gold = gold.withColumn(GOLD_CREATED_AT, F.current_timestamp())
    return sort_fact(gold) if sort else gold


def to_gold(silver: DataFrame, *, stamp: bool = True, sort: bool = True) -> DataFrame:
    """Silver -> Gold fact table (18 columns; 17 without the stamp)."""
    return _stamped(aggregate_incidents(incident_base(silver)), stamp, sort)
