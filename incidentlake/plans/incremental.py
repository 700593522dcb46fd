"""Gold that follows Silver by increments.

The state of all Silver rows so far (``operators.gold.gold_state``: partial
measures and distinct networks) is a versioned layer beside Gold. An increment is
folded in by a union and an aggregation over state and increment; Silver rows of
earlier increments are not read again. Gold is then finished from the state.

What has been folded is part of the state's manifest, so state and mark change in
one commit: a run that is killed anywhere folds nothing twice and leaves nothing
out. Gold itself may lag by one run then; ``refresh_gold`` catches up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentlake.config import LayerConfig
from incidentlake.layers import Manifest, commit_layer, current_version, footer_counts, read_version
from incidentlake.operators.gold import gold_from_state, gold_state, merge_states
from incidentlake.schemas import PROCESSED_AT
from incidentlake.sources import read_layer

# Manifest notes: labels of folded increments; the latest stamp folded by follow_silver.
FOLDED, UNTIL, ROWS = "folded", "until", "rows"


def _state(spark: SparkSession, cfg: LayerConfig) -> tuple[Manifest | None, DataFrame | None]:
    old = current_version(spark, cfg.gold_state)
    return old, None if old is None else read_version(spark, cfg.gold_state, old)


def fold_increment(spark: SparkSession, cfg: LayerConfig, increment: DataFrame, label: str) -> Manifest:
    """Fold Silver rows into the state, once per ``label`` (a day, a batch, a
    file name); a label that was folded before changes nothing."""
    old, state = _state(spark, cfg)
    notes = dict(old.notes) if old else {}
    if label in notes.get(FOLDED, []):
        return old
    fresh = gold_state(increment)
    notes[FOLDED] = [*notes.get(FOLDED, []), label]
    return commit_layer(fresh if state is None else merge_states(state, fresh), cfg.gold_state, notes=notes)


def follow_silver(spark: SparkSession, cfg: LayerConfig) -> Manifest | None:
    """Fold what a stream has added to the Silver layer since the last time.

    Rows are told by ``_processed_at``, one stamp per micro-batch: files of
    earlier batches are skipped by their footers. If the rows counted in the
    state afterwards are not those in Silver's footers (a clock that went back,
    or a Silver layer that was replaced), the state is made anew from all rows.
    """
    silver = read_layer(spark, cfg.silver)
    stamp = F.col(PROCESSED_AT)
    # as text in microseconds: exact in a manifest, and the same in every time zone
    latest = silver.agg(F.unix_micros(F.max(stamp)).alias("t")).first()["t"]
    if latest is None:
        return current_version(spark, cfg.gold_state)
    old, state = _state(spark, cfg)
    known = old.notes.get(UNTIL) if old else None
    rows = _counted_rows(spark, cfg, silver)
    upto = silver.where(stamp <= F.timestamp_micros(F.lit(latest)))
    if known is not None:
        if known == latest and old.notes.get(ROWS) == rows:
            return old
        added = upto.where(stamp > F.timestamp_micros(F.lit(known)))
        manifest = _commit_counted(cfg, merge_states(state, gold_state(added)), latest, rows)
        if manifest.notes[ROWS] == rows:
            return manifest
    return _commit_counted(cfg, gold_state(upto), latest, rows)


def _counted_rows(spark: SparkSession, cfg: LayerConfig, silver: DataFrame) -> int:
    """Silver rows that Gold counts, from footers."""
    version = current_version(spark, cfg.silver)
    path = cfg.silver if version is None else f"{cfg.silver.rstrip('/')}/{version.version}"
    return footer_counts(spark, path, ["attack_type"], silver.schema).not_null["attack_type"]


class _Short(Exception):
    """The state does not count the rows that it should."""


def _commit_counted(cfg: LayerConfig, state: DataFrame, until: int, rows: int) -> Manifest:
    """Commit the state if it counts ``rows`` incidents; else say what it counts."""
    found = []

    def check(stored: DataFrame, _: Manifest) -> None:
        found.append(int(stored.agg(F.sum("incidents")).first()[0] or 0))
        if found[0] != rows:
            raise _Short

    try:
        return commit_layer(state, cfg.gold_state, check=check, notes={UNTIL: until, ROWS: rows})
    except _Short:
        return Manifest(0, "", 0, notes={ROWS: found[0]})


def refresh_gold(spark: SparkSession, cfg: LayerConfig) -> Manifest:
    """Gold finished from the state."""
    _, state = _state(spark, cfg)
    if state is None:
        raise ValueError("there is no state yet; fold an increment first")
    return commit_layer(gold_from_state(state), cfg.gold, partition_by=cfg.partition_by.get("gold", ()))
