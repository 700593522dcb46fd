"""Gold by increments against the full run: any split, repeats, killed runs."""

import random

import pytest
from pyspark.sql import functions as F

from incidentlake.config import LayerConfig
from incidentlake.layers import commit_layer, current_version
from incidentlake.operators.gold import gold_from_state, gold_state, merge_states, to_gold
from incidentlake.operators.silver import to_silver
from incidentlake.plans import incremental
from incidentlake.plans.incremental import fold_increment, follow_silver, refresh_gold
from incidentlake.schemas import GOLD_CREATED_AT, PROCESSED_AT
from incidentlake.sinks import write_csv
from incidentlake.sources import raw_log, read_events, read_layer
from incidentlake.sources.events_log import raw_log_from_events
from incidentlake.streaming import ingest_available

from conftest import SF_SMALL


def rows_of(gold):
    return sorted(map(str, gold.drop(GOLD_CREATED_AT).collect()))


@pytest.fixture(scope="module")
def silver(spark):
    return to_silver(raw_log(spark, SF_SMALL), stamps=False).cache()


@pytest.fixture(scope="module")
def full(silver):
    return rows_of(to_gold(silver, stamp=False))


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_any_split_gives_the_full_run(silver, full, parts):
    dealt = silver.withColumn("part", F.pmod(F.xxhash64("source_port", "anomaly_score", "timestamp"), F.lit(parts)))
    states = [gold_state(dealt.where(F.col("part") == k).drop("part")) for k in range(parts)]
    random.Random(parts).shuffle(states)
    assert rows_of(gold_from_state(merge_states(*states), stamp=False)) == full


def test_increments_are_folded_once(spark, silver, full, scratch):
    cfg = LayerConfig.under(scratch, "none")
    with pytest.raises(ValueError, match="state"):
        refresh_gold(spark, cfg)
    days = [silver.where(F.pmod(F.hash("source_port"), F.lit(3)) == k) for k in range(3)]
    for k in (0, 1, 0, 2, 1):
        fold_increment(spark, cfg, days[k], f"day-{k}")
    refresh_gold(spark, cfg)
    assert rows_of(read_layer(spark, cfg.gold)) == full
    assert current_version(spark, cfg.gold_state).notes["folded"] == ["day-0", "day-1", "day-2"]


def test_a_killed_fold_is_not_lost_or_doubled(spark, silver, full, scratch, monkeypatch):
    cfg = LayerConfig.under(scratch, "none")
    halves = [silver.where(F.coalesce(F.col("source_port") % 2, F.lit(0)) == k) for k in range(2)]
    fold_increment(spark, cfg, halves[0], "a")
    for step in ("data", "manifest", "committed"):

        class Killed(BaseException):
            pass

        def after(done, step=step, killed=Killed):
            if done == step:
                raise killed

        monkeypatch.setattr(incremental, "commit_layer", lambda *a, after=after, **k: commit_layer(*a, after=after, **k))
        with pytest.raises(Killed):
            fold_increment(spark, cfg, halves[1], "b")
        monkeypatch.undo()
    fold_increment(spark, cfg, halves[1], "b")
    refresh_gold(spark, cfg)
    assert rows_of(read_layer(spark, cfg.gold)) == full


def test_streaming_folds_new_rows_only(spark, scratch):
    cfg = LayerConfig.under(f"{scratch}/lake", f"{scratch}/in")
    events = read_events(spark, SF_SMALL)
    write_csv(raw_log_from_events(events.where("event_id % 2 = 0")).coalesce(1), f"{scratch}/in", mode="append")
    ingest_available(spark, cfg, f"{scratch}/in", f"{scratch}/ckpt")
    first = current_version(spark, cfg.gold_state)
    write_csv(raw_log_from_events(events.where("event_id % 2 = 1")).coalesce(1), f"{scratch}/in", mode="append")
    report = ingest_available(spark, cfg, f"{scratch}/in", f"{scratch}/ckpt")
    second = current_version(spark, cfg.gold_state)
    silver = read_layer(spark, cfg.silver)
    assert second.number == first.number + 1 and second.notes["rows"] == silver.count() > first.notes["rows"]
    assert rows_of(read_layer(spark, cfg.gold)) == rows_of(to_gold(silver, stamp=False))
    assert report.rows == 473
    ingest_available(spark, cfg, f"{scratch}/in", f"{scratch}/ckpt")  # nothing new
    assert current_version(spark, cfg.gold_state) == second


def test_a_state_that_misses_rows_is_made_anew(spark, scratch):
    """A second batch with an earlier stamp, as of a clock that went back."""
    cfg = LayerConfig.under(scratch, "none")
    rows = to_silver(raw_log(spark, SF_SMALL), stamps=False)
    stamped = lambda df, t: df.withColumn("_ingested_at", F.lit(t).cast("timestamp")).withColumn(PROCESSED_AT, F.lit(t).cast("timestamp"))
    half = F.coalesce(F.col("source_port") % 2, F.lit(0)) == 0
    first, second = stamped(rows.where(half), "2026-05-02 10:00:00.123456"), stamped(rows.where(~half), "2026-05-01 10:00:00")
    commit_layer(first, cfg.silver)
    follow_silver(spark, cfg)
    commit_layer(first.unionByName(second), cfg.silver)
    manifest = follow_silver(spark, cfg)
    assert manifest.notes["rows"] == 950
    refresh_gold(spark, cfg)
    assert rows_of(read_layer(spark, cfg.gold)) == rows_of(to_gold(rows, stamp=False))
