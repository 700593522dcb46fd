"""Incremental landing: each new file lands once, results equal batch."""

import pytest

from incidentlake.operators.silver import to_silver
from incidentlake.sinks import write_csv
from incidentlake.sources import raw_log, read_layer
from incidentlake.streaming import stream_bronze, stream_silver

from conftest import SF_SMALL


def test_incremental_files_land_once(spark, scratch):
    raw = raw_log(spark, SF_SMALL)
    first, second = raw.where("`Packet Type` = 'Data'"), raw.where("`Packet Type` != 'Data'")
    write_csv(first, f"{scratch}/in/batch1")
    src = f"{scratch}/in/*"
    run = lambda: stream_bronze(spark, src, f"{scratch}/bronze", f"{scratch}/ck/b").awaitTermination()
    run()
    n1 = read_layer(spark, f"{scratch}/bronze").count()
    run()  # nothing new: nothing landed twice
    assert read_layer(spark, f"{scratch}/bronze").count() == n1 == first.count()
    write_csv(second, f"{scratch}/in/batch2")
    run()
    assert read_layer(spark, f"{scratch}/bronze").count() == 1000

    stream_silver(spark, f"{scratch}/bronze", f"{scratch}/silver", f"{scratch}/ck/s").awaitTermination()
    got = read_layer(spark, f"{scratch}/silver").drop("_ingested_at", "_processed_at")
    want = to_silver(raw, stamps=False)
    assert got.count() == 950
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_ingest_available_refreshes_gold(spark, scratch):
    from incidentlake.config import LayerConfig
    from incidentlake.schemas import GOLD_CREATED_AT
    from incidentlake.streaming import ingest_available

    write_csv(raw_log(spark, SF_SMALL), f"{scratch}/in/batch1")
    cfg = LayerConfig.under(f"{scratch}/lake", f"{scratch}/in")
    report = ingest_available(spark, cfg, f"{scratch}/in/*", f"{scratch}/ck")
    assert report.layer == "gold" and report.rows == 473
    assert report.details["total_incidents"] == 950
    assert GOLD_CREATED_AT in read_layer(spark, cfg.gold).columns


def test_batch_then_increment_then_batch_loses_nothing(spark, scratch):
    """A stream refuses layers that a batch wrote; a new batch run has it all."""
    from incidentlake.config import LayerConfig
    from incidentlake.plans.pipeline import run_pipeline
    from incidentlake.streaming import ingest_available

    raw = raw_log(spark, SF_SMALL)
    write_csv(raw.where("`Packet Type` = 'Data'"), f"{scratch}/in/one")
    cfg = LayerConfig.under(f"{scratch}/lake", f"{scratch}/in/*")
    half = run_pipeline(spark, cfg)[-1].details["total_incidents"]
    write_csv(raw.where("`Packet Type` != 'Data'"), f"{scratch}/in/two")
    with pytest.raises(ValueError, match="batch"):
        ingest_available(spark, cfg, f"{scratch}/in/*", f"{scratch}/ck")
    assert read_layer(spark, cfg.silver).count() == half < 950
    assert run_pipeline(spark, cfg)[-1].details["total_incidents"] == 950
    # and after a stream, a batch run replaces the whole layer
    streamed = LayerConfig.under(f"{scratch}/lake2", f"{scratch}/in/*")
    ingest_available(spark, streamed, f"{scratch}/in/*", f"{scratch}/ck2")
    assert run_pipeline(spark, streamed)[-1].details["total_incidents"] == 950


def test_stream_follows_the_header(spark, scratch):
    from incidentlake.schemas import RAW_COLUMNS

    write_csv(raw_log(spark, SF_SMALL).select(*(f"`{c}`" for c in reversed(RAW_COLUMNS))), f"{scratch}/in")
    stream_bronze(spark, f"{scratch}/in", f"{scratch}/bronze", f"{scratch}/ck").awaitTermination()
    got = read_layer(spark, f"{scratch}/bronze")
    assert {r[0] for r in got.select("`Log Source`").distinct().collect()} == {"Server", "Firewall"}
    # a later file in another order is refused, not shifted
    write_csv(raw_log(spark, SF_SMALL).select(*(f"`{c}`" for c in reversed(RAW_COLUMNS))), f"{scratch}/both/a")
    write_csv(raw_log(spark, SF_SMALL), f"{scratch}/both/b")
    with pytest.raises(Exception, match="(?i)header"):
        stream_bronze(spark, f"{scratch}/both/*", f"{scratch}/bronze2", f"{scratch}/ck2").awaitTermination()
