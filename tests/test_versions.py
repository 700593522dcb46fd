"""Versioned layers: a run that is killed between any two steps leaves one whole
version; counts come from footers; two runs at once; old versions go."""

import json
import os
import pathlib
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from incidentlake.layers import commit_layer, current_version, drop_old_versions, footer_counts, versions
from incidentlake.layers.footers import footer_frame
from incidentlake.layers.versions import STEPS, VERSION
from incidentlake.sinks import write_layer
from incidentlake.sources import read_layer

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


class Killed(BaseException):
    """Ends the run where it stands, as a killed driver: nothing catches it."""


def killed_at(step):
    def after(done):
        if done == step:
            raise Killed(step)

    return after


def whole(spark, path):
    return [r[0] for r in read_layer(spark, path).orderBy("id").collect()]


@pytest.mark.parametrize("step", STEPS)
def test_a_killed_run_leaves_one_whole_version(spark, scratch, step):
    path = f"{scratch}/layer"
    commit_layer(spark.range(10), path)
    with pytest.raises(Killed):
        commit_layer(spark.range(100, 160), path, after=killed_at(step))
    new = STEPS.index(step) >= STEPS.index("committed")
    assert whole(spark, path) == (list(range(100, 160)) if new else list(range(10)))
    commit_layer(spark.range(7), path)
    assert whole(spark, path) == list(range(7)) and current_version(spark, path).rows == 7


def test_first_run_killed_leaves_no_layer(spark, scratch):
    path = f"{scratch}/layer"
    with pytest.raises(Killed):
        commit_layer(spark.range(10), path, after=killed_at("manifest"))
    assert current_version(spark, path) is None
    with pytest.raises(Exception, match="(?i)schema|exist"):
        read_layer(spark, path).count()


SCRIPT = textwrap.dedent("""
    import os, sys
    sys.path.insert(0, {repo!r})
    from incidentlake.config import local_session
    from incidentlake.layers import commit_layer
    spark = local_session(cores=2)
    commit_layer(spark.range(100, 160), {path!r}, after=lambda step: os._exit(9) if step == "manifest" else None)
""")


def test_a_killed_process(spark, scratch):
    path = f"{scratch}/layer"
    commit_layer(spark.range(10), path)
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO, path=path)], capture_output=True, timeout=300)
    assert done.returncode == 9
    assert whole(spark, path) == list(range(10))
    assert len(list(pathlib.Path(path).glob("_v-*"))) == 2


def test_an_incomplete_manifest_is_no_commit(spark, scratch):
    path = f"{scratch}/layer"
    first = commit_layer(spark.range(10), path)
    commits = pathlib.Path(path, "_commits")
    text = (commits / "000000000001.json").read_text()
    (commits / "000000000002.json").write_text(text[: len(text) // 2])
    (commits / "000000000003.json").write_text("")
    assert current_version(spark, path) == first and whole(spark, path) == list(range(10))
    assert commit_layer(spark.range(3), path).number == 4
    assert whole(spark, path) == [0, 1, 2]


def test_two_runs_at_once(spark, scratch):
    """The second run commits between the first one's manifest and its place."""
    path = f"{scratch}/layer"
    commit_layer(spark.range(1), path)
    raced = []

    def after(step):
        if step == "manifest" and not raced:
            raced.append(commit_layer(spark.range(20), path))

    last = commit_layer(spark.range(30), path, after=after)
    assert (raced[0].number, last.number) == (2, 3)
    assert whole(spark, path) == list(range(30))
    assert [m.rows for m in versions(spark, path)] == [20, 30]


def test_readers_of_the_former_version_finish(spark, scratch):
    path = f"{scratch}/layer"
    commit_layer(spark.range(10), path)
    reader = read_layer(spark, path)
    commit_layer(spark.range(50, 60), path)
    assert reader.count() == 10 and read_layer(spark, path).agg(F.min("id")).first()[0] == 50


def test_old_versions_go_and_left_overs_wait(spark, scratch, monkeypatch):
    path = f"{scratch}/layer"
    for n in range(1, 5):
        commit_layer(spark.range(n), path)
    assert [m.rows for m in versions(spark, path)] == [3, 4]
    with pytest.raises(Killed):
        commit_layer(spark.range(9), path, after=killed_at("data"))
    assert len(list(pathlib.Path(path).glob("_v-*"))) == 3
    assert drop_old_versions(spark, path) == []
    assert len(drop_old_versions(spark, path, left_over_hours=-1)) == 1
    assert len(list(pathlib.Path(path).glob("_v-*"))) == 2 and whole(spark, path) == list(range(4))


def test_a_plain_layer_becomes_versioned(spark, scratch):
    path = f"{scratch}/layer"
    write_layer(spark.range(10), path)
    assert whole(spark, path) == list(range(10))
    with pytest.raises(Killed):
        commit_layer(spark.range(3), path, after=killed_at("manifest"))
    assert whole(spark, path) == list(range(10))
    commit_layer(spark.range(3), path)
    assert whole(spark, path) == [0, 1, 2]
    assert sorted({p.name[:3] for p in pathlib.Path(path).iterdir()}) == ["_co", "_v-"]


def test_failures_leave_the_layer(spark, scratch):
    path = f"{scratch}/layer"
    commit_layer(spark.range(10), path)
    with pytest.raises(Exception, match="(?i)broken"):
        commit_layer(spark.range(5).select(F.raise_error(F.lit("broken")).alias("id")), path)

    def refuse(rows, manifest):
        assert rows.count() == manifest.rows == 5
        raise ValueError("refused")

    with pytest.raises(ValueError, match="refused"):
        commit_layer(spark.range(5), path, check=refuse)
    assert whole(spark, path) == list(range(10)) and len(list(pathlib.Path(path).glob("_v-*"))) == 1


def test_counts_come_from_footers(spark, scratch):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.lit("x")).alias("odd name"), (F.col("id") % 4).alias("p"))
    manifest = commit_layer(rows, f"{scratch}/layer", counted=["id", "odd name"], partition_by=["p"], notes={"a": [1]})
    assert (manifest.rows, manifest.not_null) == (1000, {"id": 1000, "odd name": 666})
    assert current_version(spark, f"{scratch}/layer").notes == {"a": [1]}
    assert read_layer(spark, f"{scratch}/layer").columns == ["id", "odd name", "p"]
    write_layer(rows.drop("p"), f"{scratch}/plain")
    assert footer_counts(spark, f"{scratch}/plain", ["odd name"]).nulls("odd name") == 334
    plan = footer_frame(spark, f"{scratch}/plain", ["odd name"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(`odd name`)]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_empty_partitioned_layer(spark, scratch):
    rows = spark.range(0).select("id", F.lit("a").alias("p"))
    assert commit_layer(rows, f"{scratch}/layer", partition_by=["p"]).rows == 0
    assert read_layer(spark, f"{scratch}/layer").dtypes == [("id", "bigint"), ("p", "string")]
    assert read_layer(spark, f"{scratch}/layer").count() == 0


def test_manifest_is_small_and_plain(spark, scratch):
    commit_layer(spark.range(5), f"{scratch}/layer")
    found = json.loads(pathlib.Path(f"{scratch}/layer/_commits/000000000001.json").read_text())
    assert found["rows"] == 5 and found["version"].startswith(VERSION)
