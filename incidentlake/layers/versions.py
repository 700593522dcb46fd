"""Whole replacement of a stored layer, also on an object store.

On an object store a rename copies every byte and can stop half way, so a layer
is never moved. Every run writes a folder of its own, and what makes it current
is one small file::

    layer/_v-20261204T063455-5f1c.../   data of a version (never changed again)
    layer/_commits/000000000007.json    manifest: names the version, counts, schema

A reader lists ``_commits``, takes the highest number and reads that version's
folder. A manifest is written beside its place and renamed, a rename of one small
object; whatever is no complete manifest is not there for a reader. A run that is
killed at any point leaves the former version current, or the new one, whole in
either case. Of two runs that commit at once the later one is current; both are
whole.

Old versions are dropped after a commit: the ``keep`` latest stay for readers
that still use them, and folders that no manifest names (killed runs, or runs
still under way) go when they are older than ``LEFT_OVER_HOURS``. Manifests go
before their data. Names begin with an underscore, so that a reader who is not
aware of versions finds no data instead of several versions at once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from incidentlake.layers.files import Files
from incidentlake.layers.footers import footer_counts

COMMITS = "_commits"
VERSION = "_v-"
KEEP = 2
LEFT_OVER_HOURS = 24
_TIME = "%Y%m%dT%H%M%S"

# What a run has done when it calls its ``after`` hook, in this order.
STEPS = ("data", "counted", "checked", "manifest", "committed", "dropped")


@dataclass(frozen=True)
class Manifest:
    number: int
    version: str
    rows: int
    not_null: dict[str, int] = field(default_factory=dict)
    schema: dict = field(default_factory=dict)
    notes: dict = field(default_factory=dict)

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(self.schema)


def _manifest_name(path: str, number: int) -> str:
    return f"{path}/{COMMITS}/{number:012d}.json"


def _number(name: str) -> int | None:
    digits, dot, kind = name.partition(".")
    return int(digits) if digits.isdigit() and (dot, kind) == (".", "json") else None


def _load(files: Files, path: str, number: int) -> Manifest | None:
    """The manifest of that number; None where it is gone or incomplete."""
    try:
        found = json.loads(files.read(_manifest_name(path, number)))
        return Manifest(**found)
    except (ValueError, TypeError):
        return None  # cut short by a store whose rename is not atomic
    except Exception:
        if files.exists(_manifest_name(path, number)):
            raise
        return None  # dropped since it was listed


def versions(spark: SparkSession, path: str) -> list[Manifest]:
    """Committed versions of a layer, oldest first."""
    path = path.rstrip("/")
    files = Files(spark, path)
    numbers = sorted(n for n in map(_number, files.names(f"{path}/{COMMITS}")) if n is not None)
    return [m for m in (_load(files, path, n) for n in numbers) if m]


def current_version(spark: SparkSession, path: str) -> Manifest | None:
    """The version that readers see; None for a folder without commits."""
    path = path.rstrip("/")
    files = Files(spark, path)
    numbers = sorted((n for n in map(_number, files.names(f"{path}/{COMMITS}")) if n is not None), reverse=True)
    return next((m for m in (_load(files, path, n) for n in numbers) if m), None)


def is_versioned(spark: SparkSession, path: str) -> bool:
    return current_version(spark, path) is not None


def read_version(spark: SparkSession, path: str, manifest: Manifest) -> DataFrame:
    """A version's rows, in the columns' order at writing; the schema comes from
    the manifest, so no footer is read for it."""
    schema = manifest.struct()
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{manifest.version}").select(*(f"`{c}`" for c in schema.names))


def drop_old_versions(spark: SparkSession, path: str, keep: int = KEEP, left_over_hours: float = LEFT_OVER_HOURS) -> list[str]:
    """Drop all but the ``keep`` latest versions, what was there before the layer
    had versions, and old folders without a manifest; gives the folders dropped."""
    path = path.rstrip("/")
    files = Files(spark, path)
    known = versions(spark, path)
    if not known:
        return []
    gone, kept = known[:-keep], known[-keep:]
    for m in gone:
        files.delete(_manifest_name(path, m.number))
    dropped = [m.version for m in gone]
    named = {m.version for m in known}
    oldest = (datetime.now(UTC) - timedelta(hours=left_over_hours)).strftime(_TIME)
    for name in files.names(path):
        if name == COMMITS or name in named:
            continue
        if name.startswith(VERSION) and name[len(VERSION) :].partition("-")[0] > oldest:
            continue  # another run may be writing it
        dropped.append(name)
    for name in dropped:
        files.delete(f"{path}/{name}")
    assert not {m.version for m in kept} & set(dropped)
    return dropped


def commit_layer(
    df: DataFrame,
    path: str,
    *,
    rows_per_group: int | None = None,
    partition_by: Sequence[str] = (),
    compression: str = "snappy",
    counted: Sequence[str] = (),
    check: Callable[[DataFrame, Manifest], None] | None = None,
    notes: Mapping | None = None,
    options: Mapping[str, str] | None = None,
    cluster_by: Sequence[str] = (),
    cluster_partitions: int | None = None,
    bloom_columns: Sequence[str] = (),
    keep: int = KEEP,
    after: Callable[[str], None] = lambda step: None,
) -> Manifest:
    """Write ``df`` as the next version of the layer and make it current.

    The row count, and the non-NULL counts of the columns ``counted``, come from
    the footers of what is stored and go into the manifest with ``notes``;
    ``check`` sees the stored rows and may raise, which leaves the layer as it
    was. ``options`` go to the Parquet writer. ``after`` is called after each of
    ``STEPS``.

    ``cluster_by`` sorts the rows of each task by these columns, so that a file's
    row groups have narrow ranges and a filter on the columns skips most of them;
    no shuffle. With ``cluster_partitions`` rows are first dealt to so many tasks
    by ranges of the columns (a shuffle), and whole files are skipped as well.
    ``bloom_columns`` get Bloom filters, for look-ups of values among many.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    files = Files(spark, path)
    version = f"{VERSION}{datetime.now(UTC).strftime(_TIME)}-{uuid.uuid4().hex}"
    schema = df.schema
    if cluster_by:
        order = [f"`{c}`" for c in (*partition_by, *cluster_by)]
        dealt = df if cluster_partitions is None else df.repartitionByRange(cluster_partitions, *order)
        df = dealt.sortWithinPartitions(*order)
    writer = df.write.mode("errorifexists").option("compression", compression)
    for column in bloom_columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if rows_per_group:
        writer = writer.option("parquet.block.row.count.limit", str(rows_per_group))
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.parquet(f"{path}/{version}")
        after("data")
        counts = footer_counts(spark, f"{path}/{version}", counted, schema)
        after("counted")
        manifest = Manifest(0, version, counts.rows, counts.not_null, schema.jsonValue(), dict(notes or {}))
        if check:
            check(read_version(spark, path, manifest), manifest)
        after("checked")
    except Exception:
        files.delete(f"{path}/{version}")
        raise
    manifest = _commit(spark, files, path, manifest, after)
    after("committed")
    drop_old_versions(spark, path, keep)
    after("dropped")
    return manifest


def _commit(spark: SparkSession, files: Files, path: str, manifest: Manifest, after: Callable[[str], None]) -> Manifest:
    """Put the manifest in its place, behind every other; again with the next
    number where another run took the same one."""
    beside = f"{path}/{COMMITS}/.{uuid.uuid4().hex}"
    while True:
        numbers = [n for n in map(_number, files.names(f"{path}/{COMMITS}")) if n is not None]
        numbered = Manifest(**{**asdict(manifest), "number": max(numbers, default=0) + 1})
        place = _manifest_name(path, numbered.number)
        files.write(beside, json.dumps(asdict(numbered)))
        after("manifest")
        if not files.exists(place) and files.rename(beside, place):
            found = _load(files, path, numbered.number)
            if found and found.version == manifest.version:
                return numbered
