"""Parquet layer sources and source discovery."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from incidentlake.layers import current_version, read_version
from incidentlake.operators.bronze import accepted, rejected


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` (or anything that it matches, for a pattern) exists,
    for any filesystem URI Hadoop understands."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(hpath))


def first_existing(spark: SparkSession, candidates: Sequence[str]) -> str:
    """First candidate location that exists; ``FileNotFoundError`` otherwise."""
    for c in candidates:
        if path_exists(spark, c):
            return c
    raise FileNotFoundError(f"none of these inputs exists: {list(candidates)}")


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """A stored layer: the current version of a versioned one, else the Parquet
    folder. Lazy: but for the manifest nothing is read until an action."""
    manifest = current_version(spark, path)
    return spark.read.parquet(path) if manifest is None else read_version(spark, path, manifest)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Bronze rows that parsed cleanly (rejected lines are stored alongside)."""
    return accepted(read_layer(spark, path))


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Bronze lines that did not parse, with their original text."""
    return rejected(read_layer(spark, path))


def register_layers(spark: SparkSession, cfg) -> list[str]:
    """Expose the stored layers as temporary views ``bronze``, ``silver`` and
    ``gold`` (only those that exist), for ``spark.sql`` queries. Bronze is
    shown without rejected lines; ``bronze_rejects`` lists those."""
    names = []
    for name, path in (("bronze", cfg.bronze), ("silver", cfg.silver), ("gold", cfg.gold)):
        if not path_exists(spark, path):
            continue
        if name == "bronze":
            read_bronze(spark, path).createOrReplaceTempView("bronze")
            read_rejects(spark, path).createOrReplaceTempView("bronze_rejects")
            names += ["bronze", "bronze_rejects"]
        else:
            read_layer(spark, path).createOrReplaceTempView(name)
            names.append(name)
    return names
