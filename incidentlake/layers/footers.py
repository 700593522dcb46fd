"""Row and NULL counts of stored Parquet from its footers alone.

Spark's Parquet source answers COUNT(*) and COUNT(column) from the row counts
and NULL counts that the writer left in each file's footer, if aggregate
push-down is on: a task a group of files, no column data read. That needs the
newer source interface, so the counts run in a session of their own settings.
Files of failed task attempts are not part of the committed folder, so the
counts are those of what is stored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SETTINGS = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}


@dataclass(frozen=True)
class FooterCounts:
    rows: int
    not_null: dict[str, int]

    def nulls(self, column: str) -> int:
        return self.rows - self.not_null[column]


def footer_frame(spark: SparkSession, path: str, columns: Sequence[str] = (), schema: T.StructType | None = None) -> DataFrame:
    """One row: the number of rows and of non-NULL values of each column."""
    own = spark.newSession()
    for key, value in _SETTINGS.items():
        own.conf.set(key, value)
    reader = own.read if schema is None else own.read.schema(schema)
    counts = [F.count(F.col(f"`{c}`")).alias(c) for c in columns]
    return reader.parquet(path).agg(F.count(F.lit(1)).alias("*"), *counts)


def footer_counts(spark: SparkSession, path: str, columns: Sequence[str] = (), schema: T.StructType | None = None) -> FooterCounts:
    """Exact counts of the Parquet files under ``path``."""
    row = footer_frame(spark, path, columns, schema).first().asDict()
    counts = {c: int(n or 0) for c, n in row.items()}  # NULL where there is no file at all
    return FooterCounts(counts.pop("*"), counts)
