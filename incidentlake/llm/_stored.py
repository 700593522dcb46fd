"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from incidentlake.config import scratch_root


def scratch_path(spark, what: str) -> str:
    return f"{scratch_root(spark)}/llm/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as Parquet to the folder of ``spark.checkpoint.dir`` and
    read back: lineage ends there, so a lost executor costs no recomputation of
    what came before, and every executor reads the same rows."""
    path = scratch_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
