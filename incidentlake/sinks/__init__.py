"""Writers for the stored layers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame


def _write(df: DataFrame, path: str, mode: str, rows_per_group, partition_by, compression: str) -> None:
    w = df.write.mode(mode).option("compression", compression)
    if rows_per_group:
        w = w.option("parquet.block.row.count.limit", str(rows_per_group))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_layer(
    df: DataFrame,
    path: str,
    *,
    rows_per_group: int | None = None,
    partition_by: Sequence[str] = (),
    compression: str = "snappy",
    check: Callable[[DataFrame], None] | None = None,
) -> int:
    """Write a layer as Parquet, replacing what was there; gives the number of
    rows read back from what was written.

    The new layer is written to a folder beside the target, counted there (and
    passed to ``check``, which may raise), and only then put in its place by
    renaming. If anything fails before that, the old layer is untouched.
    ``rows_per_group`` caps rows per Parquet row group; ``partition_by`` adds
    directory partitioning (pruned on read).
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = at(path).getFileSystem(conf)
    mark = uuid.uuid4().hex
    following, previous = f"{path}.next-{mark}", f"{path}.previous-{mark}"
    try:
        _write(df, following, "errorifexists", rows_per_group, partition_by, compression)
        stored = spark.read.parquet(following)
        rows = stored.count()
        if check:
            check(stored)
    except BaseException:
        fs.delete(at(following), True)
        raise
    had = fs.exists(at(path))
    if had and not fs.rename(at(path), at(previous)):
        raise OSError(f"cannot move the old layer away: {path}")
    if not had:
        fs.mkdirs(at(path).getParent())
    if not fs.rename(at(following), at(path)):
        if had:
            fs.rename(at(previous), at(path))
        raise OSError(f"cannot put the new layer in place: {path}")
    if had:
        fs.delete(at(previous), True)
    return rows


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """Write CSV the way the raw reader expects it: header, RFC 4180 quoting,
    NULL as an empty field, and no trimming of leading/trailing spaces."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


__all__ = ["write_csv", "write_layer"]
