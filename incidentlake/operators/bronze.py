"""Bronze: land the raw source unchanged, stamped with the ingestion time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlake.schemas import CORRUPT_RECORD, INGESTED_AT


def land(raw: DataFrame) -> DataFrame:
    """Raw columns as read, plus ``_ingested_at`` (one value per query)."""
    return raw.withColumn(INGESTED_AT, F.current_timestamp())


def accepted(bronze: DataFrame) -> DataFrame:
    """Rows that parsed cleanly, without the reject marker column."""
    if CORRUPT_RECORD not in bronze.columns:
        return bronze
    return bronze.where(F.col(CORRUPT_RECORD).isNull()).drop(CORRUPT_RECORD)


def rejected(bronze: DataFrame) -> DataFrame:
    """Malformed source lines (original text in ``_corrupt_record``)."""
    return bronze.where(F.col(CORRUPT_RECORD).isNotNull())


def load_profile(bronze: DataFrame) -> DataFrame:
    """One row: accepted and rejected line counts, in a single pass.

    Run it on the *stored* Bronze table: counting straight off a CSV scan is
    unreliable, because Spark's CSV reader skips parsing unused columns and so
    cannot see which lines are malformed.
    """
    if CORRUPT_RECORD not in bronze.columns:
        return bronze.agg(F.count(F.lit(1)).alias("rows"), F.lit(0).cast("bigint").alias("rejected"))
    bad = F.col(CORRUPT_RECORD).isNotNull()
    return bronze.agg(F.count_if(~bad).alias("rows"), F.count_if(bad).alias("rejected"))


def no_cut_values(bronze: DataFrame) -> None:
    """Raise if a rejected line has an odd number of quotes: what follows a
    quoted line break then stands alone, and the value before it was cut."""
    line = F.col(CORRUPT_RECORD)
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    if not bronze.where(line.isNotNull() & (quotes % 2 == 1)).isEmpty():
        raise ValueError("a quoted value holds a line break; read the log with multiline on")
