"""Silver: typed, normalised, quality-filtered and privacy-safe log lines.

All transforms are pure ``DataFrame -> DataFrame`` functions over Bronze
columns, built from ``SILVER_SPEC``; ``to_silver`` is a single filter + select,
so Catalyst pushes the null checks into the Parquet scan and the whole layer
runs map-only (no shuffle).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentlake.functions import (
    mask_ipv4,
    norm_trim,
    norm_upper,
    to_double,
    to_int,
    to_timestamp_ntz,
)
from incidentlake.schemas import INGESTED_AT, PII_COLUMNS, PROCESSED_AT, SILVER_SPEC

RULES: dict[str, Callable[[str], Column]] = {
    "timestamp": to_timestamp_ntz,
    "int": to_int,
    "double": to_double,
    "mask": mask_ipv4,
    "upper": norm_upper,
    "trim": norm_trim,
}


def silver_columns(rules: Iterable[str] | None = None) -> list[Column]:
    """Silver column expressions over raw columns, optionally only some rules."""
    wanted = set(rules) if rules is not None else None
    return [
        RULES[rule](F.col(f"`{raw}`")).alias(name)
        for name, raw, rule in SILVER_SPEC
        if wanted is None or rule in wanted
    ]


def quality_filter(raw: DataFrame) -> DataFrame:
    """Keep rows with a raw Timestamp and a non-blank Attack Type.

    The Timestamp test is on the *raw* text, so an unparsable timestamp passes
    and becomes NULL in Silver (the stored layer counts them).
    """
    ts, attack = F.col("`Timestamp`"), F.col("`Attack Type`")
    return raw.where(ts.isNotNull() & attack.isNotNull() & (norm_trim(attack) != F.lit("")))


def typed_columns(raw: DataFrame) -> DataFrame:
    """Timestamp, ports, packet length and anomaly score parsed leniently."""
    return raw.select(*silver_columns(("timestamp", "int", "double")))


def masked_ips(raw: DataFrame) -> DataFrame:
    """Source and destination addresses with the host octets hidden."""
    return raw.select(*silver_columns(("mask",)))


def normalised_text(raw: DataFrame) -> DataFrame:
    """Categorical columns upper-cased and trimmed, context columns trimmed."""
    return raw.select(*silver_columns(("upper", "trim")))


def drop_columns(df: DataFrame, columns: Iterable[str] = PII_COLUMNS) -> DataFrame:
    """Drop personal / traceable columns (payload, user, proxy by default)."""
    return df.drop(*columns)


def to_silver(bronze: DataFrame, *, stamps: bool = True) -> DataFrame:
    """Bronze -> Silver (24 columns; 22 without the audit stamps).

    PII columns are not carried over: the projection only names the kept
    columns. ``_ingested_at`` passes through and ``_processed_at`` is stamped.
    """
    cols = silver_columns()
    if stamps:
        ingested = F.col(INGESTED_AT) if INGESTED_AT in bronze.columns else F.lit(None).cast("timestamp")
        cols += [ingested.alias(INGESTED_AT), F.current_timestamp().alias(PROCESSED_AT)]
    return quality_filter(bronze).select(*cols)
