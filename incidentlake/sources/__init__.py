"""Readers: raw CSV, stored layers, and the raw log derived from ``events``."""

from incidentlake.sources.csv import header_columns, read_raw_csv
from incidentlake.sources.events_log import (
    RAW_LOG_EXPRESSIONS,
    raw_log,
    raw_log_from_events,
    raw_log_select_sql,
    read_events,
)
from incidentlake.sources.layers import (
    first_existing,
    path_exists,
    read_bronze,
    read_layer,
    read_rejects,
    register_layers,
)

__all__ = [
    "RAW_LOG_EXPRESSIONS",
    "first_existing",
    "header_columns",
    "path_exists",
    "raw_log",
    "raw_log_from_events",
    "raw_log_select_sql",
    "read_bronze",
    "read_events",
    "read_layer",
    "read_raw_csv",
    "read_rejects",
    "register_layers",
]
