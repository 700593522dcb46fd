"""Column expression helpers (all built-in Spark expressions, no UDFs)."""

from incidentlake.functions.exact import mean_by
from incidentlake.functions.formatting import (
    exact_half_even,
    format_fixed,
    percent_label,
    thousands,
)
from incidentlake.functions.numeric import (
    exact_avg,
    half_even_round,
    int_avg,
    safe_ratio,
    sql_round,
    to_double,
    to_int,
)
from incidentlake.functions.temporal import hour_boundaries, to_timestamp_ntz
from incidentlake.functions.text import (
    UNICODE_SPACES,
    mask_ipv4,
    norm_trim,
    norm_upper,
)

__all__ = [
    "UNICODE_SPACES",
    "exact_avg",
    "exact_half_even",
    "format_fixed",
    "half_even_round",
    "hour_boundaries",
    "int_avg",
    "mask_ipv4",
    "mean_by",
    "norm_trim",
    "norm_upper",
    "percent_label",
    "safe_ratio",
    "sql_round",
    "thousands",
    "to_double",
    "to_int",
    "to_timestamp_ntz",
]
