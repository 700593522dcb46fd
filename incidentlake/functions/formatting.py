"""Display text for report values, matching Python's format specifications.

Java's ``%.nf`` rounds the shortest decimal text of a double half-up, while
Python's ``f"{x:.nf}"`` (and C ``printf``) round the exact binary value half to
even: ``12.35`` is stored as 12.3499999... and prints as ``12.3`` in Python but
``12.4`` in Java. ``format_fixed`` rounds the exact value first, using an
error-free product, so the Java formatter only ever sees an already-rounded
number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Veltkamp splitter for IEEE doubles: 2**27 + 1.
_SPLITTER = 134217729.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _split_const(b: float) -> tuple[float, float]:
    t = _SPLITTER * b
    hi = t - (t - b)
    return hi, b - hi


def _product_error(a: Column, b: float, product: Column) -> Column:
    """Exact ``a*b - fl(a*b)`` (Dekker's two-product, no FMA needed)."""
    b_hi, b_lo = _split_const(b)
    t = F.lit(_SPLITTER) * a
    a_hi = t - (t - a)
    a_lo = a - a_hi
    return a_lo * F.lit(b_lo) - (
        ((product - a_hi * F.lit(b_hi)) - a_lo * F.lit(b_hi)) - a_hi * F.lit(b_lo)
    )


def exact_half_even(c: Column | str, digits: int) -> Column:
    """Round the exact binary value of a double to ``digits`` decimals, ties to
    even, and return the nearest double to the result."""
    x = _col(c).cast("double")
    scale = float(10 ** digits)
    q = x * F.lit(scale)
    nearest = F.rint(q)
    tie = F.abs(q - nearest) == F.lit(0.5)
    err = _product_error(x, scale, q)
    rounded = (
        F.when(tie & (err > 0), q + F.lit(0.5))
        .when(tie & (err < 0), q - F.lit(0.5))
        .otherwise(nearest)
    )
    return rounded / F.lit(scale)


def format_fixed(c: Column | str, digits: int) -> Column:
    """``f"{x:.{digits}f}"`` as text."""
    return F.format_string(f"%.{digits}f", exact_half_even(c, digits))


def percent_label(c: Column | str, digits: int = 1) -> Column:
    """``f"{x:.{digits}f}%"`` as text."""
    return F.format_string(f"%.{digits}f%%", exact_half_even(c, digits))


def thousands(c: Column | str) -> Column:
    """``f"{n:,}"`` for integers: ``1234567`` -> ``'1,234,567'``."""
    return F.format_number(_col(c).cast("bigint"), 0)
