"""Numeric Column helpers: typed parsing, rounding and exact averages.

Every helper returns a built-in Spark ``Column`` expression, so it stays inside
whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from incidentlake.functions.exact import exact_sum

# The numerals that lenient SQL casts accept. Spark's own cast also
# takes Java forms (12.5d, 5F, 0x1p3), which are no numbers elsewhere.
_DIGITS = r"\d+(?:_\d+)*"
_NUMERAL = rf"^\s*[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\s*$"
_NOT_FINITE = r"^\s*[+-]?(?i:nan|inf|infinity)\s*$"
_HEXADECIMAL = r"^\s*0[xX]([0-9a-fA-F]+(?:_[0-9a-fA-F]+)*)\s*$"
_BINARY = r"^\s*0[bB]([01]+(?:_[01]+)*)\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _numeral(col: Column) -> Column:
    """The text without digit separators where it is a numeral, else NULL."""
    return F.when(col.rlike(_NUMERAL), F.translate(col, "_", ""))


def to_double(c: Column | str) -> Column:
    """Text -> DOUBLE, NULL when unparsable (never raises under ANSI mode)."""
    col = _col(c)
    return F.coalesce(_numeral(col), F.when(col.rlike(_NOT_FINITE), col)).try_cast("double")


def to_int(c: Column | str) -> Column:
    """Text -> INT the way SQL engines with lenient integer parsing do it.

    ``'12.5'`` -> 13, ``'1e3'`` -> 1000, ``'1_000'`` -> 1000, ``'0x1F'`` -> 31;
    out of range or unparsable -> NULL. Spark's own ``try_cast(... as int)``
    rejects decimals and exponents, so such text goes through DOUBLE and is
    rounded half away from zero. Plain integers take the cheaper direct parse
    first (same result).
    """
    col = _col(c)
    text = _numeral(col)
    other = lambda pattern, base: F.when(
        col.rlike(pattern), F.conv(F.translate(F.regexp_extract(col, pattern, 1), "_", ""), base, 10)
    ).try_cast("int")
    return F.coalesce(
        text.try_cast("int"), F.round(text.try_cast("double")).try_cast("int"), other(_HEXADECIMAL, 16), other(_BINARY, 2)
    )


def sql_round(c: Column | str, digits: int) -> Column:
    """``ROUND(double, n)`` as SQL engines compute it: half away from zero
    applied to the *scaled double* ``x * 10^n`` (N1).

    Spark's ``round`` works on the decimal text of the double instead, so
    ``round(1.005, 2)`` gives 1.01 in Spark but 1.0 in SQL engines.
    """
    scale = F.lit(float(10 ** digits))
    return F.round(_col(c) * scale, 0) / scale


def half_even_round(c: Column | str, digits: int) -> Column:
    """numpy/pandas ``.round(n)``: ``rint(x * 10^n) / 10^n`` (N2)."""
    scale = F.lit(float(10 ** digits))
    return F.rint(_col(c) * scale) / scale


def exact_avg(c: Column | str) -> Column:
    """Average of doubles; no value is ever dropped or cut.

    A double sum depends on the order rows arrive in, and a rounding tie can
    then flip between runs (N12). Here the sum is exact and rounded once
    (``functions.exact``), so every partitioning gets the same double.
    """
    col = _col(c)
    return exact_sum(col) / F.nullif(F.count(col), F.lit(0))


def int_avg(c: Column | str) -> Column:
    """Average of integers: the exact BIGINT sum over the count."""
    col = _col(c)
    return F.sum(col.cast("bigint")).cast("double") / F.nullif(F.count(col), F.lit(0))


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / NULLIF(den, 0)``."""
    return num / F.nullif(den, F.lit(0))
