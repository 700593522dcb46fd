"""Exact sums of doubles: the same bits whatever the order of the rows.

A double is a whole number of units of 2^-1074. Its bits are cut at fixed places,
every ``WINDOW_BITS`` from the lowest unit up, into whole numbers, which are
summed as whole numbers: exactly, in any order, partial sum by partial sum. Only
the finished windows are joined to a double again, once per group.

A double's 53 bits lie in two neighbouring windows, ``window_of`` and the one
below. Two ways to sum:

* ``LIMB_SUMS`` for large tables: group by the window as well (a handful per group
  in practice, ``WINDOWS`` at most) and sum the six limbs of ``limbs``, plain long
  sums that hold for 2^42 rows. ``carried`` turns the six sums into three digits,
  and ``digits_of`` adds up those of a group's windows.
  ``mean_by`` does both steps.
* ``exact_sum`` as one aggregate expression for a ``groupBy`` with keys, a decimal
  sum per window: simple, but several times slower.

NaN and infinities take no part in windows; a group that holds any sums to what
they sum to, in any order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import wraps

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW_BITS = 61
WINDOWS = 35  # 35 x 61 bits hold every double
LOWEST_BIT = 1074
_LIMB_BITS = (21, 20, 20)  # of a window, from the lowest
LIMB_SUMS: tuple[str, ...] = ("low_0", "low_1", "low_2", "high_0", "high_1", "high_2")
# What else a group and window needs: the number of values, and the sum of those
# that are not finite (they have no window).
VALUES, NOT_FINITE = "values", "not_finite"
PARTIAL_SUMS: tuple[str, ...] = (*LIMB_SUMS, VALUES, NOT_FINITE)
WINDOW = "window"


def _kept(make: Callable) -> Callable:
    """Keeps what ``make`` gives for some names. A Column never changes, but every
    function in it costs a call to the JVM when it is built."""
    known: dict = {}

    @wraps(make)
    def given(*names: str):
        key = (id(SparkContext._gateway), names)
        if key not in known:
            known[key] = make(*names)
        return known[key]

    return given


def finite(col: Column) -> Column:
    """TRUE for numbers, FALSE for NaN and infinities, NULL for NULL."""
    return F.abs(col) < F.lit(float("inf"))


def _unit(window: Column) -> Column:
    return F.pow(F.lit(2.0), (window * WINDOW_BITS - LOWEST_BIT).cast("double"))


def window_of(col: Column) -> Column:
    """Number of the window with the highest bit of a finite double (0 for 0.0);
    NULL for other values. A logarithm that errs by its last bit does no harm:
    a part may then have one bit more or be 0."""
    place = F.floor((F.log2(F.abs(col)) + LOWEST_BIT) / WINDOW_BITS)
    return F.when(col == 0, F.lit(0)).when(finite(col), F.least(F.greatest(place, F.lit(0)), F.lit(WINDOWS - 1))).cast("int")


def parts(col: Column, window: Column) -> tuple[Column, Column]:
    """The double in units of its window, and the rest in units of the window
    below: two whole numbers."""
    high = (col / _unit(window)).cast("bigint")
    rest = col - high.cast("double") * _unit(window)
    return high, (rest / _unit(F.greatest(window - 1, F.lit(0)))).cast("bigint")


def limbs(high: Column, low: Column) -> list[Column]:
    """Both parts cut into short whole numbers, in the order of ``LIMB_SUMS``;
    the last of a part has its sign."""
    out = []
    for part in (low, high):
        at = 0
        for bits in _LIMB_BITS:
            rest = F.shiftright(part, at) if at else part
            out.append(rest if bits == _LIMB_BITS[-1] and at + bits == WINDOW_BITS else rest.bitwiseAND(F.lit((1 << bits) - 1)))
            at += bits
    return out


def carried(sums: Sequence[Column]) -> tuple[Column, Column, Column]:
    """Sums of limbs -> digits for the window below, the window itself and the
    one above. The first two are from 0 to 2^61 - 1."""
    digits, carry = [], None
    for bits, limb in zip(_LIMB_BITS * 2, sums, strict=True):
        value = limb if carry is None else limb + carry
        digits.append(value.bitwiseAND(F.lit((1 << bits) - 1)))
        carry = F.shiftright(value, bits)
    a, b, _ = _LIMB_BITS
    join = lambda d: d[0] + F.shiftleft(d[1], a) + F.shiftleft(d[2], a + b)
    return join(digits[:3]), join(digits[3:]), carry


@_kept
def merged_windows() -> Column:
    """Aggregate over ``with_digits``, a row per window: the group's windows, of
    which there are ``WINDOWS`` at most."""
    row = F.struct(WINDOW, "low", "high", "top")
    return F.collect_list(F.when(F.col(WINDOW).isNotNull(), row))


def _placed(window: Column, digit: Column) -> Column:
    return F.struct(window.cast("int").alias("window"), digit.alias("digit"))


def digits_of(windows: Column) -> Column:
    """Array of (``window``, ``digit``), from the lowest window that the group has
    to the highest: the sum of the digits that fall into each. Below
    2^62 + 2^43, as no two rows are of one window. NULL without windows."""
    nothing = F.lit(0).cast("bigint")
    numbers = F.transform(windows, lambda p: p[WINDOW])
    every = F.sequence(F.greatest(F.array_min(numbers) - 1, F.lit(0)), F.array_max(numbers) + 1)
    part = lambda p, w: F.when(p[WINDOW] == w, p["high"]).when(p[WINDOW] == w + 1, p["low"]).when(p[WINDOW] == w - 1, p["top"]).otherwise(nothing)
    return F.transform(every, lambda w: _placed(w, F.aggregate(windows, nothing, lambda acc, p: acc + part(p, w))))


def joined(digits: Column) -> Column:
    """Array of (``window``, ``digit``) of neighbouring windows, from the lowest ->
    double. Carries first, so that the highest digits lead; then halves of digits,
    highest first, so that rounding comes last."""
    half, long = 31, lambda x: F.lit(x).cast("bigint")
    none = F.array().cast("array<struct<window: int, digit: bigint>>")

    def step(acc, p):
        value = p["digit"] + acc["carry"]
        carry = F.shiftright(value + long(1 << (WINDOW_BITS - 1)), WINDOW_BITS)
        rest = _placed(p["window"], value - F.shiftleft(carry, WINDOW_BITS))
        return F.struct(carry.alias("carry"), F.concat(F.array(rest), acc["out"]).alias("out"))

    def add(total, p):
        unit = F.pow(F.lit(2.0), (p["window"] * WINDOW_BITS - LOWEST_BIT).cast("double"))
        upper = F.shiftright(p["digit"], half)
        return total + upper.cast("double") * unit * F.lit(float(1 << half)) + (p["digit"] - F.shiftleft(upper, half)).cast("double") * unit

    even = F.aggregate(digits, F.struct(long(0).alias("carry"), none.alias("out")), step, lambda acc: acc["out"])
    return F.aggregate(F.filter(even, lambda p: p["digit"] != 0), F.lit(0.0), add)


@_kept
def window_column(column: str) -> Column:
    return window_of(F.col(column))


@_kept
def partial_inputs(column: str) -> dict[str, Column]:
    """What is summed per group and window, by the names of ``PARTIAL_SUMS``; the
    window is in the column ``WINDOW``."""
    col = F.col(column)
    cut = dict(zip(LIMB_SUMS, limbs(*parts(col, F.col(WINDOW))), strict=True))
    return {**cut, VALUES: col.isNotNull().cast("bigint"), NOT_FINITE: F.when(~finite(col), col)}


@_kept
def _digit_columns() -> list[Column]:
    return [c.alias(n) for c, n in zip(carried([F.col(n) for n in LIMB_SUMS]), ("low", "high", "top"), strict=True)]


def with_digits(partial: DataFrame) -> DataFrame:
    """Partial sums with the digits of their limbs (``low``, ``high``, ``top``)."""
    return partial.select(*(c for c in partial.columns if c not in LIMB_SUMS), *_digit_columns())


@_kept
def mean_of(windows: str, values: str, not_finite: str) -> Column:
    """The mean from the columns with a group's windows, number of values and
    sum of values that are not finite."""
    total = F.coalesce(F.col(not_finite), joined(digits_of(F.col(windows))))
    return total / F.nullif(F.col(values), F.lit(0))


def mean_by(df: DataFrame, keys: Sequence[str], column: str, name: str, first: Mapping[str, Column], second: Mapping[str, Column]) -> DataFrame:
    """``groupBy(keys)`` with the exact mean of ``column`` as ``name`` and more
    aggregates: ``first`` are taken per (keys, window), ``second`` over those. Two
    small shuffles; the first one carries a row per group and task."""
    rows = df.withColumn(WINDOW, window_column(column)).withColumns(partial_inputs(column))
    sums = [F.sum(n).alias(n) for n in PARTIAL_SUMS]
    partial = with_digits(rows.groupBy(*keys, WINDOW).agg(*sums, *(c.alias(n) for n, c in first.items())))
    merged = partial.groupBy(*keys).agg(
        merged_windows().alias("windows"), F.sum(VALUES).alias(VALUES), F.sum(NOT_FINITE).alias(NOT_FINITE),
        *(c.alias(n) for n, c in second.items()),
    )
    return merged.select(*keys, *second, mean_of("windows", VALUES, NOT_FINITE).alias(name))


def exact_sum(col: Column) -> Column:
    """Aggregate: the exact sum of doubles, rounded once; NULL without values."""
    window = window_of(col)
    high, low = parts(col, window)
    # one value a row, taken apart by its place: the sums' code stays small, however many there are
    cut = F.transform(
        F.array(F.struct(window.alias("w"), high.alias("high"), low.alias("low"))),
        lambda p: F.transform(F.sequence(F.lit(0), F.lit(WINDOWS - 1)), lambda w: F.when(w == p["w"], p["high"]).when(w == p["w"] - 1, p["low"])),
    )[0]
    whole = [F.coalesce(F.sum(F.get(cut, F.lit(w)).cast("decimal(28,0)")), F.lit(0).cast("decimal(38,0)")) for w in range(WINDOWS)]
    base, nothing = F.lit(1 << WINDOW_BITS).cast("decimal(19,0)"), F.lit(0).cast("bigint")
    begin = F.struct(nothing.alias("carry"), F.array().cast("array<bigint>").alias("out"))

    def step(acc, value):
        value = (value + acc["carry"]).cast("decimal(38,0)")
        carry = F.call_function("div", value, base)
        digit = (value - carry.cast("decimal(19,0)") * base).cast("bigint")
        return F.struct(carry.alias("carry"), F.concat(acc["out"], F.array(digit)).alias("out"))

    longs = F.aggregate(F.array(*whole), begin, step, lambda acc: F.concat(acc["out"], F.array(acc["carry"])))
    digits = F.transform(longs, lambda d, w: _placed(w, d))
    odd = F.sum(F.when(~finite(col), col))
    return F.when(F.count(col) > 0, F.coalesce(odd, joined(digits)))
