"""Column helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, as a lambda's variable. An
    expression used inside a higher-order function is computed anew for every
    element otherwise."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def free_name(taken: Iterable[str], base: str) -> str:
    """``base``, lengthened until no column of ``taken`` has that name."""
    used = {c.lower() for c in taken}
    while base in used:
        base += "_"
    return base


def whole(df: DataFrame, *without: str) -> list[Column]:
    """Every column of ``df`` by its exact name, but for ``without``."""
    gone = {c.lower() for c in without}
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns if c.lower() not in gone]
