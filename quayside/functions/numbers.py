"""Arithmetic with blanks: a missing operand counts as nothing, not as an unknown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_add(a: Column, b: Column) -> Column:
    """a + b where a missing side counts as 0; NULL only when both are missing."""
    return F.coalesce(a + b, a, b)


def blank_subtract(a: Column, b: Column) -> Column:
    """a - b where a missing side counts as 0; NULL only when both are missing."""
    return F.coalesce(a - b, a, -b)


def ratio(a: Column, b: Column) -> Column:
    """a / b as double; NULL when b is 0 or missing."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def money(c: Column) -> Column:
    return c.cast("decimal(20,2)")
