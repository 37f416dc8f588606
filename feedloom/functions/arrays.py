"""Array picks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_item(array: Column) -> Column:
    """First item; NULL for a missing or an empty array (element_at throws there under ANSI)."""
    return F.get(array, F.lit(0))


def using(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used there."""
    return first_item(F.transform(F.array(value), use))
