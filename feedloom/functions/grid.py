"""Arithmetic of the request grid: near-square cells over a longitude/latitude box."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: kilometres per degree, applied to both axes.
KM_PER_DEGREE = 111.0


def rows_for_box(
    lat_from: Column, lat_to: Column, lon_from: Column, lon_to: Column, columns: int
) -> Column:
    """How many rows of cells keep the cells square, given the number of columns.

    The ratio is rounded half to even. A box without width or height, one whose spans have opposite
    signs, and one so thin that its rows exceed the integers give NULL or less than 1: no cells.
    """
    width, height = lon_to - lon_from, lat_to - lat_from
    # Fixed formula: which results are rounded, and when, decides ties.
    km_across = F.cos(F.radians((lat_from + lat_to) / F.lit(2))) * F.lit(KM_PER_DEGREE)
    cell_height = (width / F.lit(columns)) * (km_across / F.lit(KM_PER_DEGREE))
    return F.rint(F.try_divide(height, cell_height)).try_cast("int")


def blocks(count: Column, size: int) -> Column:
    """0, size, 2 size .. below count; NULL when there are none."""
    return F.when(count >= 1, F.sequence(F.lit(0), count - 1, F.lit(size)))


def indexes(first: Column, count: Column, size: int) -> Column:
    """The up to ``size`` indexes from ``first`` that are below ``count``."""
    return F.sequence(first, first + F.least(count - first, F.lit(size)) - 1)


def cell_centre(start: Column, stop: Column, index: Column, count: Column) -> Column:
    """Midpoint of cell ``index`` between ``count + 1`` evenly spaced edges."""
    step = (stop - start) / count

    def edge(i: Column) -> Column:
        return F.when(i == count, stop).otherwise(start + i * step)

    return (edge(index) + edge(index + 1)) / F.lit(2)


def _round_scaled(value: Column, digits: int) -> Column:
    """``value * 10^digits`` rounded to whole from the exact binary value, ties to even.

    The product is itself rounded, so one that lands on .5 may stand for a value on either side of it. The
    lost part is recovered by splitting the value into two halves of at most 27 bits, whose products with
    the power of ten are exact.
    """
    scale = F.lit(float(10**digits))
    carry = value * F.lit(134217729.0)  # 2^27 + 1
    high = carry - (carry - value)
    low = value - high
    product = value * scale
    lost = (high * scale - product) + low * scale
    whole = F.floor(product).cast("double")
    on_tie = (product - whole) == F.lit(0.5)
    return (
        F.when(on_tie & (lost > 0), whole + 1)
        .when(on_tie & (lost < 0), whole)
        .otherwise(F.rint(product))
    )


def round_exact(value: Column, digits: int) -> Column:
    """Round the exact binary value, ties to even, as C and Python number formatting do."""
    return _round_scaled(value, digits) / F.lit(float(10**digits))


def fixed_text(value: Column, digits: int = 4) -> Column:
    """The number with a fixed count of decimals.

    Digits are taken from one whole number, which stays in generated code; only numbers that a long does
    not hold exactly, and those that are none, go to a formatter.
    """
    rounded = _round_scaled(value, digits)
    whole = F.abs(rounded).try_cast("bigint")
    scale = F.lit(10**digits)
    # A zero may be negative too, which only its text tells.
    is_negative = F.when(value == 0, value.cast("string").startswith("-")).otherwise(value < 0)
    fraction = F.lpad((whole % scale).cast("string"), digits, "0")
    text = F.concat(
        F.when(is_negative, "-").otherwise(""),
        F.floor(whole / scale).cast("string"), F.lit("."), fraction,
    )
    small = F.abs(rounded) < F.lit(float(2**52))
    return F.when(small, text).otherwise(
        F.format_string(f"%.{digits}f", rounded / F.lit(float(10**digits)))
    )
