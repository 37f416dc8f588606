"""Renames, first-of-day picks, ids and sink types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedloom.functions.arrays import first_item
from feedloom.functions.ids import random_id, stable_id
from feedloom.functions.times import to_instant

POSITION = ["topic", "run", "partition", "offset"]


def position_columns(df: DataFrame) -> list[str]:
    """The columns that say where a record sits in its log."""
    return [name for name in POSITION if name in df.columns]


def add_id(df: DataFrame, mode: str = "stable", position: list[str] | None = None) -> DataFrame:
    """Add ``id`` as the last column.

    ``stable`` derives it from the record's position; ``random`` draws a new one per row; ``kept`` leaves
    the id that the record came with.
    """
    if mode == "kept":
        return df.select(*[c for c in df.columns if c != "id"], "id")
    if mode == "random":
        return df.withColumn("id", random_id())
    if mode != "stable":
        raise ValueError(f"id mode must be 'stable', 'random' or 'kept', not {mode!r}")
    names = position or position_columns(df)
    if "offset" not in names:
        raise ValueError("a stable id needs the record's position, at least its offset")
    return df.withColumn("id", stable_id(*[F.col(name) for name in names]))


def rename(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(renames)


def pick_first_day(df: DataFrame, array_types: StructType, struct: str = "daily") -> DataFrame:
    """Replace a struct of parallel daily arrays by the first item of each."""
    others = [name for name in df.columns if name != struct]
    firsts = [
        first_item(F.col(f"{struct}.{field.name}"))
        .cast(field.dataType.elementType)
        .alias(field.name)
        for field in array_types
    ]
    return df.select(*others, *firsts)


DAY_NUMBER, DAY_FAULT = "day_number", "day_fault"


def explode_days(df: DataFrame, array_types: StructType, struct: str = "daily") -> DataFrame:
    """Replace a struct of parallel daily arrays by one row for each day.

    Adds ``day_number``, from 1, and ``day_fault``. The arrays are aligned by place. Where they differ in
    length there are as many days as the longest has, items that an array lacks are NULL, and the fault
    names the arrays that are too short or missing: ``short:<name>,<name>``. A document without any day
    gives one row, its first, with the fault ``no_days``; so the first day is always the row that
    ``pick_first_day`` gives.
    """
    others = [name for name in df.columns if name != struct]
    names = [field.name for field in array_types]
    sizes = [F.greatest(F.size(F.col(f"{struct}.{name}")), F.lit(0)) for name in names]
    sizes = [F.coalesce(size, F.lit(0)) for size in sizes]
    longest = F.greatest(*sizes)
    short = F.concat_ws(
        ",", *[F.when(size < longest, F.lit(name)) for name, size in zip(names, sizes)]
    )
    fault = F.when(longest == 0, "no_days").when(short != "", F.concat(F.lit("short:"), short))
    arrays = [F.col(f"{struct}.{name}").alias(name) for name in names]
    # A missing array would make the whole of zip NULL.
    filled = [F.coalesce(a, F.array().cast(f.dataType)) for a, f in zip(arrays, array_types)]
    days = df.select(
        *others, fault.alias(DAY_FAULT),
        F.posexplode_outer(F.arrays_zip(*[a.alias(n) for a, n in zip(filled, names)])).alias(
            "_place", "_day"
        ),
    )
    items = [
        F.col(f"_day.{field.name}").cast(field.dataType.elementType).alias(field.name)
        for field in array_types
    ]
    number = (F.coalesce(F.col("_place"), F.lit(0)) + 1).alias(DAY_NUMBER)
    return days.select(*others, *items, number, DAY_FAULT)


def add_day_id(df: DataFrame, mode: str = "stable", position: list[str] | None = None) -> DataFrame:
    """``add_id`` for rows of days: the first day has the id of its record, later ones have their own."""
    if mode != "stable":
        return add_id(df, mode, position)
    names = position or position_columns(df)
    later = stable_id(*[F.col(name) for name in [*names, DAY_NUMBER]])
    first = add_id(df, mode, names)
    return first.withColumn("id", F.when(F.col(DAY_NUMBER) == 1, F.col("id")).otherwise(later))


def coerce_to_sink(
    df: DataFrame, sink: StructType, *, source_tz: str | None = None, extra: list[str] | None = None
) -> DataFrame:
    """Exactly the sink's columns with the sink's types; text that is no timestamp becomes NULL."""
    types = {field.name: field.dataType for field in df.schema}
    columns = []
    for field in sink:
        column, has, wants = F.col(field.name), types[field.name], field.dataType
        if has.typeName() == "string" and wants.typeName() == "timestamp":
            column = to_instant(column, source_tz)
        elif has != wants:
            column = column.try_cast(wants)
        columns.append(column.alias(field.name))
    return df.select(*columns, *(extra or []))
