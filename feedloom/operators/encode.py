"""Rows to log records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions import json_text
from feedloom.schemas import LOG_RECORD


def to_log(
    df: DataFrame,
    topic: str,
    document: list[Column | str] | None = None,
    *,
    text: Column | None = None,
    partition: Column | None = None,
    offset: Column | None = None,
    timestamp: Column | None = None,
) -> DataFrame:
    """Log records with one JSON document per row and no key.

    The document is built from ``document`` (all columns by default), or is ``text`` where the row
    already holds one. Without an explicit position a record's place is a hash of its value: it does
    not depend on how the rows are split over tasks. Equal documents share one until they are
    numbered. Records of a stream have none until they are written.
    """
    if text is None:
        fields = [F.col(c) if isinstance(c, str) else c for c in document or df.columns]
        value = json_text.encode(*fields)
    else:
        value = text.cast("binary")
    own_partition, own_offset = F.lit(0), F.xxhash64("_value")
    if df.isStreaming:
        own_partition, own_offset = F.lit(None), F.lit(None)
    parts = {
        "key": F.lit(None),
        "value": F.col("_value"),
        "topic": F.lit(topic),
        "partition": own_partition if partition is None else partition,
        "offset": own_offset if offset is None else offset,
        "timestamp": F.lit(None) if timestamp is None else timestamp,
        "timestampType": F.lit(0),
    }
    # Encoded once: the position is taken from it too.
    encoded = json_text.with_once(df, "_value", value) if offset is None else df.withColumn("_value", value)
    return encoded.select(
        *[parts[field.name].cast(field.dataType).alias(field.name) for field in LOG_RECORD]
    )


# So many places has the filter that tells which records may have an equal.
FILTER_PLACES = 1 << 20


def repeated_places(log: DataFrame) -> DataFrame:
    """Places in the log that several records share. Only the numbers cross the shuffle."""
    return log.groupBy("offset").agg(F.count("*").alias("_n")).where("_n > 1").select("offset")


def number_equal(log: DataFrame) -> DataFrame:
    """Records placed by their values, with the partition telling equal ones apart, from 0.

    Equal records are interchangeable, so a repeated publish gives the same places. Documents stay where
    they are unless their place occurs twice: a filter of so many hashes at most as ``FILTER_PLACES``
    says which ones may, and those alone are brought together. Streams stay as they are.
    """
    if log.isStreaming:
        return log
    place = F.pmod(F.col("offset"), F.lit(FILTER_PLACES))
    shared = F.broadcast(repeated_places(log).select(place.alias("_place")).distinct())
    placed = log.withColumn("_place", place)
    alone = placed.join(shared, "_place", "left_anti").withColumn("partition", F.lit(0))
    equal = Window.partitionBy("offset", "value").orderBy("offset")
    several = placed.join(shared, "_place", "left_semi").withColumn(
        "partition", F.row_number().over(equal) - 1
    )
    return alone.unionByName(several).select(*log.columns)
