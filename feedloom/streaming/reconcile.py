"""The log against a sink: what a batch lost, doubled or made up.

Ids follow from a record's place in the log, so the two sides are compared by id. Of the log only the
places are read, of the sink only the ids; documents stay where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators import shape

LOST, DOUBLED, UNKNOWN = "lost", "doubled", "unknown"


def reconcile(log: DataFrame, rows: DataFrame, through: DataFrame | None = None) -> DataFrame:
    """Places of the log and ids of the sink that do not agree, each with its ``state``.

    ``lost``: a record of the log without a row. ``doubled``: a record with several rows (``n_rows``).
    ``unknown``: an id that no record has. ``through`` bounds the records that are expected by now: for
    each partition (and whatever other columns of the place it has) the last ``offset`` that was read;
    partitions that it does not name are not expected.
    """
    place = shape.position_columns(log)
    expected = log.select(*place)
    if through is not None:
        names = [c for c in through.columns if c != "offset"]
        bound = through.withColumnRenamed("offset", "_last")
        expected = expected.join(bound, names).where(F.col("offset") <= F.col("_last")).drop("_last")
    known = shape.add_id(expected, "stable", place)
    found = rows.groupBy("id").agg(F.count("*").alias("n_rows"))
    state = (
        F.when(F.col("n_rows").isNull(), LOST)
        .when(F.col("offset").isNull(), UNKNOWN)
        .when(F.col("n_rows") > 1, DOUBLED)
    )
    both = known.join(found, "id", "full")
    told = both.withColumn("state", state).where(F.col("state").isNotNull())
    return told.select("state", *place, "id", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def offset_ranges(places: DataFrame) -> DataFrame:
    """Places as ranges of consecutive offsets: ``first``, ``last`` and ``n`` for each.

    A lost batch is a few ranges, however many records it had. Runs are found by the difference between
    an offset and its rank, so nothing but a partition's own places is brought together.
    """
    names = [c for c in shape.position_columns(places) if c != "offset"]
    in_order = Window.partitionBy(*names).orderBy("offset")
    numbered = places.select(*names, "offset").distinct().withColumn(
        "_run", F.col("offset") - F.row_number().over(in_order)
    )
    return numbered.groupBy(*names, "_run").agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.count("*").alias("n")
    ).drop("_run")
