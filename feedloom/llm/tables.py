"""Tables of the given folder, and intermediate tables in the shared one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import scratch_dir


# A filter of hashed values has so many places at most, so it can go to every task whatever the input.
FILTER_PLACES = 1 << 20


# Rows of an Arrow batch between Spark and Python. Texts are long, and a batch is held several times.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Set the session's batch size for whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back; later steps start from there."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def likely(rows: DataFrame, wanted: DataFrame, *columns: str) -> DataFrame:
    """Rows that may have an equal in ``wanted``, by hashes of these columns; the others cannot.

    The set of hashes is bounded by FILTER_PLACES and is broadcast. It only spares rows the shuffle of
    the join that has to follow; where it is full, nothing is spared.
    """
    place = F.pmod(F.xxhash64(*columns), F.lit(FILTER_PLACES))
    held = F.broadcast(wanted.select(place.alias("_place")).distinct())
    return rows.withColumn("_place", place).join(held, "_place", "left_semi").drop("_place")
