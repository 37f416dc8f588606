"""Sink namespaces and tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

BATCH = "batch_id"
DAY = "day"
PERIOD = "period"


def quoted(name: str) -> str:
    """A dotted name with every part in backticks."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def create_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(namespace)}{where}")


def create_table(
    spark: SparkSession, table: str, schema: StructType, day_of: str | None = None
) -> None:
    """Create the table if it is absent: the sink's columns, partitioned by micro-batch.

    With ``day_of``, a timestamp column, the table has its ``day`` as a further column, and is partitioned
    by the period around it first (its first day) and by batch below that.
    """
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    days, by = "", BATCH
    if day_of:
        days, by = f", {DAY} DATE, {PERIOD} DATE", f"{PERIOD}, {BATCH}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({columns}{days}, {BATCH} BIGINT) "
        f"USING parquet PARTITIONED BY ({by})"
    )


def location(spark: SparkSession, table: str) -> str:
    """The folder of a table."""
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").where("col_name = 'Location'")
    return told.first().data_type
