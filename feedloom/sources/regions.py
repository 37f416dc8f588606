"""The region dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedloom.schemas import REGION

# Fixed value: the one active region, with the corners of its box.
ACTIVE_REGIONS = [
    ("Trollheimen", "3022", 62.969797, 8.684849, 62.588196, 9.704101),
]


def active_regions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ACTIVE_REGIONS, REGION)


def read_regions(
    spark: SparkSession, path: str, *, file_format: str = "parquet", **options: str
) -> DataFrame:
    """Regions from a table of any size, such as CSV with a header."""
    return spark.read.format(file_format).schema(REGION).options(**options).load(path)
