"""Landed responses: what the fetcher got, one row per request, body as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedloom.schemas import LANDED_RESPONSE
from feedloom.sources.logs import ANY_AGE


def read_landed(spark: SparkSession, path: str, *, file_format: str = "parquet") -> DataFrame:
    return spark.read.format(file_format).schema(LANDED_RESPONSE).load(path)


def stream_landed(spark: SparkSession, path: str, *, file_format: str = "parquet") -> DataFrame:
    reader = spark.readStream.format(file_format).options(**ANY_AGE)
    return reader.schema(LANDED_RESPONSE).load(path)
