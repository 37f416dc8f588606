"""Records that were put aside are tried again, each at most once with success.

A sink of split files holds the text of every rejected record beside its place in the log. After the
reader has been corrected, ``redrive`` parses these texts again. What is accepted now lands as one further
batch in a folder of its own, beside the rejects, which stay as they are; what had been accepted by an
earlier attempt is told by its key and left alone, so a repeated re-drive adds nothing. A re-drive that
broke off has not finished its batch and is simply repeated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators import parse
from feedloom.sources import storage
from feedloom.streaming import sinks
from feedloom.streaming.tables import BATCH

_FOLDER = "_redriven"  # hidden from those who read the sink


def _folder(path: str) -> str:
    return f"{path}/{_FOLDER}"


def waiting(spark: SparkSession, path: str, key: list[str]) -> DataFrame:
    """Rejected records that no re-drive has brought home yet: the key, ``value`` and ``reject_reason``."""
    rejected = sinks.read_split(spark, path, rejected=True).select(
        *key, F.col(parse.RAW).cast("binary").alias("value"), parse.REJECT_REASON
    )
    if not sinks.finished_batches(spark, _folder(path)):
        return rejected
    return rejected.join(sinks.read_files(spark, _folder(path)).select(*key), key, "left_anti")


def redrive(
    spark: SparkSession, path: str, rows_of: Callable[[DataFrame], DataFrame], key: list[str]
) -> int:
    """Parse what is waiting once more and keep what is accepted now; how many rows that were.

    ``rows_of`` makes rows with ``reject_reason`` of log records (the key columns and ``value``), and has
    to keep the key columns. A key names a record: its id, or its place in the log.
    """
    texts = waiting(spark, path, key).where(F.col("value").isNotNull()).drop(parse.REJECT_REASON)
    # A replayed batch may have put a record aside twice.
    rows = parse.accepted(rows_of(texts.dropDuplicates(key)))
    done = sinks.finished_batches(spark, _folder(path))
    batch = max(done, default=-1) + 1
    target = f"{_folder(path)}/{BATCH}={batch}"
    rows.write.mode("overwrite").parquet(target)
    count = spark.read.schema(rows.schema).parquet(target).count()
    if count:
        storage.mark_finished(spark, _folder(path), str(batch))
    return count


def read_accepted(spark: SparkSession, path: str) -> DataFrame:
    """All accepted rows of a sink of split files: those of its batches and those of its re-drives."""
    first = sinks.read_split(spark, path, rejected=False).drop(parse.REJECT_REASON, parse.RAW)
    if not sinks.finished_batches(spark, _folder(path)):
        return first
    later = sinks.read_files(spark, _folder(path)).drop(BATCH)
    return first.unionByName(later)
