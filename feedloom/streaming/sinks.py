"""Micro-batch sinks.

Each batch lands under its own number. A repeated batch replaces what an unfinished attempt left and
is passed over if the first attempt had finished, so a replay neither loses nor doubles rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.parse import REJECT_REASON
from feedloom.sources import logs, storage
from feedloom.streaming.tables import BATCH, DAY, PERIOD, location, quoted


@dataclass(frozen=True)
class BatchSink:
    """How to write one micro-batch, and which batch numbers the target holds already."""

    write: Callable[[DataFrame, int], None]
    batches: Callable[[SparkSession], list[int]]


@dataclass(frozen=True)
class FormatSink:
    """A sink that Spark knows by format name, such as a Cassandra table or a Kafka topic."""

    format: str
    options: dict[str, str] = field(default_factory=dict)


def files(path: str, partition_by: list[str] | None = None) -> BatchSink:
    """Parquet files under ``path/batch_id=N``. Read them back with ``read_files``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not storage.is_finished(spark, path, str(batch_id)):
            target = f"{path}/{BATCH}={batch_id}"
            batch.write.mode("overwrite").partitionBy(*partition_by or []).parquet(target)
            storage.mark_finished(spark, path, str(batch_id))

    return BatchSink(write, lambda spark: storage.numbered(spark, path, BATCH))


def finished_batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches whose write has finished, ascending."""
    return sorted(int(name) for name in storage.finished(spark, path))


def read_files(spark: SparkSession, path: str, batches: list[int] | None = None) -> DataFrame:
    """All finished batches of a ``files`` sink, or the given ones, with their ``batch_id``.

    The folder is read as one, however many batches there are; a batch whose write has not finished is
    left out by its partition.
    """
    if batches is None:
        done = set(finished_batches(spark, path))
        if not done:
            raise ValueError(f"no batch of {path} is finished")
        # Batches follow each other, so hardly any of those below the last one is unfinished.
        broken = [n for n in storage.numbered(spark, path, BATCH) if n < max(done) and n not in done]
        rows = spark.read.parquet(path).where(F.col(BATCH) <= max(done))
        if broken:
            rows = rows.where(~F.col(BATCH).isin(broken))
    else:
        if not batches:
            raise ValueError(f"no batch of {path} is finished")
        targets = [f"{path}/{BATCH}={batch}" for batch in batches]
        rows = spark.read.option("basePath", path).parquet(*targets)
    return rows.withColumn(BATCH, F.col(BATCH).cast("bigint"))


def split_files(path: str) -> BatchSink:
    """Files as above with accepted and rejected rows in separate partitions.

    Both kinds are written in one pass, so the log is read and parsed once. Read them back with
    ``read_split``.
    """
    inner = files(path, ["is_rejected"])

    def write(batch: DataFrame, batch_id: int) -> None:
        inner.write(
            batch.withColumn("is_rejected", F.col(REJECT_REASON).isNotNull()), batch_id
        )

    return BatchSink(write, inner.batches)


def read_split(spark: SparkSession, path: str, *, rejected: bool) -> DataFrame:
    rows = read_files(spark, path)
    kept = rows.filter(F.col("is_rejected") == F.lit(rejected))
    return kept.drop("is_rejected", BATCH)


# Replaces the partitions that a write has rows for, and no others.
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@contextmanager
def _overwriting_partitions(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_OVERWRITE_MODE)
    spark.conf.set(_OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(_OVERWRITE_MODE, before)


def table(name: str, day_of: str | None = None, period: str = "month") -> BatchSink:
    """A catalog table made by ``create_table``; a repeated batch replaces its partitions.

    ``day_of`` is the column by whose day the table is laid out besides, if it is: in partitions of a
    ``period`` (``day``, ``month``, ``year``), and sorted by day in their files, so that a query for a day
    reads the pages that hold it. A batch's rows are brought together by period, which gives a file for
    each period of a batch and not one from every task. Spark splits a period that is larger than an
    advisory partition over several tasks and files, a hot day too, and lets a task write several small
    ones.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = location(spark, name)
        if storage.is_finished(spark, folder, str(batch_id)):
            return
        rows = batch.withColumn(BATCH, F.lit(int(batch_id)).cast("bigint"))
        if day_of:
            day = F.to_date(day_of)
            first = day if period == "day" else F.trunc(day, period)
            rows = rows.withColumn(DAY, day).withColumn(PERIOD, first)
            # The order that the partitioned write asks for, and the day behind it.
            rows = rows.hint("rebalance", F.col(PERIOD)).sortWithinPartitions(PERIOD, BATCH, DAY)
        columns = [quoted(c) for c in spark.table(name).columns]
        with _overwriting_partitions(spark):
            spark.sql(
                f"INSERT OVERWRITE TABLE {quoted(name)} SELECT {', '.join(columns)} FROM {{batch}}",
                batch=rows,
            )
        storage.mark_finished(spark, folder, str(batch_id))

    return BatchSink(write, lambda spark: finished_batches(spark, location(spark, name)))


def file_log(root: str, topic: str, records: Callable[[DataFrame], DataFrame]) -> BatchSink:
    """A topic of the file log, one run per batch; ``records`` makes log records of a batch."""
    prefix = "run=batch-"

    def write(batch: DataFrame, batch_id: int) -> None:
        run = f"batch-{batch_id}"
        if not logs.is_published(batch.sparkSession, root, topic, run):
            logs.publish_files(records(batch), root, topic, run, by_value=True)

    def batches(spark: SparkSession) -> list[int]:
        names = storage.child_names(spark, logs.topic_path(root, topic))
        return sorted(int(name[len(prefix) :]) for name in names if name.startswith(prefix))

    return BatchSink(write, batches)


def kafka(topic: str, servers: str) -> FormatSink:
    """A Kafka topic, fed from log records; needs Spark's Kafka package on the class path."""
    return FormatSink("kafka", {"kafka.bootstrap.servers": servers, "topic": topic})


def cassandra(keyspace: str, table_name: str) -> FormatSink:
    """A Cassandra table; needs the connector package on the class path."""
    return FormatSink(
        "org.apache.spark.sql.cassandra", {"keyspace": keyspace, "table": table_name}
    )
