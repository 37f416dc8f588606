"""One day's run of a feed. The clock that calls it is somebody else's."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from feedloom import schemas
from feedloom.operators import parse, requests, responses
from feedloom.plans import feeds
from feedloom.sources import landed as landing
from feedloom.sources import logs, storage
from feedloom.streaming import once, redrive, runs
from feedloom.streaming.progress import BatchCounts
from feedloom.streaming.sinks import BatchSink, FormatSink


@dataclass(frozen=True)
class Feed:
    topic: str
    days_back: int
    requests: Callable[[DataFrame], DataFrame]
    documents: Callable[[DataFrame], DataFrame]
    log: Callable[[DataFrame], DataFrame]
    rows: Callable[..., DataFrame]
    namespace: str
    table: str


FEEDS = {
    "warnings": Feed(
        schemas.WARNING_TOPIC,
        requests.WARNING_DAYS_BACK,
        requests.warning_requests,
        responses.warning_documents,
        feeds.warning_log,
        feeds.warning_rows,
        schemas.WARNING_NAMESPACE,
        schemas.WARNING_TABLE,
    ),
    "weather": Feed(
        schemas.WEATHER_TOPIC,
        requests.WEATHER_DAYS_BACK,
        requests.weather_requests,
        responses.weather_documents,
        feeds.weather_log,
        feeds.weather_rows,
        schemas.WEATHER_NAMESPACE,
        schemas.WEATHER_TABLE,
    ),
}


def plan_requests(feed: str, regions: DataFrame, run_date: str) -> DataFrame:
    """The requests of a run on ``run_date``. ``plan_missing`` makes up for days that were missed."""
    spec = FEEDS[feed]
    return spec.requests(requests.add_run_day(regions, run_date, spec.days_back))


def plan_missing(
    spark: SparkSession, feed: str, regions: DataFrame, first: str, last: str, *, landed_root: str,
    retry: tuple[str, ...] = ("status",),
) -> DataFrame:
    """The requests of all runs from ``first`` to ``last`` whose answers have not landed.

    Whatever has landed under ``landed_root/<feed>`` counts, whether it went on or was rejected, but for
    the rejections in ``retry``. A region's day is complete with as many answers as it has requests.
    """
    spec = FEEDS[feed]
    days = requests.add_backfill_days(regions, F.lit(first), F.lit(last), spec.days_back)
    folder = f"{landed_root}/{feed}"
    if not storage.child_names(spark, folder):
        return spec.requests(days)
    judged = spec.documents(landing.read_landed(spark, folder))
    expected = requests.cells_of() if feed == "weather" else None
    answered = requests.answered_days(judged, retry)
    return spec.requests(requests.missing_days(days, answered, expected))


def publish_landed(
    feed: str, landed: DataFrame, *, log: logs.Log, rejects: str, run: str
) -> bool:
    """Landed responses of one run to the feed's log; those that cannot go on to ``rejects``.

    The log comes last: a run that fails before it is published can simply be repeated. A run that
    has been published is final: nothing is written then, and the answer is False.
    """
    spec, spark = FEEDS[feed], landed.sparkSession
    folder = f"{rejects}/{feed}"
    if storage.is_finished(spark, folder, run) or log.is_published(spark, spec.topic, run):
        return False
    # Each response is judged and parsed once; both kinds lie apart in the shared folder.
    staging = f"{folder}/_staging-{run.replace('=', '-')}"
    documents = spec.documents(landed)
    is_rejected = F.col(parse.REJECT_REASON).isNotNull()
    split = documents.withColumn("is_rejected", is_rejected).write.mode("overwrite")
    split.partitionBy("is_rejected").parquet(staging)
    judged = spark.read.schema(
        StructType([*documents.schema, StructField("is_rejected", BooleanType())])
    ).parquet(staging)
    refused = judged.where("is_rejected").drop("is_rejected")
    refused.write.mode("overwrite").parquet(f"{folder}/run={run}")
    accepted = judged.where("NOT is_rejected").drop("is_rejected")
    log.publish(spec.log(accepted), spec.topic, run)
    storage.mark_finished(spark, folder, run)
    storage.remove(spark, staging)
    return True


def read_rejects(spark: SparkSession, feed: str, rejects: str) -> DataFrame:
    """The responses of all published runs that could not go on, with their ``run``."""
    folder = f"{rejects}/{feed}"
    runs_ = [f"{folder}/run={name}" for name in sorted(storage.finished(spark, folder))]
    if not runs_:
        raise ValueError(f"no run of {folder} is finished")
    return spark.read.option("basePath", folder).parquet(*runs_)


def stream_log(spark: SparkSession, log: logs.Log, topic: str) -> DataFrame:
    """A topic as a stream, without the records that a repeated publish sent again if the log says so."""
    records = log.stream(spark, topic)
    return once.drop_repeats(records, log.once_within) if log.once_within else records


def ingest(
    spark: SparkSession,
    feed: str,
    *,
    log: logs.Log,
    sink: BatchSink | FormatSink,
    checkpoints: str,
    **row_options: str,
) -> list[BatchCounts]:
    """Append everything new in the feed's log to its sink; what each batch read, accepted and rejected."""
    spec = FEEDS[feed]
    rows = spec.rows(stream_log(spark, log, spec.topic), **row_options)
    return runs.run_to_end(rows, sink, name=f"ingest_{feed}", checkpoints=checkpoints)


def redrive_rejects(spark: SparkSession, feed: str, path: str, **row_options: str) -> int:
    """Read the rejected records of a sink of split files again; how many were accepted now."""
    spec = FEEDS[feed]
    options = {**row_options, "mode": "quarantine", "id_mode": "kept"}
    return redrive.redrive(spark, path, lambda log: spec.rows(log, **options), ["id"])


def run(
    spark: SparkSession,
    feed: str,
    run_date: str,
    *,
    landed_root: str,
    log: logs.Log,
    rejects: str,
    sink: BatchSink | FormatSink,
    checkpoints: str,
    **row_options: str,
) -> None:
    """Everything after the fetch for one run date: landed responses to log, log to sink.

    The responses of a run lie under ``landed_root/<feed>/run=<run_date>``. An error ends the run; a
    repeated one goes on where the last one stopped.
    """
    landed = landing.read_landed(spark, f"{landed_root}/{feed}/run={run_date}")
    publish_landed(feed, landed, log=log, rejects=rejects, run=run_date)
    ingest(spark, feed, log=log, sink=sink, checkpoints=checkpoints, **row_options)
