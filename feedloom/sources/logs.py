"""The message log: Kafka topics, or Parquet files of the same record shape.

The Kafka kind needs Spark's Kafka package on the class path. The file kind needs nothing; every
publish goes to its own ``run=<label>`` directory under the topic's. It is written under a name that
readers pass over and gets its own name when it is complete. A published run is final.

A topic on Kafka knows no runs. Every record there says in its headers which run it belongs to and which
record of it it is, so that a run that was sent twice, in whole or in part, can be read once
(``streaming.once``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from feedloom.operators.encode import number_equal, repeated_places
from feedloom.schemas import LOG_RECORD
from feedloom.session import scratch_dir
from feedloom.sources import storage

# Bytes of log files per micro-batch.
MAX_BATCH_BYTES = 2**40

# The file source skips files that are this much older than the newest one it has seen. Copied and
# restored files keep their times, so the age must never matter.
ANY_AGE = {"maxFileAge": "36500d"}

FILE_LOG = StructType([*LOG_RECORD.fields, StructField("run", StringType())])


def topic_path(root: str, topic: str) -> str:
    return f"{root.rstrip('/')}/{topic}"


def run_path(root: str, topic: str, run: str) -> str:
    return f"{topic_path(root, topic)}/run={run}"


def kafka_options(
    topic: str,
    servers: str,
    *,
    starting: str = "earliest",
    min_partitions: int | None = None,
    max_offsets: int | None = None,
    headers: bool = False,
) -> dict[str, str]:
    """Options of the Kafka source.

    ``min_partitions`` splits the offset range of a large topic partition over several tasks;
    ``max_offsets`` bounds a micro-batch; ``headers`` reads the records' headers too.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if headers:
        options["includeHeaders"] = "true"
    return options


def read_kafka(
    spark: SparkSession, options: dict[str, str], *, streaming: bool = True
) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**options).load()


def read_files(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """The whole file log of a topic as a batch."""
    return spark.read.schema(FILE_LOG).parquet(topic_path(root, topic))


def stream_files(
    spark: SparkSession,
    root: str,
    topic: str,
    *,
    max_files: int | None = None,
    max_bytes: int = MAX_BATCH_BYTES,
) -> DataFrame:
    """The file log of a topic as a stream: first every file there is, then new ones.

    ``max_bytes``, or ``max_files`` in its place, bounds a micro-batch, so that a long backlog is
    worked off in steps that each commit.
    """
    reader = spark.readStream.schema(FILE_LOG).options(**ANY_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    else:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(topic_path(root, topic))


def is_published(spark: SparkSession, root: str, topic: str, run: str) -> bool:
    return storage.exists(spark, run_path(root, topic, run))


def _staged(log: DataFrame, staging: str, by_value: bool) -> str:
    """Write records, numbered where values repeat if they are placed by value; the folder they are in.

    Whether a place repeats is asked of the written column of places alone, and hardly ever does one.
    """
    spark = log.sparkSession
    log.write.mode("overwrite").parquet(staging)
    written = spark.read.schema(log.schema).parquet(staging)
    if not by_value or repeated_places(written).isEmpty():
        return staging
    numbered = f"{staging}-numbered"
    number_equal(written).write.mode("overwrite").parquet(numbered)
    storage.remove(spark, staging)
    return numbered


def publish_files(
    log: DataFrame, root: str, topic: str, run: str, *, by_value: bool = False
) -> None:
    """Write log records as one run of a topic.

    Records that are placed by their values (``by_value``) are numbered where values repeat. A run that
    has been published is refused: streams may have read it, and would read other files in its place as
    new ones. What is left of a publish that did not finish is written over.
    """
    spark = log.sparkSession
    if is_published(spark, root, topic, run):
        raise ValueError(f"run {run!r} of topic {topic!r} already exists")
    # Names with a leading underscore and no "=" are hidden from Spark's readers.
    staging = f"{topic_path(root, topic)}/_staging-{run.replace('=', '-')}"
    storage.put_in_place(spark, _staged(log, staging, by_value), run_path(root, topic, run))


# Names of the headers that a record on Kafka carries.
RUN_HEADER, RECORD_HEADER = "run", "record"


def record_name(partition: Column, value: Column) -> Column:
    """What a record of a run is called: its number among equal ones, and a digest of its value."""
    return F.concat_ws(":", partition.cast("string"), F.sha2(value, 256))


def kafka_records(log: DataFrame, run: str) -> DataFrame:
    """The columns of the Kafka sink: key, value, and headers that name the run and the record."""
    name = record_name(F.col("partition"), F.col("value"))
    headers = F.array(
        F.struct(F.lit(RUN_HEADER).alias("key"), F.lit(run).cast("binary").alias("value")),
        F.struct(F.lit(RECORD_HEADER).alias("key"), name.cast("binary").alias("value")),
    )
    return log.select("key", "value", headers.alias("headers"))


def publish_kafka(
    log: DataFrame, topic: str, servers: str, run: str, *, by_value: bool = True
) -> None:
    """Send a run to a topic. The records are staged first: a retried task sends what the first one did."""
    spark = log.sparkSession
    staging = _staged(log, scratch_dir(spark, "kafka"), by_value)
    staged = spark.read.schema(log.schema).parquet(staging)
    (
        kafka_records(staged, run)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
    storage.remove(spark, staging)


@dataclass(frozen=True)
class FileLog:
    """A log of Parquet files under ``root``.

    ``once_within`` reads the records of a run once, also where it was written twice, in whole or in part
    (``streaming.once``); needed only where others write runs into the folder, as ``publish`` refuses to.
    """

    root: str
    max_bytes: int = MAX_BATCH_BYTES
    once_within: str | None = None

    def publish(self, records: DataFrame, topic: str, run: str) -> None:
        publish_files(records, self.root, topic, run, by_value=True)

    def is_published(self, spark: SparkSession, topic: str, run: str) -> bool:
        return is_published(spark, self.root, topic, run)

    def stream(self, spark: SparkSession, topic: str) -> DataFrame:
        return stream_files(spark, self.root, topic, max_bytes=self.max_bytes)


@dataclass(frozen=True)
class KafkaLog:
    """Topics on Kafka. A publish that fails half way and is repeated sends records twice; with
    ``once_within`` they are read once (``streaming.once``)."""

    servers: str
    limits: dict[str, int | None] = field(default_factory=dict)
    once_within: str | None = None

    def publish(self, records: DataFrame, topic: str, run: str) -> None:
        publish_kafka(records, topic, self.servers, run)

    def is_published(self, spark: SparkSession, topic: str, run: str) -> bool:
        return False  # topics know no runs

    def stream(self, spark: SparkSession, topic: str) -> DataFrame:
        headers = {"headers": True} if self.once_within else {}
        return read_kafka(spark, kafka_options(topic, self.servers, **self.limits, **headers))


Log = FileLog | KafkaLog


def open_log(
    place: str, *, max_bytes: int | None = None, once_within: str | None = None, **limits: int | None
) -> Log:
    """A log from ``files:<root>`` or ``kafka:<servers>``."""
    kind, _, where = place.partition(":")
    if kind == "files" and where:
        return FileLog(where, max_bytes or MAX_BATCH_BYTES, once_within)
    if kind == "kafka" and where:
        return KafkaLog(where, limits, once_within)
    raise ValueError(f"unknown log {place!r}")
