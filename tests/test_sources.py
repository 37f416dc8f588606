"""Sources and sinks that need no service, and the options of those that do."""

import pytest
from feedloom.functions.times import run_day
from feedloom.operators.encode import to_log
from feedloom.operators.latest import latest_by_key
from feedloom.schemas import LOG_RECORD, REGION
from feedloom.session import scratch_dir
from feedloom.sources import logs, regions
from feedloom.streaming import runs, sinks
from pyspark.sql import functions as F


def test_kafka_options():
    assert logs.kafka_options("avalanche_region_warning", "broker:29092") == {
        "kafka.bootstrap.servers": "broker:29092",
        "subscribe": "avalanche_region_warning",
        "startingOffsets": "earliest",
    }
    options = logs.kafka_options("t", "s", starting="latest", min_partitions=64, max_offsets=10)
    assert options["minPartitions"] == "64"
    assert options["maxOffsetsPerTrigger"] == "10"
    assert options["startingOffsets"] == "latest"


def test_cassandra_sink():
    sink = sinks.cassandra("spark_weather", "weather_forecast")
    assert sink.format == "org.apache.spark.sql.cassandra"
    assert sink.options == {"keyspace": "spark_weather", "table": "weather_forecast"}


def test_kafka_sink():
    sink = sinks.kafka("weather_forecast", "broker:29092")
    assert sink.format == "kafka"
    assert sink.options == {
        "kafka.bootstrap.servers": "broker:29092",
        "topic": "weather_forecast",
    }


def test_checkpoints_differ_by_query():
    assert runs.checkpoint_path("/c/", "a") != runs.checkpoint_path("/c/", "b")


def test_log_record_shape(spark):
    log = to_log(spark.range(10).repartition(3), "t")
    assert [(f.name, f.dataType) for f in log.schema] == [(f.name, f.dataType) for f in LOG_RECORD]
    positions = {(row["partition"], row["offset"]) for row in log.collect()}
    assert len(positions) == 10


def test_encoding_keeps_nulls_text_and_microseconds(spark):
    frame = spark.sql(
        "SELECT 'æ\"' AS a, CAST(NULL AS INT) AS b, "
        "TIMESTAMP_NTZ'2025-01-24 10:00:00.123456' AS c, TIMESTAMP'2025-01-24 10:00:00.000001Z' AS d"
    )
    value = to_log(frame, "t").collect()[0]["value"]
    assert value.decode() == (
        '{"a":"æ\\"","b":null,"c":"2025-01-24T10:00:00.123456","d":"2025-01-24T10:00:00.000001Z"}'
    )


def test_regions(spark, tmp_path):
    active = regions.active_regions(spark)
    assert active.schema == REGION and active.count() == 1
    active.write.csv(f"{tmp_path}/r", header=True)
    again = regions.read_regions(spark, f"{tmp_path}/r", file_format="csv", header="true")
    assert again.collect() == active.collect()


def test_run_day(spark):
    row = spark.range(1).select(run_day(F.lit("2025-03-01"), 1).alias("d")).collect()[0]
    assert row["d"] == "2025-02-28"


def test_scratch_is_under_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(base) and first != second


def test_latest_with_a_hot_key(spark):
    """A key with most of the rows is reduced in each task, below the shuffle."""
    frame = spark.range(100_000).select(
        F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    latest = latest_by_key(frame, ["k"], ["v"])
    assert latest.filter("k = 0").collect()[0]["v"] == 99_996
    assert latest.count() == 30_001
    plan = latest._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan[plan.index("Exchange") :]
    assert "row_number(), 1, Partial" in below_shuffle


def test_latest_orders_null_below_values(spark):
    frame = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (2, None, "c")], "k int, v int, t string")
    assert sorted(row["t"] for row in latest_by_key(frame, ["k"], ["v"]).collect()) == ["b", "c"]


@pytest.mark.parametrize("column", ["reject_reason IS NULL", "reject_reason IS NOT NULL"])
def test_filters_do_not_parse_twice(spark, column):
    from feedloom.operators import parse
    from feedloom.schemas import WARNING_WIRE

    log = to_log(spark.range(3), "t")
    rows = parse.parse_log(log, WARNING_WIRE, mode="quarantine").filter(column)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField(RegId") == 1
