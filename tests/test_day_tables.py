"""Catalog tables laid out by day: few files, split hot days, replays."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from feedloom.streaming import sinks, tables

SCHEMA = StructType(
    [StructField("id", LongType()), StructField("at", TimestampType()), StructField("text", StringType())]
)


@pytest.fixture
def name(spark, tmp_path, request):
    tables.create_namespace(spark, "days", str(tmp_path / "days"))
    name = f"days.{request.node.name.split('[')[0]}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    tables.create_table(spark, name, SCHEMA, "at")
    return name


def _rows(spark, n: int, days: int, tasks: int = 8):
    """Rows of ``days`` days from the first of January, every day in every task."""
    at = F.expr(f"timestamp '2024-01-01 05:00:00' + make_interval(0, 0, 0, CAST(id % {days} AS INT))")
    text = F.sha2(F.col("id").cast("string"), 256)
    return spark.range(n).repartition(tasks).select("id", at.alias("at"), text.alias("text"))


def _files(spark, name: str) -> Counter:
    """Files by period; each file holds its days in order."""
    found = Counter()
    for path in spark.table(name).inputFiles():
        days = [r.day for r in spark.read.parquet(path).select("day").collect()]
        assert days == sorted(days)
        found[path.split("/period=")[1][:10]] += 1
    return found


@pytest.mark.parametrize("period, files", [("day", 40), ("month", 2), ("year", 1)])
def test_a_file_for_each_period_of_a_batch(spark, name, period, files):
    sink = sinks.table(name, "at", period)
    sink.write(_rows(spark, 2000, 40), 0)
    assert len(_files(spark, name)) == files and set(_files(spark, name).values()) == {1}
    stored = spark.table(name)
    assert stored.columns == ["id", "at", "text", "day", "period", "batch_id"]
    first = {"day": "day", "month": "trunc(day, 'MM')", "year": "trunc(day, 'YY')"}[period]
    assert stored.where(f"day = to_date(at) AND period = {first}").count() == 2000


def test_hot_day_is_split(spark, name):
    """A day beyond the advisory size of a partition is written by several tasks."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    hot = _rows(spark, 60_000, 1).unionByName(_rows(spark, 600, 90))
    spark.conf.set(size, "256k")
    try:
        sinks.table(name, "at").write(hot, 0)
    finally:
        spark.conf.unset(size)
    files = _files(spark, name)
    assert files["2024-01-01"] >= 4
    assert all(n == 1 for period, n in files.items() if period != "2024-01-01")
    assert spark.table(name).count() == 60_600


def test_replays_and_later_batches(spark, name):
    sink = sinks.table(name, "at")
    for batch, n in ((0, 300), (0, 300), (1, 50)):
        sink.write(_rows(spark, n, 60), batch)
    assert sink.batches(spark) == [0, 1]
    counts = spark.table(name).groupBy("batch_id").count().collect()
    assert {r.batch_id: r["count"] for r in counts} == {0: 300, 1: 50}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "STATIC"


def test_unfinished_batch_is_replaced(spark, name, monkeypatch):
    """A batch that was written but not noted as finished is written again in the same place."""
    sink = sinks.table(name, "at")
    with monkeypatch.context() as patch:
        patch.setattr(sinks.storage, "mark_finished", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sink.write(_rows(spark, 300, 60), 0)
    assert sink.batches(spark) == []
    sink.write(_rows(spark, 300, 60), 0)
    assert spark.table(name).count() == 300 and sink.batches(spark) == [0]


def test_rows_without_a_day(spark, name):
    rows = _rows(spark, 10, 2).withColumn("at", F.when(F.col("id") > 4, F.col("at")))
    sinks.table(name, "at").write(rows, 0)
    assert spark.table(name).where("period IS NULL AND day IS NULL").count() == 5
    sinks.table(name, "at").write(rows.limit(0), 1)
    assert spark.table(name).count() == 10


def test_files_are_read_as_one_folder(spark, tmp_path):
    """The plan of a read names no batch but unfinished ones."""
    path, sink = str(tmp_path / "rows"), sinks.files(str(tmp_path / "rows"))
    for batch in range(6):
        sink.write(spark.range(batch + 1), batch)
    (tmp_path / "rows" / "_finished" / "2").unlink()
    found = sinks.read_files(spark, path)
    assert sorted(r.batch_id for r in found.select("batch_id").distinct().collect()) == [0, 1, 3, 4, 5]
    assert found.count() == 21 - 3
    (tmp_path / "rows" / "_finished" / "5").unlink()
    assert sinks.read_files(spark, path).count() == 21 - 3 - 6
