"""Re-drives, reconciliation, drift and the counts of a run."""

import json

import pytest
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.__main__ import main
from feedloom.operators import drift
from feedloom.operators.encode import to_log
from feedloom.plans import daily, feeds
from feedloom.sources import logs, storage
from feedloom.streaming import reconcile, redrive, runs, sinks
from feedloom.streaming.progress import BatchCounts, Report

TOPIC = schemas.WEATHER_TOPIC


def _publish(spark, root, run, documents):
    rows = [(n, d if isinstance(d, str) else json.dumps(d)) for n, d in documents]
    table = spark.createDataFrame(rows, "n long, text string")
    log = to_log(table, TOPIC, text=F.col("text"), partition=F.lit(0), offset=F.col("n"))
    logs.publish_files(log, f"{root}/log", TOPIC, run)


def _ingest(spark, root, **options):
    return daily.ingest(
        spark, "weather", log=logs.FileLog(f"{root}/log"), sink=sinks.split_files(f"{root}/rows"),
        checkpoints=f"{root}/cp", mode="quarantine", **options,
    )


def _accepted(spark, root):
    return {r.id: r.elevation for r in redrive.read_accepted(spark, f"{root}/rows").collect()}


def test_redrive_brings_each_reject_home_once(spark, tmp_path, monkeypatch):
    """Elevations with a fraction are rejected as integers, and taken as doubles."""
    root = str(tmp_path)
    documents = [(n, {"region_id": str(n), "elevation": n + 0.5 if n % 2 else n}) for n in range(10)]
    _publish(spark, root, "a", [*documents, (10, "{"), (11, "")])
    counts = _ingest(spark, root, elevation="int_strict")
    assert (sum(c.read for c in counts), sum(c.rejected for c in counts)) == (12, 7)
    assert len(_accepted(spark, root)) == 5

    def again():
        return daily.redrive_rejects(spark, "weather", f"{root}/rows")

    with monkeypatch.context() as patch:
        patch.setattr(storage, "mark_finished", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            again()
    assert len(_accepted(spark, root)) == 5
    assert again() == 5
    later = sinks.read_files(spark, f"{root}/rows/_redriven")
    log = logs.read_files(spark, f"{root}/log", TOPIC)
    ids = {r.offset: r.id for r in feeds.weather_rows(log, with_position=True).collect()}
    assert {r.id: r.elevation for r in later.collect()} == {ids[n]: n + 0.5 for n in range(1, 10, 2)}
    assert again() == 0 and sinks.finished_batches(spark, f"{root}/rows/_redriven") == [0]
    waiting = redrive.waiting(spark, f"{root}/rows", ["id"]).collect()
    assert sorted(r.reject_reason for r in waiting) == ["empty", "malformed"]

    # Rejects that come later are tried by the next re-drive, and they alone.
    _publish(spark, root, "b", [(20, {"region_id": "20", "elevation": 20.25})])
    _ingest(spark, root, elevation="int_strict")
    main(["redrive", "weather", "--sink", f"files:{root}/rows"])
    assert again() == 0
    with pytest.raises(SystemExit):
        main(["redrive", "weather", "--sink", "table"])
    assert sinks.finished_batches(spark, f"{root}/rows/_redriven") == [0, 1]


def test_counts_of_a_run_are_those_of_its_sink(spark, tmp_path):
    root = str(tmp_path)
    for run, n in (("a", 6), ("b", 4)):
        documents = [(i, {"region_id": str(i)} if i % 3 else "[]") for i in range(n)]
        _publish(spark, root, run, documents)
        counts = _ingest(spark, root)
        rows = sinks.read_files(spark, f"{root}/rows")
        stored = {
            r.batch_id: BatchCounts(r.batch_id, r.n, r.bad)
            for r in rows.groupBy("batch_id").agg(
                F.count("*").alias("n"), F.count("reject_reason").alias("bad")
            ).collect()
        }
        told = {c.batch: c for c in counts if c.read}
        assert told and all(stored[b] == c for b, c in told.items())
        assert sum(c.read for c in told.values()) == n
        assert all(c.accepted == c.read - c.rejected for c in counts)


def test_listener_reports_a_running_query(spark, tmp_path):
    root = str(tmp_path)
    _publish(spark, root, "a", [(i, {"region_id": str(i)}) for i in range(5)])
    report = Report("on")
    rows = feeds.weather_rows(logs.stream_files(spark, f"{root}/log", TOPIC))
    query = runs.start(rows, sinks.files(f"{root}/rows"), name="on", checkpoints=f"{root}/cp", report=report)
    try:
        query.processAllAvailable()
        _publish(spark, root, "b", [(i, {"region_id": str(i)}) for i in range(3)])
        query.processAllAvailable()
        report.add(query)
    finally:
        query.stop()
        spark.streams.removeListener(report)
    assert [(c.batch, c.read, c.rejected) for c in report.batches if c.read] == [(0, 5, 0), (1, 3, 0)]


def test_reconcile_names_what_a_broken_batch_lost(spark, tmp_path):
    root = str(tmp_path)
    _publish(spark, root, "a", [(i, {"region_id": str(i)}) for i in range(20)])
    log = logs.read_files(spark, f"{root}/log", TOPIC)
    rows = feeds.weather_rows(log, with_position=True)
    kept = rows.where("NOT offset BETWEEN 4 AND 8 AND offset <> 15")
    other = rows.limit(1).withColumn("id", F.lit("none of ours"))
    found = reconcile.reconcile(log, kept.unionByName(kept.where("offset = 2")).unionByName(other))
    told = {(r.state, r.offset, r.n_rows) for r in found.collect()}
    lost = {("lost", n, 0) for n in (4, 5, 6, 7, 8, 15)}
    assert told == lost | {("doubled", 2, 2), ("unknown", None, 1)}
    ranges = reconcile.offset_ranges(found.where("state = 'lost'")).collect()
    assert sorted((r["first"], r["last"], r.n) for r in ranges) == [(4, 8, 5), (15, 15, 1)]
    assert reconcile.reconcile(log, rows).count() == 0
    through = spark.createDataFrame([(TOPIC, "a", 0, 6)], "topic string, run string, partition int, offset long")
    early = reconcile.reconcile(log, kept, through).where("state = 'lost'").collect()
    assert sorted(r.offset for r in early) == [4, 5, 6]
    plan = reconcile.reconcile(log, kept)._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in plan.splitlines() if "Relation" in line]
    assert len(scans) >= 2  # the log's side reads places only
    assert "value" not in found._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1].split("\n")[0]


def test_drift(spark):
    documents = [
        {"region_id": "1", "latitude": 1.5, "daily": {"rain_sum": [1, 2.5], "fog": [1]}, "new": {"a": 1}},
        {"region_id": 2, "latitude": 2, "daily": {"rain_sum": ["wet"], "time": [None]}},
        {"region_id": None, "latitude": "north", "daily": None}, {}, [], 5,
    ]
    rows = [(json.dumps(d),) for d in documents] + [("{",), (None,)]
    log = to_log(spark.createDataFrame(rows, "text string"), "w", text=F.col("text"))
    found = {r.path: (r.change, r.n_documents) for r in drift.drift(log, schemas.weather_wire()).collect()}
    assert found.pop("new") == ("unknown", 1)
    assert found.pop("daily.fog") == ("unknown", 1)
    assert found.pop("latitude") == ("type", 3)
    assert found.pop("daily.rain_sum") == ("type", 2)
    assert {change for change, _ in found.values()} == {"vanished"} and "region_id" not in found
    assert "daily.snowfall_sum" in found and "daily.time" not in found and "daily" not in found
    empty = drift.drift(log.limit(0), schemas.WARNING_WIRE).collect()
    assert {r.path for r in empty} == {f.name for f in schemas.WARNING_WIRE}


def test_drift_by_run(spark, tmp_path):
    root = str(tmp_path)
    _publish(spark, root, "a", [(1, {"latitude": 1.0})])
    _publish(spark, root, "b", [(1, {"latitude": 1.0, "more": 1})])
    log = logs.read_files(spark, f"{root}/log", TOPIC)
    found = drift.observed_members(log, schemas.weather_wire(), ["run"]).collect()
    assert sorted((r.run, r.path, r.n_documents) for r in found) == [
        ("a", "latitude", 1), ("b", "latitude", 1), ("b", "more", 1),
    ]
