"""Days that were missed, and all days of a document."""

import json

import pytest
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.__main__ import main
from feedloom.operators import requests, shape
from feedloom.operators.encode import to_log
from feedloom.plans import daily, feeds
from feedloom.sources import regions


def _landed(spark, path, rows):
    full = [(region, "T", day, status, body) for region, day, status, body in rows]
    spark.createDataFrame(full, schemas.LANDED_RESPONSE).write.mode("append").parquet(path)


def _days(df):
    return sorted({(r.region_id, r.day) for r in df.collect()})


def test_missing_warnings(spark, tmp_path):
    root, good = str(tmp_path), '[{"RegId":1}]'
    _landed(spark, f"{root}/warnings/run=a", [("3022", "2025-01-01", 200, good), ("3022", "2025-01-02", 500, good)])
    _landed(spark, f"{root}/warnings/run=b", [("3022", "2025-01-03", 200, "[]"), ("9", "2025-01-04", 200, good)])
    _landed(spark, f"{root}/warnings/run=c", [(None, "2025-01-04", 200, good), ("3022", None, 200, good)])
    _landed(spark, f"{root}/warnings/run=d", [("3022", "2025-01-01", 500, None)])

    def plan(**options):
        places = regions.active_regions(spark)
        return daily.plan_missing(
            spark, "warnings", places, "2025-01-01", "2025-01-05", landed_root=root, **options
        )

    expected = [("3022", f"2025-01-0{d}") for d in (2, 4, 5)]
    assert _days(plan()) == expected
    assert _days(plan(retry=())) == expected[1:]
    assert _days(plan(retry=("status", "empty_array"))) == [
        ("3022", f"2025-01-0{d}") for d in (2, 3, 4, 5)
    ]
    assert plan().columns == daily.plan_requests("warnings", regions.active_regions(spark), "2025-01-01").columns


def test_weather_day_needs_all_its_cells(spark, tmp_path):
    """A day of the weather feed is complete with an answer for each cell; else all are asked again."""
    root, places = str(tmp_path), regions.active_regions(spark)
    cells = places.select(requests.cells_of().alias("n")).first().n
    assert cells == daily.plan_requests("weather", places, "2025-01-02").count()
    rows = [("3022", "2025-01-01", 200, "{}")] * cells + [("3022", "2025-01-02", 200, "{}")] * (cells - 1)
    rows += [("3022", "2025-01-03", 200, "{}")] * (cells - 1) + [("3022", "2025-01-03", 500, None)]
    _landed(spark, f"{root}/weather/run=a", rows)
    found = daily.plan_missing(spark, "weather", places, "2025-01-02", "2025-01-05", landed_root=root)
    assert _days(found) == [("3022", f"2025-01-0{d}") for d in (2, 3, 4)]
    assert found.count() == 3 * cells


def test_degenerate_boxes_are_never_missing(spark, tmp_path):
    flat = spark.createDataFrame([("F", "1", 60.0, 8.0, 60.0, 9.0)], schemas.REGION)
    assert flat.select(requests.cells_of().alias("n")).first().n == 0
    _landed(spark, f"{tmp_path}/weather/run=a", [("2", "2025-01-01", 200, "{}")])
    found = daily.plan_missing(spark, "weather", flat, "2025-01-01", "2025-01-03", landed_root=str(tmp_path))
    assert found.count() == 0


def test_nothing_has_landed(spark, tmp_path):
    main(
        ["missing", "warnings", "--first", "2025-01-01", "--last", "2025-01-03"]
        + ["--landed-root", f"{tmp_path}/none", "--out", f"{tmp_path}/out"]
    )
    assert _days(spark.read.parquet(f"{tmp_path}/out")) == [("3022", f"2025-01-0{d}") for d in (1, 2, 3)]


def test_days_are_compared_before_cells_are_made(spark, tmp_path):
    _landed(spark, f"{tmp_path}/weather/run=a", [("3022", "2025-01-01", 200, "{}")])
    found = daily.plan_missing(
        spark, "weather", regions.active_regions(spark), "2025-01-01", "2025-01-03", landed_root=str(tmp_path)
    )
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "Cartesian" not in plan
    assert plan.index("cell_row") < plan.index("LeftAnti")  # the join stands below


DAY = {key: [f"2025-01-0{i}" if key == "time" else i for i in (1, 2, 3)] for key in schemas.DAILY_KEYS}


def _weather(spark, documents):
    rows = [(i, json.dumps({"region_id": "1", **d})) for i, d in enumerate(documents)]
    table = spark.createDataFrame(rows, "n long, text string")
    return to_log(table, "w", text=F.col("text"), partition=F.lit(0), offset=F.col("n"))


def test_all_days(spark):
    documents = [
        {"daily": DAY},
        {"daily": DAY | {"rain_sum": [1.5], "snowfall_sum": None, "time": DAY["time"] + ["2025-01-04"]}},
        {"daily": {k: [] for k in DAY}}, {"daily": {}}, {"daily": None}, {},
        {"daily": {"time": ["2025-01-01", "none"], "weathercode": [None, 7]}},
    ]
    log = _weather(spark, documents)
    rows = feeds.weather_rows(log, days="all", with_position=True).collect()
    by_document = {n: sorted((r for r in rows if r.offset == n), key=lambda r: r.day_number) for n in range(7)}
    assert [len(by_document[n]) for n in range(7)] == [3, 4, 1, 1, 1, 1, 2]
    assert [r.day_number for r in by_document[1]] == [1, 2, 3, 4]
    assert [r.rain_sum for r in by_document[1]] == [1.5, None, None, None]
    others = [k for k in schemas.DAILY_KEYS if k != "time"]
    assert {r.day_fault for r in by_document[0]} == {None}
    assert {r.day_fault for r in by_document[1]} == {"short:" + ",".join(others)}
    assert {r.day_fault for n in (2, 3, 4, 5) for r in by_document[n]} == {"no_days"}
    assert [(r.weathercode, r.time is None) for r in by_document[6]] == [(None, False), (7, True)]
    assert len({r.id for r in rows}) == len(rows)

    first = {r.id: r for r in feeds.weather_rows(log).collect()}
    assert len(first) == 7
    for r in rows:
        if r.day_number == 1:
            assert all(r[c] == first[r.id][c] for c in first[r.id].asDict())


def test_days_of_quarantined_records(spark):
    bad = spark.createDataFrame([(9, "{")], "n long, text string")
    log = _weather(spark, [{"daily": DAY}]).unionByName(
        to_log(bad, "w", text=F.col("text"), partition=F.lit(0), offset=F.col("n"))
    )
    found = feeds.weather_rows(log, days="all", mode="quarantine").collect()
    assert sorted((r.reject_reason or "", r.day_number) for r in found) == [
        ("", 1), ("", 2), ("", 3), ("malformed", 1),
    ]
    with pytest.raises(ValueError, match="days"):
        feeds.weather_rows(log, days="second")
    assert shape.DAY_FAULT not in feeds.weather_rows(log).columns
