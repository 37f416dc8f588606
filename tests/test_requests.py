"""Request rows, the grid and its number formatting."""

import pytest
from feedloom.functions.grid import fixed_text
from feedloom.operators import requests
from feedloom.plans import daily
from feedloom.schemas import REGION
from feedloom.sources import regions
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F


def test_active_region_grid(spark):
    rows = daily.plan_requests("weather", regions.active_regions(spark), "2025-01-25")
    cells = rows.orderBy("cell_row", "cell_col").collect()
    lats = ["62.9221", "62.8267", "62.7313", "62.6359"]
    lons = ["9.6022", "9.3983", "9.1945", "8.9906", "8.7868"]
    assert [row["url"] for row in cells] == [
        f"https://archive-api.open-meteo.com/v1/archive?latitude={lat}&longitude={lon}"
        "&start_date=2025-01-24&end_date=2025-01-24"
        "&daily=weathercode,temperature_2m_max,temperature_2m_min,temperature_2m_mean,rain_sum,"
        "snowfall_sum,precipitation_hours,windspeed_10m_max,windgusts_10m_max,"
        "winddirection_10m_dominant&timezone=Europe%2FBerlin"
        for lat in lats
        for lon in lons
    ]


def test_warning_request(spark):
    rows = daily.plan_requests("warnings", regions.active_regions(spark), "2025-01-25").collect()
    assert [row["url"] for row in rows] == [
        "https://api01.nve.no/hydrology/forecast/avalanche/v6.2.1/api/AvalancheWarningByRegion/"
        "Simple/3022/1/2025-01-25/2025-01-25"
    ]


BOXES = {
    "one_row": ((60.1, 8.0, 60.0, 9.0), 5),
    "opposite_signs": ((60.0, 8.0, 60.5, 9.0), 0),
    "zero_width": ((60.5, 8.0, 60.0, 8.0), 0),
    "zero_height": ((60.0, 8.0, 60.0, 9.0), 0),
    "very_flat": ((60.001, 8.0, 60.0, 9.0), 0),
    # Around the equator the ratio is exact: 5 * 0.5 and 5 * 0.3 round half to even.
    "tie_down": ((0.5, 0.0, -0.5, 2.0), 10),
    "tie_up": ((0.75, 0.0, -0.75, 5.0), 10),
    "no_edges": ((None, 8.0, 60.0, 9.0), 0),
    "not_a_number": ((float("nan"), 8.0, 60.0, 9.0), 0),
}


@pytest.mark.parametrize("case", BOXES)
def test_box_cells(spark, case):
    box, expected = BOXES[case]
    frame = spark.createDataFrame([("n", "1", *box)], REGION)
    assert requests.grid_cells(frame).count() == expected


def test_backfill_days(spark):
    frame = spark.createDataFrame(
        [("a", "2025-01-30", "2025-02-01"), ("b", "2025-02-01", "2025-01-30")],
        "region_id string, first string, last string",
    )
    days = requests.add_backfill_days(frame, F.col("first"), F.col("last"), days_back=1)
    assert sorted((row["region_id"], row["day"]) for row in days.collect()) == [
        ("a", "2025-01-29"),
        ("a", "2025-01-30"),
        ("a", "2025-01-31"),
    ]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.one_of(
            st.floats(-1000, 1000),
            st.integers(-9_000_000, 9_000_000).map(lambda n: (2 * n + 1) / 20000),
            st.integers(-9_000_000, 9_000_000).map(lambda n: n / 10000),
        ),
        min_size=500,
        max_size=1000,
    )
)
def test_fixed_text_rounds_the_exact_value(spark, values):
    frame = spark.createDataFrame([(value,) for value in values], "x double").repartition(1)
    rows = frame.select("x", fixed_text(F.col("x")).alias("text")).collect()
    assert [row["text"] for row in rows] == [f"{row['x']:.4f}" for row in rows]
