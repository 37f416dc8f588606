"""Request rows: which addresses to fetch for which region, cell and day. Nothing is fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import grid
from feedloom.functions.times import run_day
from feedloom.operators.parse import REJECT_REASON
from feedloom.schemas import DAILY_VARIABLES

# The two public endpoints and their fixed parameters.
WARNING_ENDPOINT = (
    "https://api01.nve.no/hydrology/forecast/avalanche/v6.2.1/api/AvalancheWarningByRegion/Simple"
)
WARNING_LANGUAGE_KEY = "1"
WEATHER_ENDPOINT = "https://archive-api.open-meteo.com/v1/archive"
WEATHER_TIMEZONE = "Europe%2FBerlin"

# Fixed value: grid columns per region.
GRID_COLUMNS = 5

# Rows of cells that one task makes at a time.
ROW_BLOCK = 4096

# Days between the run and the day it asks for.
WARNING_DAYS_BACK = 0
WEATHER_DAYS_BACK = 1


def add_run_day(df: DataFrame, run_date: str, days_back: int = 0) -> DataFrame:
    """One ``day`` per row, the one a run on ``run_date`` asks for."""
    return df.withColumn("day", run_day(F.lit(run_date), days_back))


def add_backfill_days(df: DataFrame, first: Column, last: Column, days_back: int = 0) -> DataFrame:
    """One row per run date from ``first`` to ``last``, each with the day that run asks for."""
    first, last = first.cast("date"), last.cast("date")
    # sequence() counts down when the bounds are swapped.
    dates = F.when(first <= last, F.sequence(first, last))
    with_date = df.select("*", F.explode(dates).alias("_run_date"))
    return with_date.withColumn("day", run_day(F.col("_run_date"), days_back)).drop("_run_date")


def answered_days(responses: DataFrame, retry: tuple[str, ...] = ()) -> DataFrame:
    """``(region_id, day, answers)``: how many responses count for a region and the day they are for.

    ``responses`` are landed ones; where they have been judged, those that were rejected for a reason in
    ``retry`` do not count, so that their day is asked for again.
    """
    if retry:
        reason = F.coalesce(F.col(REJECT_REASON), F.lit(""))
        responses = responses.where(~reason.isin(*retry))
    return responses.groupBy("region_id", F.col("run_date").alias("day")).agg(
        F.count("*").alias("answers")
    )


def missing_days(days: DataFrame, answered: DataFrame, expected: Column | None = None) -> DataFrame:
    """Rows of region and ``day`` whose day has fewer answers than expected; none, unless said otherwise.

    The rows are compared before they are spread over cells. A day that lacks some of its answers is asked
    for as a whole: responses do not say which cell they are for.
    """
    short = days.withColumn("_expected", F.lit(1) if expected is None else expected)
    known = answered.select(
        F.col("region_id").alias("_region"), F.col("day").alias("_day"), F.col("answers").alias("_n")
    )
    same = (F.col("region_id") == F.col("_region")) & (F.col("day") == F.col("_day"))
    full = same & (F.col("_n") >= F.col("_expected"))
    return short.join(known, full, "left_anti").drop("_expected")


def warning_url(region_id: Column, first_day: Column, last_day: Column) -> Column:
    return F.concat_ws(
        "/", F.lit(WARNING_ENDPOINT), region_id, F.lit(WARNING_LANGUAGE_KEY), first_day, last_day
    )


def weather_url(lat: Column, lon: Column, first_day: Column, last_day: Column) -> Column:
    """``lat`` and ``lon`` are text with four decimals."""
    return F.concat(
        F.lit(f"{WEATHER_ENDPOINT}?latitude="),
        lat,
        F.lit("&longitude="),
        lon,
        F.lit("&start_date="),
        first_day,
        F.lit("&end_date="),
        last_day,
        F.lit(f"&daily={','.join(DAILY_VARIABLES)}&timezone={WEATHER_TIMEZONE}"),
    )


def warning_requests(days: DataFrame) -> DataFrame:
    """Add ``url`` to rows of region and ``day``."""
    return days.withColumn("url", warning_url(F.col("region_id"), F.col("day"), F.col("day")))


def grid_cells(regions: DataFrame, columns: int = GRID_COLUMNS) -> DataFrame:
    """One row per grid cell of every region, with ``cell_row``, ``cell_col`` and its centre.

    Rows run from the north edge to the south edge, columns from the east edge to the west edge. A
    thin box has very many rows of cells: they are dealt over the tasks in blocks.
    """
    north, south = F.col("west_north_lat"), F.col("east_south_lat")
    east, west = F.col("east_south_lon"), F.col("west_north_lon")
    row, col, n_rows = F.col("cell_row"), F.col("cell_col"), F.col("_rows")
    return (
        regions.withColumn("_rows", grid.rows_for_box(north, south, east, west, columns))
        .select("*", F.explode(grid.blocks(n_rows, ROW_BLOCK)).alias("_block"))
        .repartition("region_id", "_block")
        .select("*", F.explode(grid.indexes(F.col("_block"), n_rows, ROW_BLOCK)).alias("cell_row"))
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))).alias("cell_col"))
        .withColumn("lat", grid.cell_centre(north, south, row, n_rows))
        .withColumn("lon", grid.cell_centre(east, west, col, F.lit(columns)))
        .drop("_rows", "_block")
    )


def cells_of(columns: int = GRID_COLUMNS) -> Column:
    """How many cells the grid over a region's box has; 0 for a degenerate box."""
    rows = grid.rows_for_box(
        F.col("west_north_lat"), F.col("east_south_lat"),
        F.col("east_south_lon"), F.col("west_north_lon"), columns,
    )
    return F.coalesce(F.greatest(rows, F.lit(0)), F.lit(0)).cast("bigint") * columns


def weather_requests(days: DataFrame, columns: int = GRID_COLUMNS) -> DataFrame:
    """One row per region, cell and ``day``, with ``url``."""
    cells = grid_cells(days, columns)
    url = weather_url(
        grid.fixed_text(F.col("lat")), grid.fixed_text(F.col("lon")), F.col("day"), F.col("day")
    )
    return cells.withColumn("url", url)
