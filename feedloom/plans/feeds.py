"""The two feeds: landed responses to log records, log records to sink rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.operators import parse, responses, shape
from feedloom.operators.encode import to_log


def warning_log(documents: DataFrame) -> DataFrame:
    """Accepted warning documents as log records, placed by their values."""
    return to_log(parse.accepted(documents), schemas.WARNING_TOPIC, text=F.col("document"))


def weather_log(documents: DataFrame) -> DataFrame:
    """Accepted weather documents as log records placed by their values, with region and day put in."""
    enriched = responses.enrich_weather(parse.accepted(documents))
    return to_log(enriched, schemas.WEATHER_TOPIC, text=F.col("document"))


def _finish(
    rows: DataFrame, sink, mode: str, source_tz: str | None, position: list[str]
) -> DataFrame:
    extra = [*([parse.REJECT_REASON, parse.RAW] if mode == "quarantine" else []), *position]
    return shape.coerce_to_sink(rows, sink, source_tz=source_tz, extra=extra)


def warning_rows(
    log: DataFrame,
    *,
    mode: str = "keep",
    id_mode: str = "stable",
    with_position: bool = False,
    source_tz: str | None = None,
) -> DataFrame:
    """Rows of the warning table from its log, batch or stream.

    ``with_position`` keeps the record's place in the log, which a keyed sink needs to break ties.
    """
    position = shape.position_columns(log)
    carried = [*position, *(["id"] if id_mode == "kept" else [])]
    rows = parse.parse_log(
        log, schemas.WARNING_WIRE, mode=mode, keep=carried, source_tz=source_tz
    )
    rows = shape.rename(rows, schemas.WARNING_RENAMES)
    rows = shape.add_id(rows, id_mode, position)
    kept = position if with_position else []
    return _finish(rows, schemas.WARNING_SINK, mode, source_tz, kept)


def weather_rows(
    log: DataFrame,
    *,
    mode: str = "keep",
    id_mode: str = "stable",
    elevation: str = "double",
    with_position: bool = False,
    source_tz: str | None = None,
    days: str = "first",
) -> DataFrame:
    """Rows of the weather table from its log, batch or stream.

    ``days="first"``: day one of every daily array. ``days="all"``: one row for each day, with
    ``day_number`` and ``day_fault`` as further columns.
    """
    if days not in ("first", "all"):
        raise ValueError(f"days must be 'first' or 'all', not {days!r}")
    position = shape.position_columns(log)
    carried = [*position, *(["id"] if id_mode == "kept" else [])]
    rows = parse.parse_log(
        log, schemas.weather_wire(elevation), mode=mode, keep=carried, source_tz=source_tz
    )
    kept = position if with_position else []
    if days == "all":
        rows = shape.explode_days(rows, schemas.DAILY_WIRE)
        rows = shape.add_day_id(rows, id_mode, position)
        kept = [*kept, shape.DAY_NUMBER, shape.DAY_FAULT]
    else:
        rows = shape.pick_first_day(rows, schemas.DAILY_WIRE)
        rows = shape.add_id(rows, id_mode, position)
    return _finish(rows, schemas.weather_sink(elevation), mode, source_tz, kept)
