"""Payload cases: what each document becomes, kept and quarantined."""

from datetime import datetime

import pytest
from feedloom import schemas
from feedloom.operators import parse, shape
from feedloom.plans import feeds
from pyspark.sql import functions as F

FULL_WARNING = (
    '{"RegId":7,"RegionId":3022,"RegionName":"Trollheimen","RegionTypeId":10,'
    '"RegionTypeName":"A","DangerLevel":"2","ValidFrom":"2025-01-24T00:00:00",'
    '"ValidTo":"2025-01-24T23:59:59","NextWarningTime":"2025-01-24T16:00:00",'
    '"PublishTime":"2025-01-23T14:12:45.123","DangerIncreaseTime":null,'
    '"DangerDecreaseTime":null,"MainText":"Fokksnø øker faren","LangKey":1}'
)
ADDED = '"region_id":"3022","region_name":"T","start_date":"2025-01-24","end_date":"2025-01-24"'


def as_log(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "n long, text string")
    return rows.select(
        F.col("text").cast("binary").alias("value"),
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("n").alias("offset"),
    )


def warning(spark, text):
    rows = parse.parse_log(as_log(spark, [text]), schemas.WARNING_WIRE).collect()
    assert len(rows) == 1
    return {name: value for name, value in rows[0].asDict().items() if value is not None}


def weather(spark, text, **options):
    rows = feeds.weather_rows(as_log(spark, [text]), **options).drop("id").collect()
    assert len(rows) == 1
    return {name: value for name, value in rows[0].asDict().items() if value is not None}


WARNING_CASES = {
    "missing_field": ('{"RegionName":"a"}', {"RegionName": "a"}),
    "extra_field": ('{"RegionName":"a","extra":1}', {"RegionName": "a"}),
    "other_case": ('{"regid":9}', {}),
    "repeated_key": ('{"RegId":1,"RegId":2}', {"RegId": 2}),
    "text_in_int": ('{"RegId":"3","RegionName":"a"}', {"RegionName": "a"}),
    "int_overflow": ('{"RegId":99999999999,"RegionName":"q"}', {"RegionName": "q"}),
    "float_in_int": ('{"RegId":812.0,"RegionName":"q"}', {"RegionName": "q"}),
    "number_in_string": ('{"DangerLevel":5}', {"DangerLevel": "5"}),
    "object_in_string": ('{"MainText":{"a": 1}}', {"MainText": '{"a":1}'}),
    "date_as_time": ('{"ValidFrom":"2025-01-24"}', {"ValidFrom": datetime(2025, 1, 24)}),
    "zoneless": ('{"ValidFrom":"2025-01-24T10:00:00"}', {"ValidFrom": datetime(2025, 1, 24, 10)}),
    "offset": ('{"ValidFrom":"2025-01-24T10:00:00+01:00"}', {"ValidFrom": datetime(2025, 1, 24, 9)}),
    "other_date_form": ('{"ValidFrom":"24.01.2025","RegId":1}', {"RegId": 1}),
    "epoch": ('{"ValidFrom":1700000000}', {"ValidFrom": datetime(2023, 11, 14, 22, 13, 20)}),
    "cut_at_start": ('{"RegId":', {}),
    "cut_after_good": ('{"RegId":7,"RegionName":"a"', {}),
    "plain_text": ("hello", {}),
    "array": ('[{"RegId":1},{"RegId":2}]', {}),
    "empty_array": ("[]", {}),
    "null": ("null", {}),
    "number": ("5", {}),
    "string": ('"a"', {}),
    "byte_order_mark": ('﻿{"RegId":7}', {}),
    "text_after": ('{"RegId":7} xx', {"RegId": 7}),
    "empty": ("", {}),
    "blank": (" ", {}),
    "null_value": (None, {}),
}


@pytest.fixture(autouse=True)
def utc(monkeypatch):
    # collect() turns timestamps into local datetimes.
    import time

    monkeypatch.setenv("TZ", "UTC")
    time.tzset()


@pytest.mark.parametrize("case", WARNING_CASES)
def test_warning_fields(spark, case):
    text, expected = WARNING_CASES[case]
    assert warning(spark, text) == expected


def test_full_warning_row(spark):
    row = feeds.warning_rows(as_log(spark, [FULL_WARNING])).collect()[0]
    assert row.asDict() == {
        "id": row["id"],
        "reg_id": 7,
        "region_id": 3022,
        "region_name": "Trollheimen",
        "region_type_id": 10,
        "region_type_name": "A",
        "danger_level": "2",
        "valid_from": datetime(2025, 1, 24),
        "valid_to": datetime(2025, 1, 24, 23, 59, 59),
        "next_warning_time": datetime(2025, 1, 24, 16),
        "publish_time": datetime(2025, 1, 23, 14, 12, 45, 123000),
        "danger_increase_time": None,
        "danger_decrease_time": None,
        "main_text": "Fokksnø øker faren",
        "lang_key": 1,
    }


def test_keep_gives_a_row_per_record(spark):
    texts = [text for text, _ in WARNING_CASES.values()]
    assert feeds.warning_rows(as_log(spark, texts)).count() == len(texts)


REASONS = {
    "missing_field": "missing_required",
    "repeated_key": "missing_required",
    "text_in_int": "field_type",
    "other_date_form": "field_type",
    "cut_at_start": "malformed",
    "cut_after_good": "malformed",
    "plain_text": "not_an_object",
    "array": "not_an_object",
    "null": "not_an_object",
    "number": "not_an_object",
    "empty": "empty",
    "blank": "empty",
    "null_value": "empty",
}


def test_quarantine_reasons(spark):
    texts = [WARNING_CASES[case][0] for case in REASONS] + [FULL_WARNING]
    rows = feeds.warning_rows(as_log(spark, texts), mode="quarantine")
    assert rows.count() == len(texts)
    bad = {row["raw"]: row["reject_reason"] for row in parse.rejected(rows).collect()}
    assert bad == {WARNING_CASES[case][0]: reason for case, reason in REASONS.items()}
    good = parse.accepted(rows).collect()
    assert [row["reg_id"] for row in good] == [7]
    assert "raw" not in good[0].asDict()


def test_modes_agree_on_fields(spark):
    log = as_log(spark, [text for text, _ in WARNING_CASES.values()])
    kept = parse.parse_log(log, schemas.WARNING_WIRE, keep=["offset"])
    quarantined = parse.parse_log(log, schemas.WARNING_WIRE, mode="quarantine", keep=["offset"])
    assert sorted(kept.collect(), key=repr) == sorted(
        quarantined.drop("reject_reason", "raw").collect(), key=repr
    )


def daily(**arrays):
    members = ",".join(f'"{name}":{text}' for name, text in arrays.items())
    return f'{{{ADDED},"daily":{{{members}}}}}'


BASE = {
    "region_id": "3022",
    "region_name": "T",
    "start_date": datetime(2025, 1, 24),
    "end_date": datetime(2025, 1, 24),
}
WEATHER_CASES = {
    "one_day": (daily(time='["2025-01-24"]', rain_sum="[1.5]"), {"time": datetime(2025, 1, 24), "rain_sum": 1.5}),
    "two_days": (daily(rain_sum="[1.0,2.0]"), {"rain_sum": 1.0}),
    "null_item": (daily(rain_sum="[null]"), {}),
    "no_items": (daily(time="[]", rain_sum="[]"), {}),
    "bad_int_item": (daily(weathercode='["x"]', rain_sum="[1.0]"), {"rain_sum": 1.0}),
    "float_int_item": (daily(weathercode="[3.0]", rain_sum="[1.0]"), {"rain_sum": 1.0}),
    "int_double_item": (daily(winddirection_10m_dominant="[210]"), {"winddirection_10m_dominant": 210.0}),
    "scalar_array": (daily(time='"2025"', rain_sum="[1.0]"), {"rain_sum": 1.0}),
    "bad_time": (daily(time='["soon"]', weathercode="[3]"), {"weathercode": 3}),
    "daily_text": (f'{{{ADDED},"daily":"x"}}', {}),
    "error_body": (f'{{"error":true,"reason":"x",{ADDED}}}', {}),
    "elevation": (f'{{{ADDED},"elevation":812.0}}', {"elevation": 812.0}),
    "numeric_region": ('{"region_id":3022,"region_name":"T","start_date":"2025-01-24","end_date":"2025-01-24"}', {}),
}


@pytest.mark.parametrize("case", WEATHER_CASES)
def test_weather_fields(spark, case):
    text, expected = WEATHER_CASES[case]
    assert weather(spark, text) == {**BASE, **expected}


def test_not_a_number_token(spark):
    value = weather(spark, daily(rain_sum="[NaN]"))["rain_sum"]
    assert value != value


def test_int_strict_elevation(spark):
    assert "elevation" not in weather(spark, f'{{{ADDED},"elevation":812.0}}', elevation="int_strict")
    assert weather(spark, f'{{{ADDED},"elevation":812}}', elevation="int_strict")["elevation"] == 812


def test_source_zone(spark):
    text = daily(time='["2025-01-24"]')
    row = weather(spark, text, source_tz="Europe/Berlin")
    assert row["start_date"] == row["time"] == datetime(2025, 1, 23, 23)
    aware = daily(time='["2025-07-24T10:00:00+02:00"]')
    assert weather(spark, aware, source_tz="Europe/Berlin")["time"] == datetime(2025, 7, 24, 8)


def test_sink_columns(spark):
    log = as_log(spark, [FULL_WARNING])
    names = [field.name for field in schemas.WARNING_SINK]
    assert feeds.warning_rows(log).columns == names and len(names) == 15
    names = [field.name for field in schemas.weather_sink()]
    assert feeds.weather_rows(log).columns == names and len(names) == 19


def test_ids(spark):
    log = as_log(spark, [FULL_WARNING] * 50)

    def ids(**options):
        return [row["id"] for row in feeds.warning_rows(log, **options).select("id").collect()]

    assert ids() == ids() and len(set(ids())) == 50
    drawn = ids(id_mode="random")
    assert len(set(drawn)) == 50 and not set(drawn) & set(ids(id_mode="random"))
    with pytest.raises(ValueError):
        shape.add_id(log.drop("offset"))
    with pytest.raises(ValueError):
        shape.add_id(log, "other")


def test_bad_modes(spark):
    log = as_log(spark, ["{}"])
    with pytest.raises(ValueError):
        parse.parse_log(log, schemas.WARNING_WIRE, mode="drop")
    with pytest.raises(ValueError):
        schemas.weather_wire("text")
