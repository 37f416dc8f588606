"""Wire schemas, sink columns and fixed names of the two feeds."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Topics and sink tables that producers and readers of the feeds already use.
WARNING_TOPIC = "avalanche_region_warning"
WEATHER_TOPIC = "weather_forecast"
WARNING_NAMESPACE = "spark_avalanche"
WEATHER_NAMESPACE = "spark_weather"
WARNING_TABLE = "avalanche_warning"
WEATHER_TABLE = "weather_forecast"

# The warning document, one line per field: wire name, type, required, sink column.
_WARNING_FIELDS = [
    ("RegId", IntegerType(), True, "reg_id"),
    ("RegionId", IntegerType(), True, "region_id"),
    ("RegionName", StringType(), False, "region_name"),
    ("RegionTypeId", IntegerType(), True, "region_type_id"),
    ("RegionTypeName", StringType(), False, "region_type_name"),
    ("DangerLevel", StringType(), False, "danger_level"),
    ("ValidFrom", TimestampType(), False, "valid_from"),
    ("ValidTo", TimestampType(), False, "valid_to"),
    ("NextWarningTime", TimestampType(), False, "next_warning_time"),
    ("PublishTime", TimestampType(), False, "publish_time"),
    ("DangerIncreaseTime", TimestampType(), False, "danger_increase_time"),
    ("DangerDecreaseTime", TimestampType(), False, "danger_decrease_time"),
    ("MainText", StringType(), False, "main_text"),
    ("LangKey", IntegerType(), True, "lang_key"),
]

WARNING_WIRE = StructType(
    [StructField(wire, kind, not required) for wire, kind, required, _ in _WARNING_FIELDS]
)
WARNING_RENAMES = {wire: sink for wire, _, _, sink in _WARNING_FIELDS}
WARNING_SINK = StructType(
    [StructField("id", StringType())]
    + [StructField(sink, kind) for _, kind, _, sink in _WARNING_FIELDS]
)

# The daily weather variables, in request order.
DAILY_VARIABLES = [
    "weathercode",
    "temperature_2m_max",
    "temperature_2m_min",
    "temperature_2m_mean",
    "rain_sum",
    "snowfall_sum",
    "precipitation_hours",
    "windspeed_10m_max",
    "windgusts_10m_max",
    "winddirection_10m_dominant",
]
DAILY_KEYS = ["time", *DAILY_VARIABLES]

# Top-level keys of a weather response that a strict decode asks for.
RESPONSE_KEYS = [
    "latitude",
    "longitude",
    "generationtime_ms",
    "utc_offset_seconds",
    "timezone",
    "timezone_abbreviation",
    "elevation",
]

# Daily variables that are not numbers with a fraction.
_DAILY_TYPES = {"time": StringType(), "weathercode": IntegerType()}

DAILY_WIRE = StructType(
    [StructField(key, ArrayType(_DAILY_TYPES.get(key, DoubleType()))) for key in DAILY_KEYS]
)


def weather_wire(elevation: str = "double") -> StructType:
    """Wire schema of the weather document.

    ``elevation="int_strict"`` reads elevation as an integer, which loses values written with a
    decimal point.
    """
    if elevation not in ("double", "int_strict"):
        raise ValueError(f"elevation must be 'double' or 'int_strict', not {elevation!r}")
    # Members of the document and their types.
    return StructType(
        [
            StructField("region_id", StringType(), False),
            StructField("region_name", StringType()),
            StructField("start_date", TimestampType()),
            StructField("end_date", TimestampType()),
            StructField("latitude", DoubleType()),
            StructField("longitude", DoubleType()),
            StructField(
                "elevation", IntegerType() if elevation == "int_strict" else DoubleType()
            ),
            StructField("daily", DAILY_WIRE),
        ]
    )


def weather_sink(elevation: str = "double") -> StructType:
    """Columns of the weather table: the scalars, then day one of every daily array."""
    scalars = [field for field in weather_wire(elevation) if field.name != "daily"]
    days = [
        StructField(
            key, TimestampType() if key == "time" else _DAILY_TYPES.get(key, DoubleType())
        )
        for key in DAILY_KEYS
    ]
    return StructType(
        [StructField("id", StringType())]
        + [StructField(field.name, field.dataType) for field in scalars]
        + days
    )


LOG_RECORD = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
        StructField("timestampType", IntegerType()),
    ]
)

LANDED_RESPONSE = StructType(
    [
        StructField("region_id", StringType()),
        StructField("region_name", StringType()),
        StructField("run_date", StringType()),
        StructField("status", IntegerType()),
        StructField("body", StringType()),
    ]
)

REGION = StructType(
    [
        StructField("name", StringType()),
        StructField("region_id", StringType()),
        StructField("west_north_lat", DoubleType()),
        StructField("west_north_lon", DoubleType()),
        StructField("east_south_lat", DoubleType()),
        StructField("east_south_lon", DoubleType()),
    ]
)
