"""Queries over the test tables, one or more per operator, each next to its SQL oracle.

The test tables stand in for the feeds: their rows are encoded as documents of the feeds' shapes,
go through the operators, and come back as rows that plain SQL over the same tables can predict.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from feedloom import schemas
from feedloom.functions import json_text
from feedloom.functions.arrays import first_item
from feedloom.operators import decode, drift, parse, requests, responses, shape
from feedloom.operators.encode import number_equal, to_log
from feedloom.operators.latest import latest_by_key
from feedloom.plans import daily, feeds
from feedloom.session import scratch_dir
from feedloom.sources import landed, logs, regions, storage
from feedloom.streaming import keyed, reconcile, redrive, runs, sinks, tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        ORACLES[query.__name__] = sql
        return query

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the test tables have them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, TimestampType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def _camel(name: str) -> str:
    return "".join(part.capitalize() for part in name.split("_"))


def _camel_document(df: DataFrame) -> list[Column]:
    return [F.col(name).alias(_camel(name)) for name in df.columns]


def _camel_schema(df: DataFrame, required: tuple[str, ...] = ()) -> StructType:
    def wire(kind):
        return TimestampType() if kind.typeName() == "timestamp_ntz" else kind

    return StructType(
        [
            StructField(_camel(f.name), wire(f.dataType), f.name not in required)
            for f in df.schema
        ]
    )


def _snake_renames(df: DataFrame) -> dict[str, str]:
    return {_camel(name): name for name in df.columns}


def _uuid_sql(position: str) -> str:
    digest = f"sha256({position})"
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return " || '-' || ".join(f"substr({digest}, {at}, {size})" for at, size in parts)


# --- Flat documents -------------------------------------------------------------------------------


def _event_log(events: DataFrame, text: Column | None = None) -> DataFrame:
    return to_log(
        events,
        "events",
        _camel_document(events),
        text=text,
        partition=F.lit(0),
        offset=F.col("event_id"),
        timestamp=F.col("ts"),
    )


def _flat_round_trip(table: DataFrame, log: DataFrame) -> DataFrame:
    rows = parse.parse_log(log, _camel_schema(table))
    return _plain_times(shape.rename(rows, _snake_renames(table)))


@_query(
    f"""
    SELECT event_id, ts, user_id, event_type, value, props,
           {_uuid_sql("'events:0:' || event_id")} AS id
    FROM events
    """
)
def flat_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    position = ["topic", "partition", "offset"]
    rows = parse.parse_log(_event_log(events), _camel_schema(events), keep=position)
    rows = shape.add_id(shape.rename(rows, _snake_renames(events)), position=position)
    return _plain_times(rows.drop(*position))


@_query("SELECT * FROM lineitem")
def flat_parse_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    return _flat_round_trip(lines, to_log(lines, "lines", _camel_document(lines)))


@_query("SELECT * FROM documents")
def flat_parse_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long texts with all their quotes, line ends and odd characters."""
    documents = _table(spark, sf_dir, "documents")
    return _flat_round_trip(documents, to_log(documents, "documents", _camel_document(documents)))


@_query(
    """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
    """
)
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = StructType([StructField("k", IntegerType())])
    events = _table(spark, sf_dir, "events")
    parsed = events.select("event_id", json_text.parse(F.col("props"), schema).alias("props"))
    return parsed.select("event_id", "props.k")


def _faulty_event_log(events: DataFrame) -> DataFrame:
    """Each event type has its own fault; purchases are sound, save that cheap ones lack the id."""
    documents = _with_document(events, _camel_document(events))
    text = F.col("document")
    kind = F.col("event_type")
    faulty = (
        F.when(kind == "error", F.substring(text, F.lit(1), F.length(text) - 1))
        .when(kind == "signup", F.lit(None))
        .when(kind == "view", F.concat(F.lit("["), text, F.lit("]")))
        .when(kind == "click", F.regexp_replace(text, r'"UserId":(\d+)', r'"UserId":"$1"'))
        .when(F.col("value") < 20, F.regexp_replace(text, r'"EventId":\d+,', ""))
        .otherwise(text)
    )
    return _event_log(documents, faulty)


_FAULTY_FIELDS_SQL = """
    CASE WHEN event_type = 'click' OR (event_type = 'purchase' AND value >= 20)
         THEN event_id END AS event_id,
    CASE WHEN event_type = 'purchase' THEN user_id END AS user_id,
    CASE WHEN event_type IN ('click', 'purchase') THEN event_type END AS event_type,
    CASE WHEN event_type IN ('click', 'purchase') THEN value END AS value,
    CASE WHEN event_type IN ('click', 'purchase') THEN ts END AS ts,
    CASE WHEN event_type IN ('click', 'purchase') THEN props END AS props
"""
# The user in the text of a rejected record: texts of accepted ones are not kept.
_RAW_SQL = """
    CASE WHEN event_type IN ('error', 'view', 'click') OR (event_type = 'purchase' AND value < 20)
         THEN CAST(user_id AS VARCHAR) END AS raw_user
"""
_FAULTY_REASON_SQL = """
    CASE WHEN event_type = 'error' THEN 'malformed'
         WHEN event_type = 'signup' THEN 'empty'
         WHEN event_type = 'view' THEN 'not_an_object'
         WHEN event_type = 'click' THEN 'field_type'
         WHEN value < 20 THEN 'missing_required'
    END AS reject_reason
"""


@_query(f'SELECT event_id AS "offset", {_FAULTY_FIELDS_SQL} FROM events')
def parse_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    rows = parse.parse_log(_faulty_event_log(events), _camel_schema(events), keep=["offset"])
    return _plain_times(shape.rename(rows, _snake_renames(events)))


def _faulty_rows(rows: DataFrame) -> DataFrame:
    """Parsed faulty events with their reason, and the user that their raw text names."""
    renames = {_camel(c): c for c in ("event_id", "ts", "user_id", "event_type", "value", "props")}
    user = F.regexp_extract("raw", r'"UserId":"?([0-9]+)', 1)
    named = shape.rename(rows, renames).withColumn("raw_user", F.when(user != "", user))
    return _plain_times(named.drop("raw"))


@_query(
    f'SELECT event_id AS "offset", {_FAULTY_FIELDS_SQL}, {_FAULTY_REASON_SQL}, {_RAW_SQL} FROM events'
)
def parse_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    rows = parse.parse_log(
        _faulty_event_log(events),
        _camel_schema(events, required=("event_id",)),
        mode="quarantine",
        keep=["offset"],
    )
    return _faulty_rows(rows)


# --- Ids and sink types ---------------------------------------------------------------------------


@_query(
    f"""
    SELECT event_id, CASE WHEN user_id % 10 <> 0 THEN
           {_uuid_sql("'events:' || user_id || ':' || event_id")} END AS id
    FROM events
    """
)
def stable_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("event_id", "user_id")
    log = to_log(
        events,
        "events",
        partition=F.when(F.col("user_id") % 10 != 0, F.col("user_id")).cast("int"),
        offset=F.col("event_id"),
    )
    return shape.add_id(log).select(F.col("offset").alias("event_id"), "id")


@_query("SELECT count(*) AS n_rows, count(*) AS n_ids, count(*) AS n_well_formed FROM events")
def random_id_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = shape.add_id(_table(spark, sf_dir, "events").select("event_id"), "random")
    form = r"^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    # Two counting steps: ids are counted once each before the totals, without a distinct set.
    per_id = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_ids"),
        F.count_if(F.col("id").rlike(form)).alias("n_well_formed"),
    )


@_query(
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus IN ('O', 'F') THEN o_orderdate END AS day,
           CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS total
    FROM orders
    """
)
def sink_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, date = F.col("o_orderstatus"), F.col("o_orderdate")
    texts = _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(status == "O", F.date_format(date, "yyyy-MM-dd"))
        .when(status == "F", F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format(date, "dd.MM.yyyy"))
        .alias("day"),
        F.when(status == "O", F.col("o_totalprice").cast("string")).otherwise("n/a").alias("total"),
    )
    sink = StructType(
        [
            StructField("o_orderkey", LongType()),
            StructField("day", TimestampType()),
            StructField("total", DoubleType()),
        ]
    )
    return _plain_times(shape.coerce_to_sink(texts, sink))


@_query(
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN o_orderdate - INTERVAL 9 HOUR
           WHEN 'F' THEN o_orderdate - INTERVAL 2 HOUR ELSE o_orderdate END AS moment
    FROM orders
    """
)
def sink_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local times without a zone, with the name of one, and in UTC."""
    status = F.col("o_orderstatus")
    zone = F.when(status == "O", "").when(status == "F", " Etc/GMT-2").otherwise("UTC")
    local = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    texts = _table(spark, sf_dir, "orders").select("o_orderkey", F.concat(local, zone).alias("moment"))
    sink = StructType([StructField("o_orderkey", LongType()), StructField("moment", TimestampType())])
    return _plain_times(shape.coerce_to_sink(texts, sink, source_tz="Asia/Tokyo"))


# --- Nested documents -----------------------------------------------------------------------------

# The weather document of an order, as SQL text that both Spark and the oracle's engine read.
_WEATHER_SCALARS_SQL = {
    "latitude": "o_totalprice / 10000",
    "longitude": "o_custkey / 100.0e0",
    "elevation": "o_totalprice / 100",
}
_WEATHER_DAY_SQL = {
    "weathercode": "CAST(o_orderkey % 100 AS INT)",
    "temperature_2m_max": "o_totalprice / 1000",
    "temperature_2m_min": "o_totalprice / 3000",
    "temperature_2m_mean": "o_totalprice / 2000",
    "rain_sum": "o_totalprice / 7000",
    "snowfall_sum": "o_totalprice / 9000",
    "precipitation_hours": "o_custkey / 8.0e0",
    "windspeed_10m_max": "o_custkey / 16.0e0",
    "windgusts_10m_max": "o_custkey / 4.0e0",
    "winddirection_10m_dominant": "o_custkey / 2.0e0",
}


def _weather_daily(day: Column) -> Column:
    """Two days of values; the second day's are other ones."""
    later = F.date_format(F.date_add(F.col("o_orderdate").cast("date"), 1), "yyyy-MM-dd")
    arrays = [F.array(day, later).alias("time")]
    for name, sql in _WEATHER_DAY_SQL.items():
        value = F.expr(sql)
        arrays.append(F.array(value, value * 2 + 1).alias(name))
    return F.struct(*arrays)


def _weather_columns() -> list[Column]:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return [
        F.col("o_custkey").cast("string").alias("region_id"),
        F.col("o_orderpriority").alias("region_name"),
        day.alias("start_date"),
        day.alias("end_date"),
        *[F.expr(sql).alias(name) for name, sql in _WEATHER_SCALARS_SQL.items()],
        _weather_daily(day).alias("daily"),
    ]


def _order_weather_log(orders: DataFrame) -> DataFrame:
    return to_log(
        orders, "weather", _weather_columns(), partition=F.lit(0), offset=F.col("o_orderkey")
    )


_WEATHER_VALUES_SQL = ", ".join(
    f"{sql} AS {name}" for name, sql in {**_WEATHER_SCALARS_SQL, **_WEATHER_DAY_SQL}.items()
)
_WEATHER_ROW_SQL = f"""
    CAST(o_custkey AS VARCHAR) AS region_id, o_orderpriority AS region_name,
    o_orderdate AS start_date, o_orderdate AS end_date, o_orderdate AS time, {_WEATHER_VALUES_SQL}
"""
_WEATHER_WITH_ID_SQL = f"""
    SELECT {_uuid_sql("'weather:0:' || o_orderkey")} AS id, {_WEATHER_ROW_SQL} FROM orders
"""


@_query(_WEATHER_WITH_ID_SQL)
def nested_parse_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _order_weather_log(_table(spark, sf_dir, "orders"))
    return _plain_times(feeds.weather_rows(log))


# Every seventh document lacks the second day of two variables, every eleventh has no days at all.
_RAGGED = ("rain_sum", "snowfall_sum")


def _later_day_sql(short: bool) -> str:
    """The values of the second day, as text that the oracle's engine reads."""
    values = []
    for name, sql in _WEATHER_DAY_SQL.items():
        later = f"CAST(({sql}) * 2 + 1 AS INT)" if name == "weathercode" else f"({sql}) * 2 + 1"
        if short and name in _RAGGED:
            later = f"CASE WHEN o_orderkey % 7 <> 0 THEN {later} END"
        values.append(f"{later} AS {name}")
    return ", ".join(values)


_DAY_FAULT_SQL = f"""
    CASE WHEN o_orderkey % 11 = 0 THEN 'no_days'
         WHEN o_orderkey % 7 = 0 THEN 'short:{",".join(_RAGGED)}' END
"""
_DAY_HEAD_SQL = f"""
    CAST(o_custkey AS VARCHAR) AS region_id, o_orderpriority AS region_name,
    o_orderdate AS start_date, o_orderdate AS end_date,
    {", ".join(f"{sql} AS {name}" for name, sql in _WEATHER_SCALARS_SQL.items())}
"""


@_query(
    f"""
    SELECT {_uuid_sql("'weather:0:' || o_orderkey")} AS id, {_DAY_HEAD_SQL},
           CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate END AS time,
           {", ".join(f"CASE WHEN o_orderkey % 11 <> 0 THEN {sql} END AS {name}"
                      for name, sql in _WEATHER_DAY_SQL.items())},
           CAST(1 AS INT) AS day_number, {_DAY_FAULT_SQL} AS day_fault
    FROM orders
    UNION ALL
    SELECT {_uuid_sql("'weather:0:' || o_orderkey || ':2'")} AS id, {_DAY_HEAD_SQL},
           CAST(o_orderdate + INTERVAL 1 DAY AS TIMESTAMP) AS time, {_later_day_sql(True)},
           CAST(2 AS INT) AS day_number, {_DAY_FAULT_SQL} AS day_fault
    FROM orders WHERE o_orderkey % 11 <> 0
    """
)
def daily_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each day of a document, whose arrays need not be equally long."""
    *scalars, daily_ = _weather_columns()
    arrays = []
    for field in schemas.DAILY_WIRE:
        own = F.col(f"_daily.{field.name}")
        short = F.when(F.col("o_orderkey") % 7 == 0, F.slice(own, 1, 1)).otherwise(own)
        arrays.append((short if field.name in _RAGGED else own).alias(field.name))
    ragged = F.when(F.col("o_orderkey") % 11 != 0, F.struct(*arrays)).alias("daily")
    orders = _table(spark, sf_dir, "orders").withColumn("_daily", daily_)
    log = to_log(
        orders, "weather", [*scalars, ragged], partition=F.lit(0), offset=F.col("o_orderkey")
    )
    return _plain_times(feeds.weather_rows(log, days="all"))


@_query("SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first FROM embeddings")
def array_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    log = to_log(vectors, "vectors")
    rows = parse.parse_log(log, vectors.schema)
    return rows.select("vec_id", first_item(F.col("embedding")).cast("double").alias("first"))


# --- Upsert ---------------------------------------------------------------------------------------

_LAST_EVENT_SQL = """
    SELECT user_id, event_id, ts, event_type, {value} AS value, props
    FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""


@_query(_LAST_EVENT_SQL.format(value="value"))
def upsert_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    return latest_by_key(events, ["user_id"], ["ts", "event_id"])


@_query(_LAST_EVENT_SQL.format(value="value + 1"))
def upsert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events, then the same events with corrected values, upserted by user with a compaction."""
    events = _table(spark, sf_dir, "events")
    root = scratch_dir(spark, "upsert_stream")
    sink, order = keyed.upsert_files(f"{root}/users"), ["ts", "event_id", "batch_id"]
    corrected = events.withColumn("value", F.col("value") + 1)
    for run, table in [("first", events), ("second", corrected)]:
        logs.publish_files(_event_log(table), root, "events", run)
        rows = _flat_round_trip(events, logs.stream_files(spark, root, "events"))
        runs.run_to_end(rows, sink, name="users", checkpoints=f"{root}/checkpoints")
        if run == "first":
            keyed.compact(spark, f"{root}/users", ["user_id"], order)
    return keyed.read_latest(spark, f"{root}/users", ["user_id"], order).drop("batch_id")


@_query(
    """
    SELECT event_type, max(event_id) AS event_id,
           CAST(arg_max(user_id, event_id) AS BIGINT) AS user_id, arg_max(props, event_id) AS props
    FROM events GROUP BY event_type
    """
)
def upsert_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of a key in one batch: the last one in the log wins, before and after a compaction."""
    events = _table(spark, sf_dir, "events")
    root = scratch_dir(spark, "upsert_ties")
    logs.publish_files(_event_log(events), root, "events", "all")
    rows = parse.parse_log(
        logs.stream_files(spark, root, "events"), _camel_schema(events), keep=["partition", "offset"]
    )
    rows = shape.rename(rows, _snake_renames(events))
    sink, keys = keyed.upsert_files(f"{root}/types"), ["event_type"]
    runs.run_to_end(rows, sink, name="types", checkpoints=f"{root}/checkpoints")
    before = keyed.read_latest(spark, f"{root}/types", keys)
    keyed.compact(spark, f"{root}/types", keys)
    after = keyed.read_latest(spark, f"{root}/types", keys)
    both = before.unionByName(after).select("event_type", "event_id", "user_id", "props")
    return both.distinct()


# --- Streams --------------------------------------------------------------------------------------


def _stream_events(
    spark: SparkSession, events: DataFrame, root: str, sink: sinks.BatchSink
) -> None:
    rows = _flat_round_trip(events, logs.stream_files(spark, root, "events"))
    runs.run_to_end(rows, sink, name="events", checkpoints=f"{root}/checkpoints")


@_query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    root = scratch_dir(spark, "stream_append")
    logs.publish_files(_event_log(events), root, "events", "all")
    _stream_events(spark, events, root, sinks.files(f"{root}/rows"))
    return sinks.read_files(spark, f"{root}/rows").drop("batch_id")


@_query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the events come in files far older than those that were read before."""
    events = _table(spark, sf_dir, "events")
    root = scratch_dir(spark, "stream_late_files")
    for run, table in [
        ("first", events.where("event_id % 2 = 0")), ("second", events.where("event_id % 2 = 1")),
    ]:
        logs.publish_files(_event_log(table), root, "events", run)
        if run == "second":
            storage.set_age(spark, logs.run_path(root, "events", run), days=400)
        _stream_events(spark, events, root, sinks.files(f"{root}/rows"))
    return sinks.read_files(spark, f"{root}/rows").drop("batch_id")


@_query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same query started again on its checkpoint adds nothing."""
    events = _table(spark, sf_dir, "events")
    root = scratch_dir(spark, "stream_rerun")
    logs.publish_files(_event_log(events), root, "events", "all")
    for _ in range(2):
        _stream_events(spark, events, root, sinks.files(f"{root}/rows"))
    return sinks.read_files(spark, f"{root}/rows").drop("batch_id")


@_query(
    """
    SELECT event_id, ts, user_id, event_type, value, props FROM events
    UNION ALL
    SELECT event_id, ts, user_id, event_type, -value AS value, props FROM events
    """
)
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second publish after the first run: the restarted query reads only what is new."""
    events = _table(spark, sf_dir, "events")
    root = scratch_dir(spark, "stream_resume")
    negated = events.withColumn("value", -F.col("value"))
    for run, table in [("first", events), ("second", negated)]:
        logs.publish_files(_event_log(table), root, "events", run)
        _stream_events(spark, events, root, sinks.files(f"{root}/rows"))
    return sinks.read_files(spark, f"{root}/rows").drop("batch_id")


@_query(
    """
    SELECT event_id, ts, user_id, event_type, value, props FROM events
    UNION ALL
    SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE event_id % 5 = 0
    """
)
def stream_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that failed half way is repeated as a whole and read in two goes; every record comes once.

    Every fifth event is in the run twice, by right: those are two records.
    """
    events = _table(spark, sf_dir, "events")
    root, columns = scratch_dir(spark, "stream_once"), _camel_document(events)
    twice = events.unionByName(events.where("event_id % 5 = 0"))
    run = number_equal(to_log(twice, "events", columns))
    log = logs.FileLog(root, once_within="7 days")
    for sent in (run.where("pmod(xxhash64(value, partition), 2) = 0"), run):
        # Whoever writes past the publisher leaves no mark that what it wrote is not all.
        sent.write.mode("append").parquet(logs.run_path(root, "events", "all"))
        rows = _flat_round_trip(events, daily.stream_log(spark, log, "events"))
        runs.run_to_end(rows, sinks.files(f"{root}/rows"), name="events", checkpoints=f"{root}/checkpoints")
    return sinks.read_files(spark, f"{root}/rows").drop("batch_id")


@_query(_WEATHER_WITH_ID_SQL)
def stream_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "stream_nested")
    log = _order_weather_log(_table(spark, sf_dir, "orders"))
    logs.publish_files(log, root, "weather", "all")
    # Ids from topic, partition and offset alone, as with a Kafka topic.
    rows = feeds.weather_rows(logs.stream_files(spark, root, "weather").drop("run"))
    runs.run_to_end(
        rows, sinks.files(f"{root}/rows"), name="weather", checkpoints=f"{root}/checkpoints"
    )
    return _plain_times(sinks.read_files(spark, f"{root}/rows").drop("batch_id"))


@_query(
    f'SELECT event_id AS "offset", {_FAULTY_FIELDS_SQL}, {_FAULTY_REASON_SQL}, {_RAW_SQL} FROM events'
)
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and rejected rows in one pass over the stream."""
    events = _table(spark, sf_dir, "events")
    root = scratch_dir(spark, "stream_quarantine")
    logs.publish_files(_faulty_event_log(events), root, "events", "all")
    rows = parse.parse_log(
        logs.stream_files(spark, root, "events"),
        _camel_schema(events, required=("event_id",)),
        mode="quarantine",
        keep=["offset"],
    )
    runs.run_to_end(
        rows, sinks.split_files(f"{root}/rows"), name="events", checkpoints=f"{root}/checkpoints"
    )
    kinds = [sinks.read_split(spark, f"{root}/rows", rejected=kind) for kind in (False, True)]
    return _faulty_rows(kinds[0].unionByName(kinds[1]))


@_query(
    """
    SELECT event_id AS "offset", event_id, ts, user_id, event_type, value, props
    FROM events WHERE event_type = 'click' OR (event_type = 'purchase' AND value >= 20)
    """
)
def stream_redrive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected records are read again, twice, by a schema that takes the user as text."""
    events = _table(spark, sf_dir, "events")
    root, strict = scratch_dir(spark, "stream_redrive"), _camel_schema(events, required=("event_id",))
    logs.publish_files(_faulty_event_log(events), root, "events", "all")

    def rows_of(log: DataFrame, schema: StructType) -> DataFrame:
        rows = parse.parse_log(log, schema, mode="quarantine", keep=["offset"])
        return rows.withColumn("UserId", F.col("UserId").cast("bigint"))

    text_user = StructType(
        [StructField(f.name, StringType(), f.nullable) if f.name == "UserId" else f for f in strict]
    )
    runs.run_to_end(
        rows_of(logs.stream_files(spark, root, "events"), strict), sinks.split_files(f"{root}/rows"),
        name="events", checkpoints=f"{root}/checkpoints",
    )
    for _ in range(2):
        redrive.redrive(spark, f"{root}/rows", lambda log: rows_of(log, text_user), ["offset"])
    rows = redrive.read_accepted(spark, f"{root}/rows")
    return _plain_times(shape.rename(rows, _snake_renames(events)))


@_query(
    f"""
    SELECT CASE WHEN event_id % 13 = 0 THEN 'lost' ELSE 'doubled' END AS state, 'events' AS topic,
           'all' AS run, CAST(0 AS INT) AS partition, event_id AS "offset",
           {_uuid_sql("'events:all:0:' || event_id")} AS id,
           CAST(CASE WHEN event_id % 13 = 0 THEN 0 ELSE 2 END AS BIGINT) AS n_rows
    FROM events WHERE event_id % 13 = 0 OR event_id % 17 = 0
    """
)
def stream_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sink that lost some records and doubled others, against its log."""
    events = _table(spark, sf_dir, "events")
    root = scratch_dir(spark, "stream_reconcile")
    logs.publish_files(_event_log(events), root, "events", "all")
    good = sinks.files(f"{root}/rows")

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.where("EventId % 13 <> 0")
        good.write(kept.unionByName(kept.where("EventId % 17 = 0")), batch_id)

    log = logs.stream_files(spark, root, "events")
    place = shape.position_columns(log)
    rows = parse.parse_log(log, _camel_schema(events), keep=place)
    rows = shape.add_id(rows, "stable", place).drop(*place)
    runs.run_to_end(
        rows, sinks.BatchSink(write, good.batches), name="events", checkpoints=f"{root}/checkpoints"
    )
    stored = sinks.read_files(spark, f"{root}/rows")
    return reconcile.reconcile(logs.read_files(spark, root, "events"), stored)


@_query(
    """
    SELECT 'User' AS path, 'unknown' AS change, count(*) AS n_documents
    FROM events WHERE event_id % 2 = 0
    UNION ALL SELECT 'Value', 'type', count(*) FROM events
    UNION ALL SELECT 'Props', 'vanished', 0
    """
)
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A member that got another name in half of the documents, one of a new type, and one that is gone."""
    events = _table(spark, sf_dir, "events")
    columns = [c for c in _camel_document(events.drop("props"))]
    documents = _with_document(events, columns)
    key, text = F.col("event_id"), F.col("document")
    renamed = F.when(key % 2 == 0, F.replace(text, F.lit('"UserId":'), F.lit('"User":'))).otherwise(text)
    retyped = F.when(key % 10 == 0, F.regexp_replace(renamed, '"Value":[^,}]*', '"Value":"much"'))
    log = _event_log(documents, F.coalesce(retyped, renamed))
    return drift.drift(log, _camel_schema(events)).drop("seen_type")


def _fresh_namespace(spark: SparkSession) -> str:
    """A namespace of its own for the queries, in the same place each time, without tables."""
    namespace = "feedloom_queries"
    spark.sql(f"DROP DATABASE IF EXISTS {namespace} CASCADE")
    tables.create_namespace(spark, namespace, scratch_dir(spark, "warehouse"))
    return namespace


@_query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Namespace and table made if absent, twice over, then filled by a stream."""
    events = _table(spark, sf_dir, "events")
    root = scratch_dir(spark, "table_append")
    namespace = _fresh_namespace(spark)
    logs.publish_files(_event_log(events), root, "events", "all")
    for _ in range(2):
        tables.create_namespace(spark, namespace)
        tables.create_table(spark, f"{namespace}.events", events.schema)
    _stream_events(spark, events, root, sinks.table(f"{namespace}.events"))
    return spark.table(f"{namespace}.events").drop("batch_id")


# --- Request planning -----------------------------------------------------------------------------

# Boxes around customers. Two market segments get degenerate ones: no width, or swapped edges.
_BOX_SQL = {
    "west_north_lat": "60 + c_acctbal / 1000",
    "west_north_lon": "8 + (c_custkey % 1000) / 100.0e0",
    "east_south_lat": """CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 61 + c_acctbal / 1000
                              ELSE 59.5e0 + c_acctbal / 1000 END""",
    "east_south_lon": """CASE WHEN c_mktsegment = 'BUILDING' THEN 8 + (c_custkey % 1000) / 100.0e0
                              ELSE 9.25e0 + (c_custkey % 1000) / 100.0e0 END""",
}


def _customer_regions(customers: DataFrame) -> DataFrame:
    return customers.select(
        F.col("c_name").alias("name"),
        F.col("c_custkey").cast("string").alias("region_id"),
        *[F.expr(sql).alias(name) for name, sql in _BOX_SQL.items()],
    )


_REGIONS_SQL = f"""
    SELECT c_name AS name, CAST(c_custkey AS VARCHAR) AS region_id,
           {", ".join(f"{sql} AS {name}" for name, sql in _BOX_SQL.items())}
    FROM customer
"""
# Some boxes made a thousand times thinner, some so thin that their rows cannot be counted.
_THIN_SQL = "east_south_lon + (west_north_lon - east_south_lon) * {factor}"
_THIN_FACTOR_SQL = (
    "CASE WHEN CAST(region_id AS INT) % 50 = 0 THEN 1e-3 "
    "WHEN CAST(region_id AS INT) % 50 = 1 THEN 1e-14 ELSE 1e0 END"
)
_CELLS_SQL = f"""
    WITH whole AS ({_REGIONS_SQL}),
    boxes AS (
        SELECT * REPLACE ({_THIN_SQL.format(factor=_THIN_FACTOR_SQL)} AS west_north_lon) FROM whole
    ),
    steps AS (
        SELECT *, (west_north_lon - east_south_lon) / 5 AS lon_step,
               cos(radians((west_north_lat + east_south_lat) / 2)) * 111.0e0 / 111.0e0 AS shrink
        FROM boxes
    ),
    counts AS (
        SELECT *, CASE WHEN lon_step <> 0 THEN
                  TRY_CAST(
                      round_even((east_south_lat - west_north_lat) / (lon_step * shrink), 0) AS INT
                  )
                  END AS n
        FROM steps
    ),
    picked AS (
        SELECT c.*, r.i AS cell_row, k.j AS cell_col,
               (east_south_lat - west_north_lat) / n AS lat_size,
               (west_north_lon - east_south_lon) / 5 AS lon_size
        FROM counts c,
             LATERAL (SELECT CAST(unnest(range(0, greatest(n, 0))) AS INT) AS i) r,
             (SELECT CAST(unnest(range(0, 5)) AS INT) AS j) k
    ),
    edges AS (
        SELECT *, west_north_lat + cell_row * lat_size AS lat_a,
               CASE WHEN cell_row + 1 = n THEN east_south_lat
                    ELSE west_north_lat + (cell_row + 1) * lat_size END AS lat_b,
               east_south_lon + cell_col * lon_size AS lon_a,
               CASE WHEN cell_col = 4 THEN west_north_lon
                    ELSE east_south_lon + (cell_col + 1) * lon_size END AS lon_b
        FROM picked
    ),
    cells AS (
        SELECT region_id, cell_row, cell_col, (lat_a + lat_b) / 2 AS lat, (lon_a + lon_b) / 2 AS lon
        FROM edges
    )
"""


def _boxes(customers: DataFrame) -> DataFrame:
    thin = F.expr(_THIN_SQL.format(factor=_THIN_FACTOR_SQL))
    return _customer_regions(customers).withColumn("west_north_lon", thin)


@_query(_REGIONS_SQL)
def region_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "region_table")
    _customer_regions(_table(spark, sf_dir, "customer")).write.csv(path, header=True)
    return regions.read_regions(spark, path, file_format="csv", header="true")


@_query(f"{_CELLS_SQL} SELECT region_id, cell_row, cell_col, lat, lon FROM cells")
def request_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = requests.grid_cells(_boxes(_table(spark, sf_dir, "customer")))
    return cells.select("region_id", "cell_row", "cell_col", "lat", "lon")


@_query(
    f"""{_CELLS_SQL}
    SELECT region_id, cell_row, cell_col,
           '{requests.WEATHER_ENDPOINT}?latitude=' || printf('%.4f', lat)
           || '&longitude=' || printf('%.4f', lon)
           || '&start_date=2025-01-24&end_date=2025-01-24'
           || '&daily={",".join(schemas.DAILY_VARIABLES)}'
           || '&timezone={requests.WEATHER_TIMEZONE}' AS url
    FROM cells
    """
)
def request_rows_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = _boxes(_table(spark, sf_dir, "customer"))
    rows = daily.plan_requests("weather", boxes, "2025-01-25")
    return rows.select("region_id", "cell_row", "cell_col", "url")


@_query(
    f"""
    SELECT CAST(c_custkey AS VARCHAR) AS region_id, '2025-01-25' AS day,
           '{requests.WARNING_ENDPOINT}/' || c_custkey || '/1/2025-01-25/2025-01-25' AS url
    FROM customer
    """
)
def request_rows_warning(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = _customer_regions(_table(spark, sf_dir, "customer"))
    return daily.plan_requests("warnings", boxes, "2025-01-25").select("region_id", "day", "url")


@_query(
    f"""
    WITH days AS (
        SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS region_id,
               strftime(o_orderdate + to_days(CAST(d AS INT) - 1), '%Y-%m-%d') AS day
        FROM orders, (SELECT unnest(range(0, 4)) AS d)
    )
    SELECT o_orderkey, region_id, day,
           '{requests.WARNING_ENDPOINT}/' || region_id || '/1/' || day || '/' || day AS url
    FROM days
    """
)
def request_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four run dates per order, each asking for the day before."""
    regions_ = _table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("region_id"), "o_orderdate"
    )
    first = F.col("o_orderdate").cast("date")
    days = requests.add_backfill_days(regions_, first, F.date_add(first, 3), days_back=1)
    return requests.warning_requests(days).select("o_orderkey", "region_id", "day", "url")


@_query(
    f"""
    WITH days AS (
        SELECT CAST(c_custkey AS VARCHAR) AS region_id, c_custkey,
               DATE '1995-01-01' + CAST(d AS INT) AS asked
        FROM customer, (SELECT unnest(range(0, 59)) AS d)
    )
    SELECT region_id, strftime(asked, '%Y-%m-%d') AS day,
           '{requests.WARNING_ENDPOINT}/' || region_id || '/1/' || strftime(asked, '%Y-%m-%d')
               || '/' || strftime(asked, '%Y-%m-%d') AS url
    FROM days
    WHERE NOT EXISTS (
        SELECT 1 FROM orders
        WHERE o_custkey = c_custkey AND CAST(o_orderdate AS DATE) = asked AND o_orderstatus <> 'P'
    )
    """
)
def request_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two months of planned requests, without the days whose response has landed.

    A rejected response is one too, unless its request had failed.
    """
    root = scratch_dir(spark, "request_missing")
    _landed_warnings(_table(spark, sf_dir, "orders")).write.parquet(f"{root}/warnings")
    boxes = _customer_regions(_table(spark, sf_dir, "customer"))
    missing = daily.plan_missing(
        spark, "warnings", boxes, "1995-01-01", "1995-02-28", landed_root=root
    )
    return missing.select("region_id", "day", "url")


# --- Responses ------------------------------------------------------------------------------------


def _warning_columns() -> list[Column]:
    date = F.col("o_orderdate")
    number = (F.col("o_orderkey") % 1_000_000_000).cast("int")
    return [
        number.alias("RegId"),
        (F.col("o_custkey") % 1_000_000_000).cast("int").alias("RegionId"),
        F.col("o_orderpriority").alias("RegionName"),
        F.lit(10).alias("RegionTypeId"),
        F.lit("A").alias("RegionTypeName"),
        (number % 5 + 1).cast("string").alias("DangerLevel"),
        date.alias("ValidFrom"),
        F.date_format(F.date_add(date.cast("date"), 1), "yyyy-MM-dd").alias("ValidTo"),
        F.lit(None).cast("timestamp_ntz").alias("NextWarningTime"),
        date.alias("PublishTime"),
        F.lit(None).cast("timestamp_ntz").alias("DangerIncreaseTime"),
        F.lit(None).cast("timestamp_ntz").alias("DangerDecreaseTime"),
        F.concat(F.lit("Fare – "), "o_orderstatus").alias("MainText"),
        F.lit(1).alias("LangKey"),
    ]


_WARNING_ROW_SQL = """
    CAST(o_orderkey % 1000000000 AS INT) AS reg_id,
    CAST(o_custkey % 1000000000 AS INT) AS region_id,
    o_orderpriority AS region_name, CAST(10 AS INT) AS region_type_id, 'A' AS region_type_name,
    CAST(o_orderkey % 1000000000 % 5 + 1 AS VARCHAR) AS danger_level, o_orderdate AS valid_from,
    CAST(o_orderdate + INTERVAL 1 DAY AS TIMESTAMP) AS valid_to,
    CAST(NULL AS TIMESTAMP) AS next_warning_time,
    o_orderdate AS publish_time, CAST(NULL AS TIMESTAMP) AS danger_increase_time,
    CAST(NULL AS TIMESTAMP) AS danger_decrease_time, 'Fare – ' || o_orderstatus AS main_text,
    CAST(1 AS INT) AS lang_key
"""


def _with_document(orders: DataFrame, columns: list[Column]) -> DataFrame:
    """Add ``document``, in a step of its own so that uses of it do not each encode it again."""
    return orders.withColumn("document", F.to_json(F.struct(*columns), json_text.ENCODE_OPTIONS))


def _landed(orders: DataFrame, body: Column, *extra: str) -> DataFrame:
    """Landed responses, one per order; pending orders are failed requests."""
    return orders.select(
        *extra,
        F.col("o_custkey").cast("string").alias("region_id"),
        F.col("o_orderpriority").alias("region_name"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("run_date"),
        F.when(F.col("o_orderstatus") == "P", 500).otherwise(200).alias("status"),
        body.alias("body"),
    )


def _landed_warnings(orders: DataFrame, *extra: str) -> DataFrame:
    """Arrays of two warnings; three of the five order priorities bring a fault."""
    later = F.lit(', {"RegId":-1,"MainText":"later"}]')
    array = F.concat(F.lit("["), F.col("document"), later)
    priority = F.col("o_orderpriority")
    body = (
        F.when(priority == "2-HIGH", "[]")
        .when(priority == "3-MEDIUM", F.substring(array, F.lit(1), F.length(array) - 3))
        .when(priority == "4-NOT SPECIFIED", F.col("document"))
        .otherwise(array)
    )
    return _landed(_with_document(orders, _warning_columns()), body, *extra)


_WARNING_REASON_SQL = """
    CASE WHEN o_orderstatus = 'P' THEN 'status'
         WHEN o_orderpriority = '2-HIGH' THEN 'empty_array'
         WHEN o_orderpriority = '3-MEDIUM' THEN 'bad_json'
         WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'not_an_array'
    END
"""


@_query(f"SELECT o_orderkey, {_WARNING_REASON_SQL} AS reject_reason FROM orders")
def response_gate_warning(spark: SparkSession, sf_dir: str) -> DataFrame:
    responded = _landed_warnings(_table(spark, sf_dir, "orders"), "o_orderkey")
    return responses.warning_documents(responded).select("o_orderkey", "reject_reason")


@_query(f"SELECT {_WARNING_ROW_SQL} FROM orders WHERE ({_WARNING_REASON_SQL}) IS NULL")
def response_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    responded = _landed_warnings(_table(spark, sf_dir, "orders"))
    log = feeds.warning_log(responses.warning_documents(responded))
    return _plain_times(feeds.warning_rows(log).drop("id"))


# What documents with an old request field hold besides: texts that have to come through unchanged.
_OLD_MEMBERS = {
    "extra": '{"a":[1],"region_id":"own"}',
    "half": "812.0",
    "whole": "12345678901234567890123456789012345678901234567890",
    "twice": '{"a":1,"a":2}',
    "text": 'a "region_id": \\',
}

_REQUEST_FIELDS = ("region_id", "region_name", "start_date", "end_date")


def _landed_weather(orders: DataFrame, *extra: str) -> DataFrame:
    """Weather documents without the request's fields; two order priorities bring a fault."""
    document = F.col("document")
    priority = F.col("o_orderpriority")
    body = (
        F.when(priority == "2-HIGH", F.concat(F.lit("["), document, F.lit("]")))
        .when(priority == "3-MEDIUM", F.concat(document, F.lit(" <html>")))
        .when(
            priority == "5-LOW",
            F.regexp_replace(
                document,
                r"^\{",
                '{"region_id":"old", "extra":{"a":[1],"region_id":"own"}, "half":812.0, '
                '"whole":12345678901234567890123456789012345678901234567890, '
                '"twice":{"a":1,"a":2}, "text":"a \\\\"region_id\\\\": \\\\\\\\", ',
            ),
        )
        .otherwise(document)
    )
    columns = _weather_columns()[len(_REQUEST_FIELDS) :]
    return _landed(_with_document(orders, columns), body, *extra)


_WEATHER_REASON_SQL = """
    CASE WHEN {check} AND o_orderstatus = 'P' THEN 'status'
         WHEN o_orderpriority = '2-HIGH' THEN 'not_an_object'
         WHEN o_orderpriority = '3-MEDIUM' THEN 'bad_json'
    END
"""


@_query(
    f"""
    SELECT o_orderkey, {_WEATHER_REASON_SQL.format(check="true")} AS checked,
           {_WEATHER_REASON_SQL.format(check="false")} AS unchecked
    FROM orders
    """
)
def response_gate_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    responded = _landed_weather(_table(spark, sf_dir, "orders"), "o_orderkey")
    checked = responses.weather_documents(responded).withColumnRenamed("reject_reason", "checked")
    both = responses.weather_documents(checked.drop("document"), check_status=False)
    return both.select("o_orderkey", "checked", F.col("reject_reason").alias("unchecked"))


@_query(
    f"""
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS region_id, o_orderpriority AS region_name,
           o_orderdate AS start_date, o_orderdate AS end_date, {_WEATHER_SCALARS_SQL["latitude"]}
           AS latitude, {_WEATHER_SCALARS_SQL["longitude"]} AS longitude,
           {_WEATHER_SCALARS_SQL["elevation"]} AS elevation, o_orderdate AS time,
           {", ".join(f"{sql} AS {name}" for name, sql in _WEATHER_DAY_SQL.items())},
           {", ".join(f"CASE WHEN o_orderpriority = '5-LOW' THEN '{text}' END AS {name}"
                      for name, text in _OLD_MEMBERS.items())}
    FROM orders WHERE ({_WEATHER_REASON_SQL.format(check="true")}) IS NULL
    """
)
def enrich_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request fields set in documents, over an old value in some; unknown members stay."""
    responded = _landed_weather(_table(spark, sf_dir, "orders"), "o_orderkey")
    documents = responses.enrich_weather(parse.accepted(responses.weather_documents(responded)))
    log = to_log(documents, "weather", text=F.col("document"), offset=F.col("o_orderkey"))
    schema = StructType(
        [
            *schemas.weather_wire(),
            *[StructField(name, StringType()) for name in _OLD_MEMBERS],
        ]
    )
    rows = parse.parse_log(log, schema, keep=["offset"])
    rows = shape.pick_first_day(rows, schemas.DAILY_WIRE)
    rows = rows.withColumn("time", F.col("time").cast("timestamp"))
    return _plain_times(rows.withColumnRenamed("offset", "o_orderkey"))


@_query(
    """
    SELECT page_id, url, html, 'bad_json' AS bare_page, CAST(page_id AS VARCHAR) AS region_id,
           'Page "' || page_id || '"' AS region_name
    FROM pages
    """
)
def enrich_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as responses: refused as they are, enriched as members of an object."""
    pages = _with_document(
        _table(spark, sf_dir, "pages"), [F.col("page_id"), F.col("url"), F.col("html")]
    )
    responded = pages.select(
        F.col("page_id").cast("string").alias("region_id"),
        F.format_string('Page "%d"', "page_id").alias("region_name"),
        F.lit("2025-01-24").alias("run_date"),
        F.lit(200).alias("status"),
        F.col("html").alias("body"),
        "document",
    )
    bare = responses.weather_documents(responded.withColumnRenamed("document", "page"))
    wrapped = bare.select(
        "region_id",
        "region_name",
        "run_date",
        "status",
        F.col("page").alias("body"),
        F.col("reject_reason").alias("bare_page"),
    )
    enriched = responses.enrich_weather(parse.accepted(responses.weather_documents(wrapped)))
    schema = StructType(
        [
            StructField("page_id", LongType()),
            *[StructField(name, StringType()) for name in ("url", "html")],
            *[StructField(name, StringType()) for name in ("region_id", "region_name")],
        ]
    )
    log = enriched.select("bare_page", F.col("document").cast("binary").alias("value"))
    return parse.parse_log(log, schema, keep=["bare_page"])


# Every seventh order brings a value of another type, in a place that depends on its priority.
_TYPE_FAULT_SQL = "o_orderkey % 7 = 0 AND o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')"
_SOUND_SQL = "o_orderkey % 7 <> 0 AND o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')"
_WEATHER_CONSTANTS = {
    "generationtime_ms": "0.25e0",
    "utc_offset_seconds": "3600e0",
    "timezone": "'Europe/Berlin'",
    "timezone_abbreviation": "'CET'",
}
_STRICT_WEATHER_SQL = {
    **_WEATHER_SCALARS_SQL,
    **_WEATHER_CONSTANTS,
    "first_time": "strftime(o_orderdate, '%Y-%m-%d')",
    "second_time": "strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d')",
    **{
        f"{place}_{name}": f"CAST({sql} AS VARCHAR)" if name == "weathercode" else sql
        for name, value in _WEATHER_DAY_SQL.items()
        for place, sql in (("first", value), ("second", f"({value}) * 2 + 1"))
    },
    **{f"unit_{name}": "'mm'" for name in schemas.DAILY_KEYS},
}


@_query(
    f"""
    SELECT o_orderkey,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'daily_unknown_key'
                WHEN '2-HIGH' THEN 'daily_missing_key' WHEN '3-MEDIUM' THEN 'missing_key'
                ELSE CASE WHEN {_TYPE_FAULT_SQL} THEN 'field_type' END
           END AS decode_error,
           {", ".join(f"CASE WHEN {_SOUND_SQL} THEN {sql} END AS {name}"
                      for name, sql in _STRICT_WEATHER_SQL.items())}
    FROM orders
    """
)
def strict_decode_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All members of a response; a number as text, or text as a number, is a fault."""
    units = F.struct(*[F.lit("mm").alias(key) for key in schemas.DAILY_KEYS])
    columns = [
        *_weather_columns()[len(_REQUEST_FIELDS) :],
        *[F.expr(sql).alias(name) for name, sql in _WEATHER_CONSTANTS.items()],
        units.alias("daily_units"),
    ]
    documents = _with_document(_table(spark, sf_dir, "orders"), columns)
    document = F.col("document")
    priority = F.col("o_orderpriority")
    faulty = F.when(
        priority == "5-LOW", F.regexp_replace(document, '"latitude":[^,]*,', '"latitude":"north",')
    ).otherwise(F.regexp_replace(document, r'"rain_sum":\[[^,]*,', '"rain_sum":["wet",'))
    body = (
        F.when(priority == "1-URGENT", F.regexp_replace(document, r'"daily":\{', '"daily":{"x":1,'))
        .when(priority == "2-HIGH", F.regexp_replace(document, r'"rain_sum":\[[^\]]*\],', ""))
        .when(priority == "3-MEDIUM", F.regexp_replace(document, '"timezone":"[^"]*",', ""))
        .when(F.expr(_TYPE_FAULT_SQL), faulty)
        .when(priority == "5-LOW", F.regexp_replace(document, r"^\{", '{"extra":1,'))
        .otherwise(document)
    )
    responded = documents.select("o_orderkey", body.alias("body"))
    record = F.col("record")
    days = [
        F.get(record["daily"][key], F.lit(i)).alias(f"{place}_{key}")
        for key in schemas.DAILY_KEYS
        for i, place in enumerate(("first", "second"))
    ]
    return decode.decode_weather(responded).select(
        "o_orderkey",
        "decode_error",
        *[record[key].alias(key) for key in schemas.RESPONSE_KEYS],
        *days,
        *[record["daily_units"][key].alias(f"unit_{key}") for key in schemas.DAILY_KEYS],
    )


_FAULT_SQL = [
    ("o_orderkey % 2 = 0", "$.timezone", "missing"), ("o_orderkey % 3 = 0", "$.daily.x", "unknown"),
    ("o_orderkey % 4 = 0", "$.daily.rain_sum", "type"), ("o_orderkey % 5 = 0", "$.latitude", "type"),
    ("o_orderkey % 6 = 0", "$.daily_units.time", "missing"),
]


@_query(
    " UNION ALL ".join(
        f"SELECT o_orderkey, '{path}' AS path, '{kind}' AS kind FROM orders WHERE {when}"
        for when, path, kind in _FAULT_SQL
    )
)
def strict_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All faults of each response, with their places; most have several, some none."""
    units = F.struct(*[F.lit("mm").alias(key) for key in schemas.DAILY_KEYS])
    columns = [
        *_weather_columns()[len(_REQUEST_FIELDS) :],
        *[F.expr(sql).alias(name) for name, sql in _WEATHER_CONSTANTS.items()],
        units.alias("daily_units"),
    ]
    body, key = F.col("document"), F.col("o_orderkey")
    for n, pattern, text in (
        (2, '"timezone":"[^"]*",', ""), (3, r'"daily":\{', '"daily":{"x":1,'),
        (4, r'"rain_sum":\[[^,]*,', '"rain_sum":["wet",'),
        (5, '"latitude":[^,]*,', '"latitude":"north",'),
        (6, r'"daily_units":\{"time":"mm",', '"daily_units":{'),
    ):
        body = F.when(key % n == 0, F.regexp_replace(body, pattern, text)).otherwise(body)
    documents = _with_document(_table(spark, sf_dir, "orders"), columns)
    decoded = decode.decode_weather(documents.select("o_orderkey", body.alias("body")))
    return decode.list_faults(decoded, ["o_orderkey"])


_STRICT_WARNING_SQL = {
    "RegId": "CAST(o_orderkey % 1000000000 AS INT)",
    "RegionId": "CAST(o_custkey % 1000000000 AS INT)",
    "RegionName": "o_orderpriority",
    "RegionTypeId": "CAST(10 AS INT)",
    "RegionTypeName": "'A'",
    "DangerLevel": "CAST(o_orderkey % 1000000000 % 5 + 1 AS VARCHAR)",
    "ValidFrom": "strftime(o_orderdate, '%Y-%m-%d')",
    "ValidTo": "strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d')",
    "NextWarningTime": "CAST(NULL AS VARCHAR)",
    "PublishTime": "strftime(o_orderdate, '%Y-%m-%d')",
    "DangerIncreaseTime": "CAST(NULL AS VARCHAR)",
    "DangerDecreaseTime": "CAST(NULL AS VARCHAR)",
    "MainText": "'Fare – ' || o_orderstatus",
    "LangKey": "CAST(1 AS INT)",
}


@_query(
    f"""
    SELECT o_orderkey, CAST(NULL AS VARCHAR) AS decode_error,
           {", ".join(f"{sql} AS {name}" for name, sql in _STRICT_WARNING_SQL.items())}
    FROM orders, (SELECT unnest(range(0, 2)))
    WHERE {_SOUND_SQL}
    UNION ALL BY NAME
    SELECT o_orderkey,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'unknown_key'
                WHEN '2-HIGH' THEN 'missing_key' WHEN '3-MEDIUM' THEN 'not_an_array'
                ELSE 'field_type' END AS decode_error
    FROM orders WHERE NOT ({_SOUND_SQL})
    """
)
def strict_decode_warning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two warnings per response; a fault in the second one rejects the response."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    columns = [
        day.alias(name) if name in ("ValidFrom", "PublishTime") else column
        for name, column in zip(_STRICT_WARNING_SQL, _warning_columns(), strict=True)
    ]
    documents = _with_document(_table(spark, sf_dir, "orders"), columns)
    one = F.col("document")
    priority = F.col("o_orderpriority")
    # Text, a fraction, and a number beyond the integers.
    wrong = F.element_at(
        F.array(F.lit('"abc"'), F.lit("1.5"), F.lit(str(2**40))),
        (F.col("o_orderkey") % 3 + 1).cast("int"),
    )
    two = (
        F.when(priority == "1-URGENT", F.regexp_replace(one, r"\}$", ',"X":1}'))
        .when(priority == "2-HIGH", F.regexp_replace(one, r',"LangKey":1\}$', "}"))
        .when(
            F.expr(_TYPE_FAULT_SQL),
            F.regexp_replace(one, F.lit('"RegId":[0-9]+'), F.concat(F.lit('"RegId":'), wrong)),
        )
        .otherwise(one)
    )
    body = F.when(priority == "3-MEDIUM", one).otherwise(
        F.concat(F.lit("["), one, F.lit(","), two, F.lit("]"))
    )
    responded = documents.select("o_orderkey", body.alias("body"))
    return decode.decode_warnings(responded).select("o_orderkey", "decode_error", "record.*")


# --- Sink tables ---------------------------------------------------------------------------------


def _feed_table(
    spark: SparkSession, log: DataFrame, topic: str, rows_of, sink: StructType, day_of: str,
    by_value: bool,
) -> DataFrame:
    """A log to the feed's own table, laid out by day."""
    root = scratch_dir(spark, "feed_table")
    name = f"{_fresh_namespace(spark)}.{topic.replace('-', '_')}"
    logs.publish_files(log, root, topic, "all", by_value=by_value)
    tables.create_table(spark, name, sink, day_of)
    rows = rows_of(logs.stream_files(spark, root, topic))
    runs.run_to_end(
        rows, sinks.table(name, day_of), name="rows", checkpoints=f"{root}/checkpoints"
    )
    return _plain_times(spark.table(name).drop("batch_id", "period", "id"))


@_query(
    f"""
    SELECT {_WARNING_ROW_SQL}, CAST(o_orderdate AS DATE) AS day
    FROM orders WHERE ({_WARNING_REASON_SQL}) IS NULL
    """
)
def table_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 15 columns of the warning table, by day of publication."""
    documents = responses.warning_documents(_landed_warnings(_table(spark, sf_dir, "orders")))
    log = feeds.warning_log(documents)
    return _feed_table(
        spark, log, schemas.WARNING_TOPIC, feeds.warning_rows, schemas.WARNING_SINK, "publish_time",
        by_value=True,
    )


@_query(f"SELECT {_WEATHER_ROW_SQL}, CAST(o_orderdate AS DATE) AS day FROM orders")
def table_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 19 columns of the weather table, by the day they are for."""
    log = _order_weather_log(_table(spark, sf_dir, "orders"))
    return _feed_table(
        spark, log, schemas.WEATHER_TOPIC, feeds.weather_rows, schemas.weather_sink(), "start_date",
        by_value=False,
    )


# --- Whole feeds ----------------------------------------------------------------------------------


def _whole_feed(spark: SparkSession, feed: str, responded: DataFrame) -> DataFrame:
    root = scratch_dir(spark, f"{feed}_feed")
    responded.write.parquet(f"{root}/landed")
    log = logs.FileLog(f"{root}/log")
    daily.publish_landed(
        feed,
        landed.read_landed(spark, f"{root}/landed"),
        log=log,
        rejects=f"{root}/rejects",
        run="2025-01-24",
    )
    daily.ingest(
        spark,
        feed,
        log=log,
        sink=sinks.files(f"{root}/rows"),
        checkpoints=f"{root}/checkpoints",
    )
    rows = _plain_times(sinks.read_files(spark, f"{root}/rows").drop("batch_id"))
    # An id is a hash of topic, run, and position; what matters here is that each row has its own.
    n_ids = F.count("*").over(Window.partitionBy("id"))
    rows = rows.withColumn("has_own_id", F.col("id").isNotNull() & (n_ids == 1)).drop("id")
    refused = daily.read_rejects(spark, feed, f"{root}/rejects").select(
        F.col("region_id").alias("rejected_region"), F.col("run_date").alias("rejected_day"),
        F.col("status").alias("rejected_status"), "reject_reason",
    )
    return rows.unionByName(refused, allowMissingColumns=True)


_FEED_SQL = """
    SELECT {row}, true AS has_own_id FROM orders WHERE ({reason}) IS NULL
    UNION ALL BY NAME
    SELECT CAST(o_custkey AS VARCHAR) AS rejected_region,
           strftime(o_orderdate, '%Y-%m-%d') AS rejected_day,
           CAST(CASE WHEN o_orderstatus = 'P' THEN 500 ELSE 200 END AS INT) AS rejected_status,
           {reason} AS reject_reason
    FROM orders WHERE ({reason}) IS NOT NULL
"""


@_query(_FEED_SQL.format(row=_WARNING_ROW_SQL, reason=_WARNING_REASON_SQL))
def warning_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed responses to rows of the warning table, through the log; and the refused ones."""
    responded = _landed_warnings(_table(spark, sf_dir, "orders"))
    return _whole_feed(spark, "warnings", responded)


@_query(
    _FEED_SQL.format(row=_WEATHER_ROW_SQL, reason=_WEATHER_REASON_SQL.format(check="true"))
)
def weather_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed responses to rows of the weather table, through the log; and the refused ones."""
    responded = _landed_weather(_table(spark, sf_dir, "orders"))
    return _whole_feed(spark, "weather", responded)
