"""Strict typed decode of whole responses: members are checked by name and by type.

Every decoded row has ``faults``, all that is wrong with it, each with the ``path`` in the response and its
kind: ``missing`` and ``unknown`` members, ``type`` for a value that the member's type cannot hold without
loss (null fits all types), ``not_an_object``. ``decode_error`` names the first one that matters.

A sound object is told by the shape of its JSON text: a variant writes its members in the order of their
names, so one pattern says that all are there, no others, and each of its kind. Whatever does not have the
shape, sound or not, is taken apart into its members, and one walk over them finds its faults.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from feedloom.functions import json_text
from feedloom.schemas import DAILY_KEYS, RESPONSE_KEYS, WARNING_WIRE

ERROR = "decode_error"

# Members of a weather response that hold text; all others hold numbers.
_TEXT_KEYS = {"timezone", "timezone_abbreviation"}
_TEXT_DAILY_KEYS = {"time", "weathercode"}

WEATHER_RECORD = StructType(
    [
        *[
            StructField(key, StringType() if key in _TEXT_KEYS else DoubleType())
            for key in RESPONSE_KEYS
        ],
        StructField(
            "daily",
            StructType(
                [
                    StructField(
                        key, ArrayType(StringType() if key in _TEXT_DAILY_KEYS else DoubleType())
                    )
                    for key in DAILY_KEYS
                ]
            ),
        ),
        StructField(
            "daily_units", StructType([StructField(key, StringType()) for key in DAILY_KEYS])
        ),
    ]
)

# Timestamps stay text in the strict record.
WARNING_RECORD = StructType(
    [
        StructField(f.name, StringType() if isinstance(f.dataType, TimestampType) else f.dataType)
        for f in WARNING_WIRE
    ]
)


FAULTS = "faults"


def _names(keys: list[str]) -> Column:
    return F.array(*[F.lit(key) for key in keys])


def _is_scalar(value: Column) -> Column:
    """Null, text, number or boolean: all that text can stand for."""
    as_object = F.try_variant_get(value, "$", "map<string,variant>")
    return as_object.isNull() & F.try_variant_get(value, "$", "array<variant>").isNull()


def _is_number(value: Column) -> Column:
    return F.to_json(value).rlike("^(null|-?[0-9][-+0-9.eE]*)$")


def _is_whole(value: Column) -> Column:
    """Null or a number that the integer type holds as it is."""
    as_int = F.try_variant_get(value, "$", "int").cast("double")
    same = F.coalesce(as_int == F.try_variant_get(value, "$", "double"), F.lit(False))
    return F.is_variant_null(value) | (_is_number(value) & same)


def _are_numbers(value: Column) -> Column:
    # Of an array of numbers and nulls; other values hold other letters, quotes or brackets.
    return F.to_json(value).rlike(r"^(null|\[[-+0-9.eE,nul]*\])$")


def _are_scalars(value: Column) -> Column:
    items = F.try_variant_get(value, "$", "array<variant>")
    each = F.coalesce(F.forall(items, _is_scalar), F.lit(False))
    return F.is_variant_null(value) | each


_CHECKS = {
    "string": _is_scalar, "double": _is_number, "int": _is_whole,
    "array<string>": _are_scalars, "array<double>": _are_numbers,
}


# JSON texts of values that fit a type for certain.
_SHAPES = {
    "string": r'(?:"[^"\\]*"|[-+0-9.eE]+|null|true|false)',
    "double": r"(?:null|-?[0-9][-+0-9.eE]*)",
    "int": r"(?:null|-?[0-9]{1,9})",
    "array<string>": r"(?:null|\[[^\[\]{}]*\])",
    "array<double>": r"(?:null|\[[-+0-9.eE,nul]*\])",
}


def _shape(kind: DataType) -> str:
    """A pattern that only texts of values match that have all members of the type and no faults."""
    if not isinstance(kind, StructType):
        return _SHAPES[kind.simpleString()]
    members = [f'"{f.name}":{_shape(f.dataType)}' for f in sorted(kind, key=lambda f: f.name)]
    return r"\{" + ",".join(members) + r"\}"


def _is_sound(value: Column, kind: DataType) -> Column:
    return F.coalesce(F.to_json(value).rlike(f"^{_shape(kind)}$"), F.lit(False))


def _fault(path: Column, kind: str) -> Column:
    return F.struct(path.alias("path"), F.lit(kind).alias("kind"))


def _fits(name: Column, value: Column, schema: StructType) -> Column:
    """Whether a member's value can be cast to the type that the schema has for its name."""
    keys: dict[str, list[str]] = {}
    for field in schema:
        keys.setdefault(field.dataType.simpleString(), []).append(field.name)
    result = F.lit(True)
    for kind, own in keys.items():
        result = F.when(name.isin(*own), _CHECKS[kind](value)).otherwise(result)
    return result


def _member_faults(
    members: Column, prefix: Column, schema: StructType, *, closed: bool = True
) -> Column:
    """Faults of an object's members; an open object may hold members that the schema does not name."""
    keys, names = _names([field.name for field in schema]), F.map_keys(members)

    def path(name: Column) -> Column:
        return F.concat(prefix, name)

    missing = F.transform(F.array_except(keys, names), lambda k: _fault(path(k), "missing"))
    wrong = F.filter(F.map_entries(members), lambda e: ~_fits(e["key"], e["value"], schema))
    parts = [missing, F.transform(wrong, lambda e: _fault(path(e["key"]), "type"))]
    if closed:
        other = F.transform(F.array_except(names, keys), lambda k: _fault(path(k), "unknown"))
        parts.insert(1, other)
    return F.concat(*parts)


def _no_faults() -> Column:
    return F.array().cast("array<struct<path:string,kind:string>>")


def _has(faults: Column, kind: str, path: str | None = None, below: str | None = None) -> Column:
    """Whether there is a fault of the kind: anywhere, at a path, or below one."""

    def meant(fault: Column) -> Column:
        here = fault["kind"] == kind
        if path:
            here = here & (fault["path"] == path)
        return here & fault["path"].startswith(f"{below}.") if below else here

    return F.exists(faults, meant)


def _object_faults(value: Column, path: Column, schema: StructType) -> Column:
    """Faults of a value that has to be an object with just these members."""
    members = json_text.members(value)
    inside = _member_faults(members, F.concat(path, F.lit(".")), schema)
    return (
        F.when(_is_sound(value, schema), _no_faults())
        .when(members.isNull(), F.array(_fault(path, "not_an_object")))
        .otherwise(inside)
    )


def _weather_faults(top: Column) -> Column:
    own = StructType([f for f in WEATHER_RECORD if not isinstance(f.dataType, StructType)])
    parts = [_member_faults(top, F.lit("$."), own, closed=False)]
    for name in ("daily", "daily_units"):
        path, value = F.lit(f"$.{name}"), F.element_at(top, name)
        parts.append(
            F.when(value.isNull(), F.array(_fault(path, "missing"))).otherwise(
                _object_faults(value, path, WEATHER_RECORD[name].dataType)
            )
        )
    return F.when(top.isNull(), _no_faults()).otherwise(F.concat(*parts))


def decode_weather(responses: DataFrame) -> DataFrame:
    """Adds ``record``, ``faults`` and ``decode_error`` (NULL for a complete weather response).

    Unknown members are an error inside ``daily`` and ``daily_units`` and ignored at the top.
    """
    items = json_text.with_once(responses, "_items", json_text.read_variant(F.col("body")))
    doc, top, faults = F.col("_doc"), F.col("_top"), F.col(FAULTS)
    error = (
        F.when(doc.isNull(), "bad_json")
        .when(top.isNull(), "not_an_object")
        .when(F.size(faults) == 0, F.lit(None))
        .when(_has(faults, "missing", "$.daily"), "missing_key")
        .when(_has(faults, "not_an_object", "$.daily"), "daily_not_an_object")
        .when(_has(faults, "unknown", below="$.daily"), "daily_unknown_key")
        .when(_has(faults, "missing", below="$.daily"), "daily_missing_key")
        .when(_has(faults, "missing", "$.daily_units"), "missing_key")
        .when(_has(faults, "not_an_object", "$.daily_units"), "units_not_an_object")
        .when(_has(faults, "unknown", below="$.daily_units"), "units_unknown_key")
        .when(_has(faults, "missing", below="$.daily_units"), "units_missing_key")
        .when(_has(faults, "missing"), "missing_key")
        .otherwise("field_type")
    )
    record = F.try_variant_get(doc, "$", WEATHER_RECORD.simpleString())
    told = items.withColumn("_doc", json_text.one_variant(F.col("_items"))).withColumn(
        "_top", json_text.members(doc)
    )
    # Found once: the error and the record both ask for the faults.
    found = json_text.with_once(told, FAULTS, _weather_faults(top))
    return (
        found.withColumn(ERROR, error)
        .withColumn("record", F.when(F.col(ERROR).isNull(), record))
        .drop("_items", "_doc", "_top")
    )


def decode_warnings(responses: DataFrame, schema: StructType = WARNING_RECORD) -> DataFrame:
    """One row per member of every sound response, one row with ``decode_error`` per other one.

    A single member with a missing or an unknown name, or with a value that its type cannot hold
    without loss, rejects the response as a whole.
    """
    items = json_text.with_once(responses, "_items", json_text.read_variant(F.col("body")))
    doc, members, by_member = F.col("_doc"), F.col("_members"), F.col("_faults")

    def faults_of(value: Column, place: Column) -> Column:
        return _object_faults(value, F.concat(F.lit("$["), place.cast("string"), F.lit("]")), schema)

    def error_of(faults: Column) -> Column:
        return (
            F.when(_has(faults, "not_an_object"), "not_an_object")
            .when(_has(faults, "unknown"), "unknown_key")
            .when(_has(faults, "missing"), "missing_key")
            .when(F.size(faults) > 0, "field_type")
        )

    errors = F.array_compact(F.transform(by_member, error_of))
    error = (
        F.when(doc.isNull(), "bad_json")
        .when(members.isNull(), "not_an_array")
        .otherwise(F.get(errors, F.lit(0)))
    )
    record_type = schema.simpleString()
    records = F.when(
        F.col(ERROR).isNull(), F.try_variant_get(doc, "$", f"array<{record_type}>")
    ).otherwise(F.array(F.lit(None)))
    taken_apart = items.withColumn("_doc", json_text.one_variant(F.col("_items"))).withColumn(
        "_members", F.try_variant_get(doc, "$", "array<variant>")
    )
    found = json_text.with_once(taken_apart, "_faults", F.transform(members, faults_of))
    return (
        found.withColumn(ERROR, error)
        .withColumn(FAULTS, F.coalesce(F.flatten(by_member), _no_faults()))
        .withColumn("record", F.explode(records))
        .drop("_items", "_doc", "_members", "_faults")
    )


def list_faults(decoded: DataFrame, keep: list[str]) -> DataFrame:
    """One row for each fault: the kept columns, ``path`` and ``kind``."""
    return decoded.select(*keep, F.inline(FAULTS))
