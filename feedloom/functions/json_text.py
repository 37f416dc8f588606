"""JSON text in and out of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# to_json cuts timestamps to milliseconds unless told otherwise.
_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ENCODE_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": f"{_MICROS}XXX",
    "timestampNTZFormat": _MICROS,
}

CORRUPT_FIELD = "_corrupt_record"


def with_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a column that is computed once per row, whatever is filtered on it later.

    A filter over a plain projection is pushed below it together with a copy of the expression, so a
    filter on a parsed field parses every text twice. A filter on a generated column stays above.
    """
    return df.select("*", F.inline(F.array(F.struct(column.alias(name)))))


def encode(*columns: Column) -> Column:
    """One JSON object per row as UTF-8 bytes, NULL fields kept."""
    return F.to_json(F.struct(*columns), ENCODE_OPTIONS).cast("binary")


def decode(value: Column) -> Column:
    return value.cast("string")


def _zone_option(source_tz: str | None) -> dict[str, str]:
    return {"timeZone": source_tz} if source_tz else {}


def parse(text: Column, schema: StructType, source_tz: str | None = None) -> Column:
    """The object in ``text`` under ``schema``; a field that does not fit is NULL."""
    return F.from_json(text, schema, _zone_option(source_tz))


def parse_with_corrupt(text: Column, schema: StructType, source_tz: str | None = None) -> Column:
    """Like ``parse``, with the whole text in ``_corrupt_record`` when anything did not fit."""
    widened = StructType([*schema.fields, StructField(CORRUPT_FIELD, StringType())])
    options = {**_zone_option(source_tz), "columnNameOfCorruptRecord": CORRUPT_FIELD}
    return F.from_json(text, widened, options)


def is_object(text: Column) -> Column:
    return text.rlike(r"^\s*\{")


# from_json ignores whatever follows the first complete value. To accept a text only when it is
# exactly one JSON value, it is read as the first of two items of an array: anything left over is
# then either malformed or pushes the end marker out of its place.


def _read_with_end(text: Column, end: str, item_type: str) -> Column:
    return F.from_json(
        F.concat(F.lit("["), text, F.lit(f",{end}]")),
        f"array<{item_type}>",
        {"allowSingleQuotes": "false"},
    )


def read_value(text: Column) -> Column:
    """Items to hand to ``is_one_value``: JSON text of the value, numbers normalised; the marker."""
    return _read_with_end(text, '"end"', "string")


def is_one_value(items: Column) -> Column:
    """True if the text was exactly one JSON value, which is then the first item."""
    return F.coalesce((F.size(items) == 2) & (F.get(items, F.lit(1)) == "end"), F.lit(False))


def read_array(text: Column) -> Column:
    """Items to hand to ``one_array``: the JSON texts of an array's members."""
    return _read_with_end(text, '["end"]', "array<string>")


def one_array(items: Column) -> Column:
    end = F.get(F.get(items, F.lit(1)), F.lit(0))
    return F.when((F.size(items) == 2) & (end == "end"), F.get(items, F.lit(0)))


def read_variant(text: Column) -> Column:
    """Items to hand to ``one_variant``: the value as a variant."""
    return _read_with_end(text, '"end"', "variant")


def one_variant(items: Column) -> Column:
    end = F.try_variant_get(F.get(items, F.lit(1)), "$", "string")
    return F.when((F.size(items) == 2) & (end == "end"), F.get(items, F.lit(0)))


def members(value: Column, path: str = "$") -> Column:
    """The members of the object at ``path`` in a variant by name; NULL if it is no object."""
    return F.try_variant_get(value, path, "map<string,variant>")
