"""Log records to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedloom.functions import json_text

REJECT_REASON = "reject_reason"
RAW = "raw"


def parse_log(
    log: DataFrame,
    schema: StructType,
    *,
    mode: str = "keep",
    keep: list[str] | None = None,
    source_tz: str | None = None,
) -> DataFrame:
    """Parse ``value`` of every log record and flatten the object into columns.

    ``mode="keep"``: one row out per record in, faults become NULL fields.
    ``mode="quarantine"``: the same rows plus ``reject_reason`` (NULL for a sound record) and
    ``raw``, the text of a rejected one. Split the two with ``accepted`` and ``rejected``.
    ``keep`` names log columns to carry along, such as the record's position.
    """
    carried = [F.col(name) for name in keep or []]
    text = json_text.decode(F.col("value"))
    if mode == "keep":
        parsed = json_text.parse(text, schema, source_tz)
        return log.select(*carried, parsed.alias("_data")).select(*(keep or []), "_data.*")
    if mode != "quarantine":
        raise ValueError(f"mode must be 'keep' or 'quarantine', not {mode!r}")

    corrupt = f"_data.{json_text.CORRUPT_FIELD}"
    parsed = json_text.parse_with_corrupt(F.col(RAW), schema, source_tz)
    texts = json_text.with_once(log.select(*carried, text.alias(RAW)), "_data", parsed)
    reason = _reject_reason(F.col(RAW), F.col("_data"), F.col(corrupt), schema)
    return texts.select(
        *(keep or []),
        *[F.col(f"_data.{field.name}").alias(field.name) for field in schema],
        reason.alias(REJECT_REASON),
        F.when(reason.isNotNull(), F.col(RAW)).alias(RAW),
    )


def _reject_reason(text: Column, data: Column, corrupt: Column, schema: StructType) -> Column:
    required = [data[field.name].isNull() for field in schema if not field.nullable]
    missing = F.lit(False)
    for is_missing in required:
        missing = missing | is_missing
    readable = F.from_json(corrupt, "map<string,string>").isNotNull()
    return (
        F.when(data.isNull(), "empty")
        .when(corrupt.isNotNull() & ~json_text.is_object(text), "not_an_object")
        .when(corrupt.isNotNull() & ~readable, "malformed")
        .when(corrupt.isNotNull(), "field_type")
        .when(missing, "missing_required")
    )


def accepted(df: DataFrame) -> DataFrame:
    """Rows without a reject reason."""
    return df.filter(F.col(REJECT_REASON).isNull()).drop(REJECT_REASON, RAW)


def rejected(df: DataFrame) -> DataFrame:
    """Rows with a reject reason."""
    return df.filter(F.col(REJECT_REASON).isNotNull())
