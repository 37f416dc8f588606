"""What has changed in the documents of a log, against the schema they are read with.

Parsing with a fixed schema passes over members it does not know and reads vanished ones as NULL. Here the
documents' own members are counted and typed, in one aggregate whose rows are members, and compared with
the schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    MapType,
    NumericType,
    StructType,
)

from feedloom.functions import json_text

UNKNOWN, VANISHED, TYPE = "unknown", "vanished", "type"


def _kind(wanted: DataType) -> str:
    """A pattern for the types, as a variant's schema names them, that can be read as this one."""
    number = r"BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\)"
    if isinstance(wanted, StructType | MapType):
        return "OBJECT<.*>"
    if isinstance(wanted, ArrayType):
        return f"ARRAY<({_kind(wanted.elementType)}|VOID)>"
    if isinstance(wanted, BooleanType):
        return "BOOLEAN"
    if isinstance(wanted, NumericType):
        return number
    if wanted.typeName() == "string":
        return f"STRING|BOOLEAN|VARIANT|{number}"  # VARIANT: values of several kinds
    return "STRING"  # times are texts on the wire


def expected_members(schema: StructType, prefix: str = "") -> list[tuple[str, str]]:
    """The paths of a schema's members, those of nested objects too, with patterns of their types."""
    out = []
    for field in schema:
        path = prefix + field.name
        out.append((path, f"^({_kind(field.dataType)}|VOID)$"))
        if isinstance(field.dataType, StructType):
            out += expected_members(field.dataType, f"{path}.")
    return out


def _entries(document: Column, schema: StructType, prefix: str = "", path: str = "$") -> list[Column]:
    """Arrays of the members, (path, value), of an object and of the objects that the schema nests."""
    members = json_text.members(document, path)
    pair = F.transform(
        F.map_entries(members),
        lambda e: F.struct(F.concat(F.lit(prefix), e["key"]).alias("path"), e["value"].alias("value")),
    )
    out = [F.coalesce(pair, F.array().cast("array<struct<path:string,value:variant>>"))]
    for field in schema:
        if isinstance(field.dataType, StructType):
            out += _entries(document, field.dataType, f"{prefix}{field.name}.", f"{path}.{field.name}")
    return out


def observed_members(log: DataFrame, schema: StructType, by: list[str] | None = None) -> DataFrame:
    """``path``, ``n_documents`` and ``seen_type`` of every member, for each value of the ``by`` columns.

    The members of a document are rows of one narrow step; counts and types are merged before the shuffle.
    """
    by = by or []
    document = F.try_parse_json(json_text.decode(F.col("value")))
    rows = json_text.with_once(log.select(*by, "value"), "_doc", document)
    members = rows.select(*by, F.inline(F.concat(*_entries(F.col("_doc"), schema))))
    return members.groupBy(*by, "path").agg(
        F.count("*").alias("n_documents"), F.schema_of_variant_agg("value").alias("seen_type")
    )


def drift(log: DataFrame, schema: StructType) -> DataFrame:
    """Members in which a log differs from a schema: ``path``, ``change``, ``n_documents``, ``seen_type``.

    ``unknown``: documents have a member that the schema lacks; ``vanished``: no document has it;
    ``type``: some value cannot be read as the schema's type. Documents that are no objects have no
    members. An unknown object is one member. Text can stand for values of several kinds.
    """
    spark = log.sparkSession
    wanted = spark.createDataFrame(expected_members(schema), "path string, pattern string")
    seen = observed_members(log, schema)
    change = (
        F.when(F.col("n_documents").isNull(), VANISHED)
        .when(F.col("pattern").isNull(), UNKNOWN)
        .when(~F.expr("seen_type RLIKE pattern"), TYPE)
    )
    both = seen.join(wanted, "path", "full").withColumn("change", change)
    return both.where(F.col("change").isNotNull()).select(
        "path", "change", F.coalesce("n_documents", F.lit(0)).alias("n_documents"), "seen_type"
    )
