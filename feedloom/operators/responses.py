"""Landed responses to documents: gate, pick, enrich.

Every operator keeps one row per response and sets ``reject_reason`` on those that cannot go on, so
one bad response never stops the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import json_text
from feedloom.functions.arrays import using
from feedloom.operators.parse import REJECT_REASON

OK_STATUS = 200

_JSON_SPACE = " \t\r\n"


def _trimmed(text: Column) -> Column:
    """The text without JSON space at its ends; only one that has some there is read for it."""
    has_space = F.lit(False)
    for space in _JSON_SPACE:
        has_space = has_space | text.startswith(space) | text.endswith(space)
    return F.when(has_space, F.btrim(text, F.lit(_JSON_SPACE))).otherwise(text)


def _status_fault(status: Column) -> Column:
    return ~status.eqNullSafe(F.lit(OK_STATUS))


def warning_documents(responses: DataFrame) -> DataFrame:
    """Adds ``document``, the first member of the response's array, and ``reject_reason``."""
    parsed = json_text.with_once(responses, "_items", json_text.read_array(F.col("body")))
    members = F.col("_members")
    first = F.coalesce(F.get(members, F.lit(0)), F.lit("null"))
    other_json = json_text.is_one_value(json_text.read_value(F.col("body")))
    reason = (
        F.when(_status_fault(F.col("status")), "status")
        .when(members.isNull() & ~other_json, "bad_json")
        .when(members.isNull(), "not_an_array")
        .when(F.size(members) == 0, "empty_array")
    )
    return (
        parsed.withColumn("_members", json_text.one_array(F.col("_items")))
        .withColumn(REJECT_REASON, reason)
        .withColumn("document", F.when(F.col(REJECT_REASON).isNull(), first))
        .drop("_items", "_members")
    )


def weather_documents(responses: DataFrame, check_status: bool = True) -> DataFrame:
    """Adds ``document``, the response's object as it came, and ``reject_reason``.

    ``check_status=False`` lets the body of a failed request through when it is an object.
    """
    parsed = json_text.with_once(responses, "_items", json_text.read_value(F.col("body")))
    value = F.get(F.col("_items"), F.lit(0))
    fault = _status_fault(F.col("status")) if check_status else F.lit(False)
    reason = (
        F.when(fault, "status")
        .when(~json_text.is_one_value(F.col("_items")), "bad_json")
        .when(value.isNull() | ~json_text.is_object(value), "not_an_object")
    )
    return (
        parsed.withColumn(REJECT_REASON, reason)
        .withColumn(
            "document",
            F.when(F.col(REJECT_REASON).isNull(), _trimmed(F.col("body"))),
        )
        .drop("_items")
    )


# Tokens of a JSON text in which no string holds an escaped quote: strings, marks, and all others.
_TOKEN = r'"[^"]*"|[{}\[\],:]|[^\s"{}\[\],:]+'

# Stand for an escaped backslash and an escaped quote; JSON texts cannot hold these characters.
_HELD = [("\\\\", "\x01"), ('\\"', "\x02")]


# What may stand inside brackets that go so many levels down: no state and no way back, so one pass.
_LEVELS = 8
_INSIDE = r'(?:[^"{}\[\]]++|"[^"]*+")*+'
for _ in range(_LEVELS - 1):
    _INSIDE = rf'(?:[^"{{}}\[\]]++|"[^"]*+"|[{{\[]{_INSIDE}[}}\]])*+'

# A member of an object: its name, and all up to a comma that is in no string and in no brackets.
_MEMBER = rf'\s*+"[^"]*+"(?:[^"{{}}\[\],]++|"[^"]*+"|[{{\[]{_INSIDE}[}}\]])*+'

# Space, and strings, which keep theirs.
_SPACE_OR_STRING = r'\s++|("[^"]*+")'


def _walked(text: Column, names: list[str]) -> Column:
    """The members of an object's text but those of these names, by one walk over its tokens.

    The walk keeps offsets only: how deep it is, where the member began, and the spans of the members that
    go. The text is cut at those spans afterwards, so the work grows with its length.
    """
    spans = F.array().cast("array<struct<start:int,stop:int>>")
    first = {"depth": F.lit(0), "at": F.lit(0), "start": F.lit(0), "old": F.lit(False), "spans": spans}

    def step(state: Column, token: Column) -> Column:
        depth, at, start = state["depth"], state["at"], state["start"]
        after = depth + F.when(token.isin("{", "["), 1).when(token.isin("}", "]"), -1).otherwise(0)
        old = F.when((depth == 1) & (at == start), token.isin(*[f'"{n}"' for n in names])).otherwise(
            state["old"]
        )
        ends = (depth == 1) & token.isin(",", "}")
        span = F.struct(start.alias("start"), at.alias("stop"))
        parts = {
            "depth": after,
            "at": at + F.length(token),
            "start": F.when(ends | (depth == 0), at + F.length(token)).otherwise(start),
            "old": old,
            "spans": F.when(ends & state["old"], F.array_append(state["spans"], span)).otherwise(
                state["spans"]
            ),
        }
        return F.struct(*[column.alias(name) for name, column in parts.items()])

    def cut(bare: Column, gone: Column) -> Column:
        # What lies before, between and behind the spans, inside the object's own brackets.
        starts = F.concat(F.array(F.lit(1)), gone["stop"])
        stops = F.concat(gone["start"], F.array(F.length(bare) - 1))
        pairs = F.arrays_zip(starts.alias("start"), stops.alias("stop"))
        runs = F.transform(
            pairs, lambda p: F.btrim(bare.substr(p["start"] + 1, p["stop"] - p["start"]), F.lit(","))
        )
        return F.array_join(F.filter(runs, lambda run: run != ""), ",")

    def without(tokens: Column) -> Column:
        gone = F.aggregate(tokens, F.struct(*[c.alias(n) for n, c in first.items()]), step)["spans"]
        return using(F.array_join(tokens, ""), lambda bare: using(gone, lambda spans: cut(bare, spans)))

    return using(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), without)


def _without(document: Column, names: list[str]) -> Column:
    """The inside of an object's text without the members of these names, and without space around tokens.

    A pattern takes the text apart into its members, whatever its length. Where members go deeper than
    the pattern does, they do not make up the text again, and a walk over the tokens tells them.
    """
    for escape, held in _HELD:
        document = F.replace(document, F.lit(escape), F.lit(held))

    def bare(member: Column) -> Column:
        return F.when(
            member.rlike(r"\s"), F.regexp_replace(member, _SPACE_OR_STRING, "$1")
        ).otherwise(member)

    def stays(member: Column) -> Column:
        old = F.lit(False)
        for name in names:
            old = old | member.startswith(f'"{name}"')
        return ~old

    def without(text: Column) -> Column:
        inside = F.substring(text, F.lit(2), F.length(text) - 2)

        def kept(members: Column) -> Column:
            whole = F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}")) == text
            rest = F.array_join(F.filter(F.transform(members, bare), stays), ",")
            return F.when(whole, rest).otherwise(_walked(text, names))

        return using(F.regexp_extract_all(inside, F.lit(_MEMBER), F.lit(0)), kept)

    rest = using(document, without)
    for escape, held in _HELD:
        rest = F.replace(rest, F.lit(held), F.lit(escape))
    return rest


def add_members(document: Column, members: dict[str, Column]) -> Column:
    """The JSON object in ``document`` with these string members set, all others as they were.

    Members go in at the end of the text. Only where one of the names occurs in it, the text is taken
    apart into its members, so that old values are dropped; the others keep their text, so numbers
    are not read and written again. A name that is spelt with escapes is not recognised.
    """
    added = F.to_json(
        F.struct(*[value.cast("string").alias(name) for name, value in members.items()]),
        {"ignoreNullFields": "false"},
    )
    names = list(members)

    def others(text: Column) -> Column:
        occurs = F.lit(False)
        for name in names:
            occurs = occurs | text.contains(f'"{name}"')
        inside = F.substring(text, F.lit(2), F.length(text) - 2)
        return F.when(occurs, _without(text, names)).otherwise(inside)

    def joined(head: Column, new: Column) -> Column:
        tail = F.substring(new, F.lit(2), F.length(new))
        return F.when(~head.rlike(rf"[^{_JSON_SPACE}]"), new).otherwise(
            F.concat(F.lit("{"), head, F.lit(","), tail)
        )

    head = using(_trimmed(document), others)
    return using(head, lambda head: using(added, lambda new: joined(head, new)))


def enrich_weather(documents: DataFrame) -> DataFrame:
    """Put the request's region and day into each accepted document."""
    added = {
        "start_date": F.col("run_date"),
        "end_date": F.col("run_date"),
        "region_id": F.col("region_id"),
        "region_name": F.col("region_name"),
    }
    return documents.withColumn("document", add_members(F.col("document"), added))
