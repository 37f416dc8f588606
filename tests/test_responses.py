"""Response gates, enrichment and strict decode."""

import json

import pytest
from feedloom import schemas
from feedloom.operators import decode, parse, responses
from feedloom.plans import feeds
from feedloom.schemas import LANDED_RESPONSE

ONE = '{"RegId":1,"MainText":"a"}'


def landed(spark, *cases):
    rows = [("3022", "Trollheimen", "2025-01-24", status, body) for status, body in cases]
    return spark.createDataFrame(rows, LANDED_RESPONSE)


WARNING_CASES = [
    ((200, f"[{ONE}]"), ONE, None),
    ((200, f' [{ONE},\n{{"RegId":2}}] '), ONE, None),
    ((200, "[null]"), "null", None),
    ((200, "[]"), None, "empty_array"),
    ((200, "null"), None, "not_an_array"),
    ((200, ONE), None, "not_an_array"),
    ((200, "5"), None, "not_an_array"),
    ((200, f"[{ONE}"), None, "bad_json"),
    ((200, f"[{ONE},"), None, "bad_json"),
    ((200, f"[{ONE}]]"), None, "bad_json"),
    ((200, f"[{ONE}][{ONE}]"), None, "bad_json"),
    ((200, f"[{ONE}] <html>"), None, "bad_json"),
    ((200, "<html>"), None, "bad_json"),
    ((200, ""), None, "bad_json"),
    ((200, None), None, "bad_json"),
    ((500, f"[{ONE}]"), None, "status"),
    ((204, ""), None, "status"),
    ((None, f"[{ONE}]"), None, "status"),
]


def test_warning_gate(spark):
    for (response, document, reason), row in zip(
        WARNING_CASES,
        responses.warning_documents(landed(spark, *[case[0] for case in WARNING_CASES])).collect(),
    ):
        assert (row["document"], row["reject_reason"]) == (document, reason), response


WEATHER_CASES = [
    ((200, '{"latitude":62.9}'), None),
    ((200, "{}"), None),
    ((200, "[]"), "not_an_object"),
    ((200, "null"), "not_an_object"),
    ((200, '{"latitude":62.9}}'), "bad_json"),
    ((200, '{"latitude":62.9},{}'), "bad_json"),
    ((200, '{"latitude":'), "bad_json"),
    ((500, '{"error":true}'), "status"),
]


def test_weather_gate(spark):
    frame = landed(spark, *[case[0] for case in WEATHER_CASES])
    reasons = [row["reject_reason"] for row in responses.weather_documents(frame).collect()]
    assert reasons == [reason for _, reason in WEATHER_CASES]
    unchecked = responses.weather_documents(frame, check_status=False).collect()
    assert unchecked[-1]["reject_reason"] is None


@pytest.mark.parametrize(
    "body",
    [
        "{}",
        '{"latitude":62.9,"daily":{"time":["2025-01-24"]},"x":null}',
        ' {"elevation":812.0, "text":"æ \\" } {", "n":1e2}\n',
        '{"region_id":"old","elevation":812.0,"start_date":1}',
        '{"region_id":"only"}',
        '{"region_id":{"region_id":[1,{"start_date":2}]},"a":{"region_id":3,"b":[",",{}]},"end_date":null}',
        '{"a":"region_id","b":["region_name",{"end_date":1}],"region_name":"x","c":"}, \\" {","d":[[],{}]}',
        '{ "start_date" : 1 , "end_date" : 2 , "æøå" : "😀" , "region_id" : "\\\\" , "z" : [ 1 , 2 ] }',
        '{"region_id":1,"region_id":2,"x":1.10,"region_id":3}',
    ],
)
def test_enrich_is_a_dict_update(spark, body):
    frame = responses.enrich_weather(responses.weather_documents(landed(spark, (200, body))))
    expected = json.loads(body)
    for name in ("start_date", "end_date"):
        expected[name] = "2025-01-24"
    expected |= {"region_id": "3022", "region_name": "Trollheimen"}
    document = frame.collect()[0]["document"]
    assert json.loads(document) == expected
    pairs = json.loads(document, object_pairs_hook=list)
    assert len({name for name, _ in pairs}) == len(pairs)


def test_good_and_rejected_add_up(spark):
    frame = responses.warning_documents(landed(spark, *[case[0] for case in WARNING_CASES]))
    good, bad = parse.accepted(frame), parse.rejected(frame)
    assert good.count() == 3 and good.count() + bad.count() == len(WARNING_CASES)
    assert feeds.warning_rows(feeds.warning_log(frame)).count() == 3


def full_response():
    return {
        "latitude": 62.9,
        "longitude": 9.6,
        "generationtime_ms": 0.2,
        "utc_offset_seconds": 3600,
        "timezone": "Europe/Berlin",
        "timezone_abbreviation": "CET",
        "elevation": 812.0,
        "daily": {key: [1] for key in schemas.DAILY_KEYS},
        "daily_units": {key: "u" for key in schemas.DAILY_KEYS},
    }


def changed(change):
    response = full_response()
    change(response)
    return json.dumps(response)


STRICT_WEATHER = {
    "good": (changed(lambda r: None), None),
    "null_value": (changed(lambda r: r.update(latitude=None)), None),
    "unknown_top": (changed(lambda r: r.update(extra=1)), None),
    "missing_top": (changed(lambda r: r.pop("elevation")), "missing_key"),
    "missing_daily": (changed(lambda r: r.pop("daily")), "missing_key"),
    "missing_units": (changed(lambda r: r.pop("daily_units")), "missing_key"),
    "daily_array": (changed(lambda r: r.update(daily=[])), "daily_not_an_object"),
    "unknown_in_daily": (changed(lambda r: r["daily"].update(x=[])), "daily_unknown_key"),
    "missing_in_daily": (changed(lambda r: r["daily"].pop("rain_sum")), "daily_missing_key"),
    "unknown_in_units": (changed(lambda r: r["daily_units"].update(x="")), "units_unknown_key"),
    "missing_in_units": (changed(lambda r: r["daily_units"].pop("time")), "units_missing_key"),
    "array": ("[]", "not_an_object"),
    "junk": ("{} x", "bad_json"),
}


@pytest.mark.parametrize("case", STRICT_WEATHER)
def test_strict_weather(spark, case):
    body, error = STRICT_WEATHER[case]
    row = decode.decode_weather(landed(spark, (200, body))).collect()[0]
    assert row["decode_error"] == error
    assert (row["record"] is None) == (error is not None)
    if error is None:
        assert row["record"]["elevation"] == 812.0
        assert row["record"]["daily"]["weathercode"] == ["1"]
        assert row["record"]["daily"]["rain_sum"] == [1.0]
        assert row["record"]["daily_units"]["rain_sum"] == "u"


def member(**changes):
    row = {field.name: 1 for field in schemas.WARNING_WIRE}
    row.update(changes)
    return row


def test_strict_warnings(spark):
    short = member()
    del short["LangKey"]
    bodies = [
        [member(RegId=1, ValidFrom="2025-01-24"), member(RegId=2, MainText=None)],
        [member(RegId=3), member(X=1)],
        [member(RegId=4), short],
        [],
        ["text"],
        {"a": 1},
    ]
    frame = landed(spark, *[(200, json.dumps(body)) for body in bodies])
    rows = decode.decode_warnings(frame).collect()
    assert [(r["record"] and r["record"]["RegId"], r["decode_error"]) for r in rows] == [
        (1, None),
        (2, None),
        (None, "unknown_key"),
        (None, "missing_key"),
        (None, "not_an_object"),
        (None, "not_an_array"),
    ]
    assert rows[0]["record"]["ValidFrom"] == "2025-01-24"


def _faults(spark, decode_, body):
    row = decode_(landed(spark, (200, body))).first()
    return sorted((f["path"], f["kind"]) for f in row["faults"]), row["decode_error"]


def test_all_faults_of_a_weather_response(spark):
    sound = full_response()
    assert _faults(spark, decode.decode_weather, json.dumps(sound)) == ([], None)
    # Sound, though not of the usual shape: other order, spaces, brackets in text, extra members.
    odd = {"more": {"a": [1]}, **dict(reversed(sound.items())), "timezone": 'a "b" [c] {d}'}
    odd["daily"] = sound["daily"] | {"time": ["x]", "{y", None, True], "rain_sum": None}
    assert _faults(spark, decode.decode_weather, json.dumps(odd, indent=2)) == ([], None)

    bad = full_response()
    del bad["timezone"]
    bad |= {"latitude": "62.9", "elevation": [1], "timezone_abbreviation": {"a": 1}}
    bad["daily"] = sound["daily"] | {"x": 1, "rain_sum": [1, "wet"], "snowfall_sum": [True], "time": [[1]]}
    del bad["daily"]["weathercode"]
    bad["daily_units"] = sound["daily_units"] | {"time": ["u"], "y": None}
    assert _faults(spark, decode.decode_weather, json.dumps(bad)) == (
        [
            ("$.daily.rain_sum", "type"), ("$.daily.snowfall_sum", "type"), ("$.daily.time", "type"),
            ("$.daily.weathercode", "missing"), ("$.daily.x", "unknown"), ("$.daily_units.time", "type"),
            ("$.daily_units.y", "unknown"), ("$.elevation", "type"), ("$.latitude", "type"),
            ("$.timezone", "missing"), ("$.timezone_abbreviation", "type"),
        ],
        "daily_unknown_key",
    )
    gone = full_response() | {"daily": [1]}
    del gone["daily_units"]
    assert _faults(spark, decode.decode_weather, json.dumps(gone)) == (
        [("$.daily", "not_an_object"), ("$.daily_units", "missing")], "daily_not_an_object",
    )
    for body, error in (("[1]", "not_an_object"), ("{", "bad_json"), (None, "bad_json")):
        assert _faults(spark, decode.decode_weather, body) == ([], error)


def test_all_faults_of_warnings(spark):
    members = [member(), member(RegId=1.0, RegionName="a"), member(RegId=1.5, X=1), "text", member(LangKey=2**40)]
    del members[4]["MainText"]
    assert _faults(spark, decode.decode_warnings, json.dumps(members)) == (
        [
            ("$[2].RegId", "type"), ("$[2].X", "unknown"), ("$[3]", "not_an_object"),
            ("$[4].LangKey", "type"), ("$[4].MainText", "missing"),
        ],
        "unknown_key",
    )
    listed = decode.list_faults(decode.decode_warnings(landed(spark, (200, json.dumps(members)))), ["region_id"])
    assert listed.columns == ["region_id", "path", "kind"] and listed.count() == 5


def test_strict_decode_names_no_type_texts(spark):
    """Neither decode asks for a value's type as text, nor explodes and regroups."""
    frame = landed(spark, (200, "{}"))
    for decode_ in (decode.decode_weather, decode.decode_warnings):
        plan = decode_(frame)._jdf.queryExecution().optimizedPlan().toString()
        assert "schema_of_variant" not in plan and "Aggregate" not in plan


def test_a_long_response_of_warnings(spark):
    body = json.dumps([member(RegId=n) for n in range(20_000)] + [member(RegId="1")])
    assert _faults(spark, decode.decode_warnings, body) == ([("$[20000].RegId", "type")], "field_type")


def test_enriching_a_long_document_takes_time_in_proportion(spark):
    """One old member beside half a million tokens: no state grows with them."""
    body = json.dumps({"region_id": "old", "values": [[i, f"text {i}"] for i in range(60_000)], "z": 1})
    frame = responses.enrich_weather(responses.weather_documents(landed(spark, (200, body))))
    found = json.loads(frame.first()["document"])
    assert found["region_id"] == "3022" and len(found["values"]) == 60_000 and found["z"] == 1


@pytest.mark.parametrize("depth", [1, 7, 8, 9, 10, 30])
def test_enriching_nested_documents_of_any_depth(spark, depth):
    """Members come out with the same text whether the pattern or the walk tells them."""
    inner = '{"region_id":"own","b":[",}",{}],"c d":"\\\\\\" ]"}'
    for level in range(depth):
        inner = f'[{inner},"{level}"]' if level % 2 else f'{{"end_date":{inner}}}'
    body = f'{{"region_id":1, "a" : {inner} ,\n"end_date":{inner}, "n":1.10,"region_id":[2]}}'
    frame = responses.enrich_weather(responses.weather_documents(landed(spark, (200, body))))
    added = {"start_date": "2025-01-24", "end_date": "2025-01-24", "region_id": "3022"}
    tail = json.dumps(added | {"region_name": "Trollheimen"}, separators=(",", ":"))[1:]
    assert frame.first()["document"] == f'{{"a":{inner},"n":1.10,{tail}'
