"""Properties over made-up payloads."""

import json

from feedloom import schemas
from feedloom.functions import json_text
from feedloom.operators import parse
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

few = settings(
    max_examples=6, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck)
)

numbers = st.one_of(st.integers(-(10**12), 10**12), st.floats(allow_nan=False, allow_infinity=False))
texts = st.text(st.characters(codec="utf-8", exclude_categories=["Cc"]), max_size=6)
values = st.recursive(
    st.one_of(st.none(), st.booleans(), numbers, texts),
    lambda inner: st.one_of(
        st.lists(inner, max_size=3), st.dictionaries(texts, inner, max_size=3)
    ),
    max_leaves=8,
)


@st.composite
def payloads(draw):
    """JSON, often with something cut off, put after it or put before it."""
    text = json.dumps(draw(values), ensure_ascii=draw(st.booleans()))
    damage = draw(st.sampled_from(["none", "cut", "after", "before"]))
    extra = draw(st.text("[]{},:\"0a ", min_size=1, max_size=3))
    if damage == "cut":
        return text[: draw(st.integers(0, len(text)))]
    return {"none": text, "after": text + extra, "before": extra + text}[damage]


def loaded(text):
    try:
        return True, json.loads(text)
    except ValueError:
        return False, None


@few
@given(st.lists(payloads(), min_size=60, max_size=120))
def test_whole_values_are_those_that_load(spark, bodies):
    frame = spark.createDataFrame(list(enumerate(bodies)), "n int, body string")
    value, array = json_text.read_value(F.col("body")), json_text.read_array(F.col("body"))
    rows = frame.select(
        "body",
        json_text.is_one_value(value).alias("is_json"),
        F.get(value, F.lit(0)).alias("text"),
        json_text.one_array(array).alias("members"),
        json_text.one_variant(json_text.read_variant(F.col("body"))).isNotNull().alias("variant"),
    ).collect()
    for row in rows:
        is_json, value = loaded(row["body"])
        assert row["is_json"] == is_json, row["body"]
        assert row["variant"] == is_json, row["body"]
        assert (row["members"] is not None) == isinstance(value, list), row["body"]
        if isinstance(value, (dict, list)):
            assert json.loads(row["text"]) == value
        if isinstance(value, list):
            assert len(row["members"]) == len(value)


@few
@given(st.lists(st.one_of(st.none(), texts, payloads()), min_size=60, max_size=120))
def test_every_record_comes_out_once(spark, bodies):
    frame = spark.createDataFrame(list(enumerate(bodies)), "offset long, body string")
    log = frame.select("offset", F.col("body").cast("binary").alias("value"))
    kept = parse.parse_log(log, schemas.WARNING_WIRE, keep=["offset"])
    sorted_ = parse.parse_log(log, schemas.WARNING_WIRE, mode="quarantine", keep=["offset"])
    n = len(bodies)
    assert kept.select("offset").distinct().count() == kept.count() == n
    good, bad = parse.accepted(sorted_), parse.rejected(sorted_)
    assert good.count() + bad.count() == n
    assert {row["offset"]: row["raw"] for row in bad.collect()}.items() <= dict(
        enumerate(bodies)
    ).items()
