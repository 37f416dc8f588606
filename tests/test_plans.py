"""Physical plans: what must not be in them."""

import pytest
from feedloom.operators import responses
from feedloom.operators.encode import to_log
from feedloom.operators.requests import add_backfill_days
from feedloom.plans import daily, feeds, queries
from feedloom.schemas import LANDED_RESPONSE
from feedloom.sources import logs, regions
from pyspark.sql import functions as F

COSTLY = ["Exchange", "Join", "Cartesian", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("log"))
    logs.publish_files(to_log(spark.range(10), "t"), root, "t", "a")
    return logs.read_files(spark, root, "t")


@pytest.mark.parametrize("rows", [feeds.warning_rows, feeds.weather_rows])
@pytest.mark.parametrize("mode", ["keep", "quarantine"])
@pytest.mark.parametrize("id_mode", ["stable", "random"])
def test_log_to_rows_is_narrow(log, rows, mode, id_mode):
    text = plan(rows(log, mode=mode, id_mode=id_mode))
    assert not [word for word in COSTLY if word in text]
    scan = text[text.index("ReadSchema") :]
    assert "value:binary" in scan
    assert "key:binary" not in scan and "timestamp:timestamp" not in scan


@pytest.mark.parametrize("feed", ["warnings", "weather"])
def test_requests_have_no_join(spark, feed):
    # Blocks of grid rows are dealt over the tasks, by key; nothing else is exchanged.
    dealt = {"warnings": 0, "weather": 1}[feed]
    text = plan(daily.plan_requests(feed, regions.active_regions(spark), "2025-01-25"))
    assert not [word for word in COSTLY[1:] if word in text]
    assert text.count("Exchange") == text.count("Exchange hashpartitioning(region_id") == dealt
    days = add_backfill_days(
        regions.active_regions(spark), F.lit("2025-01-01"), F.lit("2025-12-31")
    )
    text = plan(daily.FEEDS[feed].requests(days))
    assert not [word for word in COSTLY[1:] if word in text]
    assert text.count("Exchange") == text.count("Exchange hashpartitioning(region_id") == dealt


def test_queries_deal_no_rows_round_robin(spark):
    for name in ("flat_parse", "enrich_encode", "strict_decode_weather", "request_grid"):
        text = plan(queries.QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert "RoundRobin" not in text and "BroadcastHashJoin" not in text


def test_enrichment_reads_each_document_once_and_parses_once(spark):
    text = plan(queries.enrich_encode(spark, "/root/testdata/sf0.001"))
    assert text.count("from_json") <= 2


def test_weather_log_takes_a_document_apart_once(spark):
    """One pattern for the members, and one walk for those that go too deep for it, asked for once."""
    landed = spark.createDataFrame([], LANDED_RESPONSE)
    text = plan(feeds.weather_log(responses.weather_documents(landed)))
    assert text.count("regexp_extract_all(") == 2 and text.count("aggregate(") == 1


def test_enrichment_takes_a_document_apart_once(spark):
    text = plan(queries.enrich_encode(spark, "/root/testdata/sf0.001"))
    assert text.count("regexp_extract_all(") == 2 and text.count("aggregate(") == 1


def test_runs_are_pruned(spark, log):
    text = plan(feeds.warning_rows(log.filter("run = 'a'")))
    assert "PartitionFilters: [isnotnull(run" in text


def test_one_field_prunes_the_parse(log):
    text = plan(feeds.warning_rows(log).select("region_id"))
    assert "RegionId" in text and "MainText" not in text
