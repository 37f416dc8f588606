"""Equal records of a run, and runs that were sent twice."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from feedloom.operators import encode
from feedloom.operators.encode import number_equal, to_log
from feedloom.plans import daily, feeds
from feedloom.sources import logs
from feedloom.streaming import once, runs, sinks

TOPIC = "t"


def _records(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    return to_log(rows, TOPIC, text=F.col("text"))


def _names(log):
    return Counter((bytes(r.value).decode(), r.partition) for r in log.collect())


def test_equal_records_are_numbered(spark):
    texts = ["a"] * 3 + ["b"] + ["c"] * 2 + [f"x{i}" for i in range(50)] + [""] * 2
    found = _names(number_equal(_records(spark, texts).repartition(5)))
    counts = Counter(texts)
    assert found == Counter({(t, i): 1 for t in counts for i in range(counts[t])})


def test_equal_places_of_different_records(spark, monkeypatch):
    """Records whose hashes agree are kept apart by their values; a full filter loses none."""
    monkeypatch.setattr(encode, "FILTER_PLACES", 2)
    log = _records(spark, ["a", "b", "a", "c"]).withColumn("offset", F.lit(5).cast("long"))
    assert _names(number_equal(log)) == Counter({("a", 0): 1, ("a", 1): 1, ("b", 0): 1, ("c", 0): 1})


def test_no_document_crosses_a_shuffle_on_publish(spark, tmp_path):
    """What a publish shuffles is places; documents move only where a place repeats."""
    documents = spark.createDataFrame(
        [("1", "T", "d", '{"RegId":1}', None, None)],
        "region_id string, region_name string, run_date string, document string, "
        "reject_reason string, raw string",
    )
    plan = feeds.warning_log(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    places = encode.repeated_places(_records(spark, ["a", "b"]))
    exchanges = [
        line for line in places._jdf.queryExecution().executedPlan().toString().splitlines()
        if "Exchange" in line
    ]
    assert exchanges and all("value" not in line for line in exchanges)


def test_publish_numbers_equal_records_and_leaves_nothing_else(spark, tmp_path):
    root = str(tmp_path)
    for run, texts in (("one", ["a", "a", "b"]), ("two", ["a", "c"])):
        logs.publish_files(_records(spark, texts), root, TOPIC, run, by_value=True)
    assert sorted(p.name for p in (tmp_path / TOPIC).iterdir()) == ["run=one", "run=two"]
    found = logs.read_files(spark, root, TOPIC).where("run = 'one'")
    assert _names(found) == Counter({("a", 0): 1, ("a", 1): 1, ("b", 0): 1})


def _ingest(spark, root, within="7 days"):
    log = logs.FileLog(root, once_within=within)
    rows = daily.stream_log(spark, log, TOPIC).select(
        F.col("value").cast("string").alias("text"), "run", "partition"
    )
    runs.run_to_end(rows, sinks.files(f"{root}/rows"), name="t", checkpoints=f"{root}/checkpoints")
    return sinks.read_files(spark, f"{root}/rows")


def test_half_published_run_is_repeated(spark, tmp_path):
    """Half a run, read; the whole run, read; a second run with the same texts; each record once."""
    root, texts = str(tmp_path), [f"text {i}" for i in range(40)] + ["same"] * 4
    run = number_equal(_records(spark, texts))
    half = run.where("pmod(offset + partition, 2) = 0")
    for sent, label in ((half, "a"), (run, "a"), (run, "b")):
        sent.write.mode("append").parquet(logs.run_path(root, TOPIC, label))
        found = _ingest(spark, root)
        assert found.count() == found.select("text", "run", "partition").distinct().count()
    assert found.groupBy("run").count().collect() and found.count() == 2 * len(texts)
    counts = Counter(r.text for r in found.where("run = 'a'").collect())
    assert counts == Counter(texts)


def test_both_attempts_in_one_batch(spark, tmp_path):
    root = str(tmp_path)
    run = number_equal(_records(spark, ["a", "b", "b", "c"]))
    for _ in range(2):
        run.write.mode("append").parquet(logs.run_path(root, TOPIC, "a"))
    assert _names(once.drop_repeats(logs.read_files(spark, root, TOPIC), "")) == Counter(
        {("a", 0): 1, ("b", 0): 1, ("b", 1): 1, ("c", 0): 1}
    )
    assert _ingest(spark, root).count() == 4


def test_old_files_are_not_late(spark, tmp_path):
    """The names' clock is the reader's: files of any age are read."""
    from feedloom.sources import storage

    root = str(tmp_path)
    for label, texts in (("new", ["a"]), ("old", ["b", "c"])):
        logs.publish_files(_records(spark, texts), root, TOPIC, label, by_value=True)
        if label == "old":
            storage.set_age(spark, logs.run_path(root, TOPIC, label), days=900)
        found = _ingest(spark, root, "1 second")
    assert found.count() == 3


def test_kafka_records_name_themselves(spark):
    """What is sent names run and record; read back with headers, a repeat is passed over."""
    run = number_equal(_records(spark, ["a", "b", "b"]))
    sent = logs.kafka_records(run, "r1")
    assert sent.columns == ["key", "value", "headers"]
    kinds = {f.name: f.dataType for f in sent.schema["headers"].dataType.elementType}
    assert kinds == {"key": StringType(), "value": BinaryType()}
    again = logs.kafka_records(run, "r2")
    topic = sent.unionByName(sent).unionByName(again).select(
        "*", F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
    )
    foreign = topic.limit(2).withColumn("headers", F.lit(None).cast(topic.schema["headers"].dataType))
    found = once.drop_repeats(topic.unionByName(foreign.withColumn("offset", F.col("offset") - 99)), "")
    assert found.columns == topic.columns
    assert found.where("headers IS NOT NULL").count() == 6
    assert found.where("headers IS NULL").count() == 2
    first = found.where("value = X'61' AND headers IS NOT NULL").first()
    head = {h["key"]: bytes(h["value"]).decode() for h in first.headers}
    assert head["record"] == "0:" + hashlib.sha256(b"a").hexdigest() and head["run"] in ("r1", "r2")


def test_kafka_publish_stages_and_reads_headers(spark, monkeypatch):
    options = logs.kafka_options("t", "broker:1", headers=True)
    assert options["includeHeaders"] == "true"
    seen = []
    monkeypatch.setattr(logs, "read_kafka", lambda _, given: seen.append(given))
    logs.open_log("kafka:broker:1", once_within="7 days").stream(spark, "t")
    logs.open_log("kafka:broker:1").stream(spark, "t")
    assert ["includeHeaders" in given for given in seen] == [True, False]
    with pytest.raises(Exception, match="(?i)kafka"):
        logs.publish_kafka(_records(spark, ["a"]), "t", "broker:1", "r")
