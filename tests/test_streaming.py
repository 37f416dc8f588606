"""Streams: same rows as batch, nothing lost or doubled on rerun, replay and restart."""

import pytest
from feedloom import schemas
from feedloom.__main__ import main
from feedloom.operators import responses, shape
from feedloom.operators.encode import number_equal, to_log
from feedloom.plans import daily, feeds
from feedloom.sources import landed, logs, regions
from feedloom.streaming import keyed, runs, sinks, tables
from pyspark.sql import functions as F

TOPIC = schemas.WARNING_TOPIC


def warnings(spark, numbers, text="first"):
    frame = spark.createDataFrame([(n,) for n in numbers], "n int")
    return frame.select(
        F.col("n").alias("RegId"),
        F.lit(3022).alias("RegionId"),
        F.lit(10).alias("RegionTypeId"),
        F.lit(1).alias("LangKey"),
        F.lit(text).alias("MainText"),
    )


def publish(spark, root, run, numbers, text="first"):
    log = to_log(warnings(spark, numbers, text).repartition(4), TOPIC)
    logs.publish_files(log, root, TOPIC, run)


def ingest(spark, root, sink, checkpoints="checkpoints", max_files=1):
    rows = feeds.warning_rows(logs.stream_files(spark, root, TOPIC, max_files=max_files))
    runs.run_to_end(rows, sink, name="warnings", checkpoints=f"{root}/{checkpoints}")


def ids(df):
    return sorted(row["id"] for row in df.select("id").collect())


def test_same_rows_as_batch_then_nothing_more(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, "a", range(100))
    sink = sinks.files(f"{root}/rows")
    for _ in range(2):
        ingest(spark, root, sink)
    stored = spark.read.parquet(f"{root}/rows")
    batch = feeds.warning_rows(logs.read_files(spark, root, TOPIC))
    assert ids(stored) == ids(batch) and stored.count() == 100
    assert len(sink.batches(spark)) == 4


def test_resume_reads_only_what_is_new(spark, tmp_path):
    root = str(tmp_path)
    sink = sinks.files(f"{root}/rows")
    publish(spark, root, "a", range(100))
    ingest(spark, root, sink)
    publish(spark, root, "b", range(100, 150))
    ingest(spark, root, sink)
    stored = spark.read.parquet(f"{root}/rows")
    assert stored.count() == 150 == len(set(ids(stored)))


def test_replayed_batch_replaces_itself(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, "a", range(100))
    batch = feeds.warning_rows(logs.read_files(spark, root, TOPIC))
    sink = sinks.files(f"{root}/rows")
    files = []
    for _ in range(2):
        sink.write(batch, 0)
        files.append(sorted(spark.read.parquet(f"{root}/rows").inputFiles()))
    assert spark.read.parquet(f"{root}/rows").count() == 100 and files[0] == files[1]
    # An attempt that did not finish is written anew.
    (tmp_path / "rows" / "_finished" / "0").unlink()
    sink.write(batch, 0)
    files.append(sorted(spark.read.parquet(f"{root}/rows").inputFiles()))
    assert spark.read.parquet(f"{root}/rows").count() == 100 and files[1] != files[2]

    tables.create_namespace(spark, "replays")
    tables.create_table(spark, "replays.warnings", schemas.WARNING_SINK)
    sink = sinks.table("replays.warnings")
    for batch_id in (0, 0, 1):
        sink.write(batch, batch_id)
    assert spark.table("replays.warnings").count() == 200
    assert sink.batches(spark) == [0, 1]


def test_new_checkpoint_on_a_filled_sink_is_refused(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, "a", range(10))
    ingest(spark, root, sinks.files(f"{root}/rows"))
    with pytest.raises(ValueError, match="holds batches"):
        ingest(spark, root, sinks.files(f"{root}/rows"), checkpoints="others")
    ingest(spark, root, sinks.files(f"{root}/more"), checkpoints="others")
    assert ids(spark.read.parquet(f"{root}/more")) == ids(spark.read.parquet(f"{root}/rows"))


def test_run_is_published_once(spark, tmp_path):
    publish(spark, str(tmp_path), "a", range(10))
    with pytest.raises(ValueError, match="already exists"):
        publish(spark, str(tmp_path), "a", range(10))
    assert logs.read_files(spark, str(tmp_path), TOPIC).count() == 10


def test_half_written_run_is_not_seen(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, "a", range(10))
    (tmp_path / TOPIC / "run=a").rename(tmp_path / TOPIC / "_staging-b")
    publish(spark, root, "c", range(3))
    assert logs.read_files(spark, root, TOPIC).count() == 3
    ingest(spark, root, sinks.files(f"{root}/rows"))
    assert sinks.read_files(spark, f"{root}/rows").count() == 3
    publish(spark, root, "b", range(4))
    assert logs.read_files(spark, root, TOPIC).count() == 7


def test_unfinished_batch_is_not_read(spark, tmp_path):
    sink, path = sinks.files(f"{tmp_path}/rows"), f"{tmp_path}/rows"
    for number in range(3):
        sink.write(spark.range(3), number)
    (tmp_path / "rows" / "_finished" / "1").unlink()
    assert sinks.read_files(spark, path).count() == 6
    sink.write(spark.range(5), 1)
    assert sinks.read_files(spark, path).count() == 11
    with pytest.raises(ValueError, match="no batch"):
        sinks.read_files(spark, f"{tmp_path}/other")


def test_positions_do_not_depend_on_splits(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "concat('text ', id) AS text")
    found = []
    for n in (2, 3):
        twice = rows.union(rows.where("id % 2 = 0")).repartition(n)
        logs.publish_files(number_equal(to_log(twice, "t")), f"{tmp_path}/{n}", "t", "r")
        log = logs.read_files(spark, f"{tmp_path}/{n}", "t")
        found.append(sorted((bytes(r.value), r.id) for r in shape.add_id(log).collect()))
    assert found[0] == found[1] and len({name for _, name in found[0]}) == 1500


def test_failed_publish_can_be_repeated(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    body = '[{"RegId":1}]'
    rows = [("1", "T", "d", status, body) for status in (200, 500)]
    responded = spark.createDataFrame(rows, schemas.LANDED_RESPONSE)

    def run():
        paths = {"log": logs.FileLog(f"{root}/log"), "rejects": f"{root}/rejects"}
        return daily.publish_landed("warnings", responded, run="r", **paths)

    with monkeypatch.context() as patch:
        patch.setattr(logs, "publish_files", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run()
    with pytest.raises(ValueError, match="no run"):
        daily.read_rejects(spark, "warnings", f"{root}/rejects")
    for is_new in (True, False):
        assert run() is is_new
        assert logs.read_files(spark, f"{root}/log", TOPIC).count() == 1
        assert daily.read_rejects(spark, "warnings", f"{root}/rejects").count() == 1


def test_run_is_repeatable_after_a_failed_ingest(spark, tmp_path):
    root = str(tmp_path)
    rows = [(str(n), "T", "d", 200, f'[{{"RegId":{n}}}]') for n in range(5)]
    landed_rows = spark.createDataFrame(rows, schemas.LANDED_RESPONSE)
    landed_rows.write.parquet(f"{root}/landed/warnings/run=d")
    good = sinks.files(f"{root}/rows")
    broken = sinks.BatchSink(lambda *_: 1 / 0, good.batches)

    def run(sink):
        daily.run(
            spark, "warnings", "d", landed_root=f"{root}/landed", log=logs.FileLog(f"{root}/log"),
            rejects=f"{root}/rejects", sink=sink, checkpoints=f"{root}/checkpoints",
        )

    with pytest.raises(Exception, match="division by zero"):
        run(broken)
    for _ in range(2):
        run(good)
        assert sinks.read_files(spark, f"{root}/rows").count() == 5


def test_catalog_table(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, "a", range(100))
    name = f"{schemas.WARNING_NAMESPACE}.{schemas.WARNING_TABLE}"
    for _ in range(2):
        tables.create_namespace(spark, schemas.WARNING_NAMESPACE)
        tables.create_table(spark, name, schemas.WARNING_SINK)
    ingest(spark, root, sinks.table(name))
    stored = spark.table(name)
    assert stored.count() == 100
    assert stored.columns == [field.name for field in schemas.WARNING_SINK] + ["batch_id"]
    weather = f"{schemas.WEATHER_NAMESPACE}.{schemas.WEATHER_TABLE}"
    tables.create_namespace(spark, schemas.WEATHER_NAMESPACE)
    tables.create_table(spark, weather, schemas.weather_sink("int_strict"))
    assert dict(spark.table(weather).dtypes)["elevation"] == "int"
    assert len(spark.table(weather).columns) == 20


def test_failing_batch_fails_the_run_and_is_made_up_for(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, "a", range(100))
    good = sinks.files(f"{root}/rows")

    def write(batch, batch_id):
        good.write(batch, batch_id)
        if batch_id == 2:
            raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        ingest(spark, root, sinks.BatchSink(write, good.batches))
    ingest(spark, root, good)
    stored = spark.read.parquet(f"{root}/rows")
    assert stored.count() == 100 == len(set(ids(stored)))


def test_upsert_keeps_the_last_write(spark, tmp_path):
    root, keys = str(tmp_path), ["reg_id"]
    sink = keyed.upsert_files(f"{root}/table")

    def ingest_positions():
        rows = feeds.warning_rows(logs.stream_files(spark, root, TOPIC), with_position=True)
        runs.run_to_end(rows, sink, name="w", checkpoints=f"{root}/cp")

    def current():
        rows = keyed.read_latest(spark, f"{root}/table", keys).collect()
        return {row["reg_id"]: row["main_text"] for row in rows}

    assert keyed.compact(spark, f"{root}/table", keys) is None
    publish(spark, root, "a", range(10))
    ingest_positions()
    assert current() == {n: "first" for n in range(10)}
    assert keyed.compact(spark, f"{root}/table", keys) == 0
    publish(spark, root, "b", range(5, 15), "second")
    ingest_positions()
    expected = {n: "first" if n < 5 else "second" for n in range(15)}
    assert current() == expected
    assert keyed.compact(spark, f"{root}/table", keys) == 1
    assert keyed.compact(spark, f"{root}/table", keys) == 1
    assert current() == expected


def test_only_touched_buckets_are_shuffled_and_rewritten(spark, tmp_path):
    root, keys, order = str(tmp_path), ["k", "part"], ["batch_id", "v"]
    rows = spark.range(1000).select(
        F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("a").alias("part"), F.lit(0).alias("v")
    )
    sink = keyed.upsert_files(root)
    sink.write(rows, 0)
    keyed.compact(spark, root, keys, order, bucket_bytes=256)
    assert len(list((tmp_path / "base" / "through=0").glob("bucket=*"))) > 8
    plain = keyed.read_latest(spark, root, keys, order)
    assert "Exchange" not in plain._jdf.queryExecution().toString()
    sink.write(rows.filter("k IS NULL OR k = 10").withColumn("v", F.lit(1)), 1)
    sink.write(rows.limit(1).selectExpr("5000L AS k", "part", "2 AS v"), 2)
    latest = keyed.read_latest(spark, root, keys, order)
    assert {row["v"]: row["count"] for row in latest.groupBy("v").count().collect()} == {
        0: 998,
        1: 2,
        2: 1,
    }
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Broadcast" not in plan
    expected = {tuple(row) for row in latest.collect()}
    assert keyed.compact(spark, root, keys, order) == 2
    assert len(list((tmp_path / "base" / "through=2").glob("bucket=*"))) <= 3
    assert {tuple(row) for row in keyed.read_latest(spark, root, keys, order).collect()} == expected


def test_buckets_grow_with_the_data(spark, tmp_path):
    """The number of buckets follows the bytes; a base that has outgrown them is dealt anew."""
    root, keys, order = str(tmp_path), ["k"], ["batch_id"]
    sink = keyed.upsert_files(root)

    def write(batch, n):
        rows = spark.range(n).select(F.col("id").alias("k"), F.sha2(F.concat("id", F.lit(batch)), 256).alias("v"))
        sink.write(rows, batch)
        keyed.compact(spark, root, keys, order, bucket_bytes=40_000)
        return len(list((tmp_path / "base" / f"through={batch}").glob("bucket=*")))

    counts = [write(0, 100), write(1, 4_000), write(2, 20_000)]
    assert counts[0] == 1 and 4 <= counts[1] < counts[2]
    found = keyed.read_latest(spark, root, keys, order)
    assert found.count() == 20_000 == found.where("batch_id = 2").count()
    assert found.select("k").distinct().count() == 20_000


def test_small_changes_wait_for_a_fold(spark, tmp_path):
    root, keys, order = str(tmp_path), ["k"], ["batch_id"]
    sink = keyed.upsert_files(root)
    sink.write(spark.range(20_000).selectExpr("id AS k", "'a' AS v"), 0)
    assert keyed.compact(spark, root, keys, order, least_share=0.5) == 0
    sink.write(spark.range(10).selectExpr("id AS k", "'b' AS v"), 1)
    assert keyed.compact(spark, root, keys, order, least_share=0.5) == 0
    found = keyed.read_latest(spark, root, keys, order)
    assert found.count() == 20_000 and found.where("v = 'b'").count() == 10
    sink.write(spark.range(20_000).selectExpr("id AS k", "'c' AS v"), 2)
    assert keyed.compact(spark, root, keys, order, least_share=0.5) == 2
    assert keyed.read_latest(spark, root, keys, order).where("v = 'c'").count() == 20_000


def test_upsert_without_an_order_is_refused(spark, tmp_path):
    keyed.upsert_files(str(tmp_path)).write(spark.range(3), 0)
    with pytest.raises(ValueError, match="break ties"):
        keyed.read_latest(spark, str(tmp_path), ["id"])


def test_unfinished_base_is_not_read(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, "a", range(10))
    ingest(spark, root, keyed.upsert_files(f"{root}/table"))
    (tmp_path / "table" / "base" / "through=9").mkdir(parents=True)
    found = keyed.read_latest(spark, f"{root}/table", ["reg_id"], ["batch_id", "id"])
    assert found.count() == 10


def test_continuous_query(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, "a", range(10))
    rows = feeds.warning_rows(logs.stream_files(spark, root, TOPIC))
    query = runs.start(
        rows, sinks.files(f"{root}/rows"), name="on", checkpoints=f"{root}/checkpoints"
    )
    try:
        query.processAllAvailable()
        publish(spark, root, "b", range(10, 15))
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert spark.read.parquet(f"{root}/rows").count() == 15


def test_format_sink(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, "a", range(10))
    rows = feeds.warning_rows(logs.stream_files(spark, root, TOPIC))
    sink = sinks.FormatSink("parquet", {"path": f"{root}/plain"})
    runs.run_to_end(rows, sink, name="plain", checkpoints=f"{root}/checkpoints")
    assert spark.read.parquet(f"{root}/plain").count() == 10


def test_landed_stream_to_log(spark, tmp_path):
    """Responses are gated and published as they land."""
    root = str(tmp_path)
    sink = sinks.file_log(f"{root}/log", TOPIC, feeds.warning_log)
    for day, n in [("2025-01-24", 3), ("2025-01-25", 4)]:
        body = F.to_json(F.array(F.struct(F.col("id").cast("int").alias("RegId"))))
        responded = spark.range(n).select(
            F.lit("3022").alias("region_id"),
            F.lit("T").alias("region_name"),
            F.lit(day).alias("run_date"),
            F.when(F.col("id") == 0, 500).otherwise(200).alias("status"),
            body.alias("body"),
        )
        responded.write.mode("append").parquet(f"{root}/landed")
        documents = responses.warning_documents(landed.stream_landed(spark, f"{root}/landed"))
        runs.run_to_end(documents, sink, name="publish", checkpoints=f"{root}/checkpoints")
    rows = feeds.warning_rows(logs.read_files(spark, f"{root}/log", TOPIC))
    assert sorted(row["reg_id"] for row in rows.collect()) == [1, 1, 2, 2, 3]
    assert len(set(ids(rows))) == 5
    assert sink.batches(spark) == [0, 1]


def test_stream_records_have_no_position_yet(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, "a", range(3))
    log = to_log(logs.stream_files(spark, root, TOPIC), "again", text=F.col("value"))
    sink = sinks.FormatSink("parquet", {"path": f"{root}/again"})
    runs.run_to_end(log, sink, name="again", checkpoints=f"{root}/checkpoints")
    stored = spark.read.parquet(f"{root}/again")
    assert stored.count() == 3 and stored.filter("offset IS NULL").count() == 3


def test_daily_run(spark, tmp_path):
    """Two days of one feed, with a failed request on the second."""
    root = str(tmp_path)
    sink = sinks.split_files(f"{root}/rows")
    for day, status in [("2025-01-24", 200), ("2025-01-25", 500)]:
        requests = daily.plan_requests("weather", regions.active_regions(spark), day)
        got = requests.select(
            "region_id",
            F.col("name").alias("region_name"),
            F.col("day").alias("run_date"),
            F.when(F.col("cell_row") == 0, status).otherwise(200).alias("status"),
            F.to_json(F.struct(F.col("lat").alias("latitude"))).alias("body"),
        )
        got.write.parquet(f"{root}/landed/weather/run={day}")
        daily.run(
            spark,
            "weather",
            day,
            landed_root=f"{root}/landed",
            log=logs.FileLog(f"{root}/log"),
            rejects=f"{root}/rejects",
            sink=sink,
            checkpoints=f"{root}/checkpoints",
            mode="quarantine",
        )
    stored = sinks.read_split(spark, f"{root}/rows", rejected=False)
    assert stored.count() == 35 == len(set(ids(stored)))
    assert stored.filter("region_id = '3022' AND latitude IS NOT NULL").count() == 35
    assert sinks.read_split(spark, f"{root}/rows", rejected=True).count() == 0
    rejects = daily.read_rejects(spark, "weather", f"{root}/rejects")
    assert [row["reject_reason"] for row in rejects.collect()] == ["status"] * 5


def test_command_line(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, "a", range(10))
    command = ["warnings", "--log", f"files:{root}", "--checkpoints", f"{root}/cp", "--once"]
    main([*command, "--sink", f"files:{root}/rows"])
    assert spark.read.parquet(f"{root}/rows").count() == 10
    main([*command[:4], f"{root}/cp2", "--once", "--mode", "quarantine", "--sink", f"files:{root}/q"])
    assert sinks.read_split(spark, f"{root}/q", rejected=False).count() == 10
    main([*command[:4], f"{root}/cp3", "--once", "--sink", f"upsert:{root}/keyed"])
    assert keyed.read_latest(spark, f"{root}/keyed", ["reg_id"]).count() == 10
    main([*command[:4], f"{root}/cp4", "--once", "--mode", "quarantine", "--sink", "table"])
    checked = spark.table(f"{schemas.WARNING_NAMESPACE}.{schemas.WARNING_TABLE}_checked")
    assert checked.where("reject_reason IS NULL").count() == 10
    with pytest.raises(SystemExit):
        main([*command, "--sink", "cassandra", "--mode", "quarantine"])
    with pytest.raises(SystemExit):
        main([*command, "--sink", "elsewhere"])


def test_daily_commands(spark, tmp_path):
    root = str(tmp_path)
    main(["plan", "warnings", "--date", "2025-01-25", "--out", f"{root}/requests"])
    assert spark.read.parquet(f"{root}/requests").where("url LIKE '%2025-01-25'").count() == 1
    rows = [(str(n), "T", "d", 200, f'[{{"RegId":{n}}}]') for n in range(5)]
    responses_ = spark.createDataFrame(rows, schemas.LANDED_RESPONSE)
    for run in ("a", "b"):
        responses_.write.parquet(f"{root}/landed/warnings/run={run}")
    places = ["--log", f"files:{root}/log", "--rejects", f"{root}/rejects"]
    main(["publish", "warnings", "--run", "a", "--landed", f"{root}/landed/warnings/run=a", *places])
    main(
        ["run", "warnings", "--date", "b", "--landed-root", f"{root}/landed", *places]
        + ["--sink", f"files:{root}/rows", "--checkpoints", f"{root}/cp"]
    )
    assert sinks.read_files(spark, f"{root}/rows").count() == 10
    assert logs.open_log("kafka:a:1,b:2", max_offsets=5) == logs.KafkaLog("a:1,b:2", {"max_offsets": 5})
    with pytest.raises(ValueError, match="unknown log"):
        logs.open_log("files:")


def test_kafka_log_publishes_and_reads_its_topic(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(logs, "publish_kafka", lambda *given: sent.append(given))
    monkeypatch.setattr(logs, "read_kafka", lambda _, options: sent.append(options))
    log = logs.open_log("kafka:broker:29092", min_partitions=8)
    log.publish("records", "t", "run")
    log.stream(spark, "t")
    assert sent[0] == ("records", "t", "broker:29092", "run")
    assert sent[1]["minPartitions"] == "8" and sent[1]["subscribe"] == "t"
    assert not log.is_published(spark, "t", "run")
