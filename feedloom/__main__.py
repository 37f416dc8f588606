"""Commands of the two feeds: ``spark-submit`` this file, or ``python -m feedloom``.

    python -m feedloom plan weather --date 2025-01-25 --out /shared/requests/2025-01-25
    python -m feedloom missing weather --first 2025-01-01 --last 2025-01-25 \\
        --landed-root /shared/landed --out /shared/requests/missing
    python -m feedloom publish weather --run 2025-01-25 --landed /shared/landed/weather/2025-01-25 \\
        --log kafka:broker:29092 --rejects /shared/rejects
    python -m feedloom weather --log kafka:broker:29092 --sink cassandra --checkpoints /shared/cp
    python -m feedloom run weather --date 2025-01-25 --landed-root /shared/landed \\
        --log files:/shared/log --rejects /shared/rejects --sink table --checkpoints /shared/cp

    python -m feedloom redrive weather --sink files:/shared/weather

The name of a feed alone stands for ``ingest``: log to sink, until stopped or with ``--once``.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from feedloom import schemas
from feedloom.operators import parse
from feedloom.plans import daily
from feedloom.plans.daily import FEEDS, Feed
from feedloom.session import build_session
from feedloom.sources import landed, logs, regions
from feedloom.streaming import keyed, runs, sinks, tables

SINKS = ("cassandra", "table", "files", "upsert")


def _log_options(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--log", required=True, help="kafka:<servers> or files:<root>")
    parser.add_argument("--min-partitions", type=int, help="Kafka: least tasks per micro-batch")
    parser.add_argument("--max-offsets", type=int, help="Kafka: most records per micro-batch")
    parser.add_argument("--max-bytes", type=int, help="files: most bytes per micro-batch")
    parser.add_argument(
        "--once-within", help="pass over records that a repeated publish sends within, say, '7 days'"
    )


def _sink_options(parser: argparse.ArgumentParser) -> None:
    parser.add_argument(
        "--sink", required=True, help="cassandra, table, files:<path> or upsert:<path>"
    )
    parser.add_argument("--checkpoints", required=True, help="shared folder for checkpoints")
    parser.add_argument("--mode", choices=["keep", "quarantine"], default="keep")
    parser.add_argument("--ids", choices=["stable", "random"], default="stable")
    _reading_options(parser)


def _reading_options(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--elevation", choices=["double", "int_strict"], default="double")
    parser.add_argument("--source-tz", help="zone of timestamps without an offset")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="feedloom", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)
    made = {}
    for name in ("plan", "missing", "publish", "ingest", "run", "redrive"):
        made[name] = commands.add_parser(name)
        made[name].add_argument("feed", choices=sorted(FEEDS))
    for name in ("plan", "run"):
        made[name].add_argument("--date", required=True, help="the day of the run, YYYY-MM-DD")
    made["missing"].add_argument("--first", required=True, help="the first run date, YYYY-MM-DD")
    made["missing"].add_argument("--last", required=True, help="the last run date")
    made["missing"].add_argument("--landed-root", required=True, help="<root>/<feed>/run=<date>")
    for name in ("plan", "missing"):
        made[name].add_argument("--regions", help="Parquet table of regions, else the active ones")
        made[name].add_argument("--out", required=True, help="where the request rows go")
    made["publish"].add_argument("--run", required=True, help="label of the run")
    made["publish"].add_argument("--landed", required=True, help="folder of landed responses")
    made["run"].add_argument("--landed-root", required=True, help="<root>/<feed>/run=<date>")
    for name in ("publish", "run"):
        made[name].add_argument("--rejects", required=True, help="folder for refused responses")
    for name in ("publish", "ingest", "run"):
        _log_options(made[name])
    for name in ("ingest", "run"):
        _sink_options(made[name])
    made["redrive"].add_argument("--sink", required=True, help="files:<path> of a quarantine")
    _reading_options(made["redrive"])
    made["ingest"].add_argument("--once", action="store_true", help="stop when all was written")
    return parser


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    argv = list(sys.argv[1:] if argv is None else argv)
    if argv and argv[0] in FEEDS:
        argv.insert(0, "ingest")
    parser = _parser()
    arguments = parser.parse_args(argv)
    if "log" in arguments and arguments.log.partition(":")[0] not in ("kafka", "files"):
        parser.error(f"unknown log {arguments.log!r}")
    if arguments.command == "redrive":
        if arguments.sink.partition(":")[0] != "files":
            parser.error("rejected records lie in a files sink")
    elif "sink" in arguments:
        if arguments.sink.partition(":")[0] not in SINKS:
            parser.error(f"unknown sink {arguments.sink!r}")
        if arguments.mode == "quarantine" and arguments.sink == "cassandra":
            parser.error("quarantine needs a sink with room for rejected rows")
    return arguments


def _log(arguments: argparse.Namespace) -> logs.Log:
    return logs.open_log(
        arguments.log,
        max_bytes=arguments.max_bytes,
        min_partitions=arguments.min_partitions,
        max_offsets=arguments.max_offsets,
        once_within=arguments.once_within,
    )


def _sink(
    spark: SparkSession, feed: Feed, arguments: argparse.Namespace
) -> sinks.BatchSink | sinks.FormatSink:
    kind, _, path = arguments.sink.partition(":")
    quarantine = arguments.mode == "quarantine"
    if kind == "cassandra":
        return sinks.cassandra(feed.namespace, feed.table)
    if kind == "table":
        name = f"{feed.namespace}.{feed.table}"
        is_weather = feed.topic == schemas.WEATHER_TOPIC
        columns = (
            schemas.weather_sink(arguments.elevation) if is_weather else schemas.WARNING_SINK
        )
        if quarantine:
            # Rejected rows stand in a table of their own name, beside the reason and the text.
            name += "_checked"
            reasons = [StructField(c, StringType()) for c in (parse.REJECT_REASON, parse.RAW)]
            columns = StructType([*columns.fields, *reasons])
        day_of = "start_date" if is_weather else "publish_time"
        tables.create_namespace(spark, feed.namespace)
        tables.create_table(spark, name, columns, day_of)
        return sinks.table(name, day_of)
    if kind == "upsert":
        return keyed.upsert_files(path)
    return sinks.split_files(path) if quarantine else sinks.files(path)


def _read_options(feed: Feed, arguments: argparse.Namespace) -> dict:
    options = {"source_tz": arguments.source_tz}
    if feed.topic == schemas.WEATHER_TOPIC:
        options["elevation"] = arguments.elevation
    return options


def _row_options(feed: Feed, arguments: argparse.Namespace) -> dict:
    return _read_options(feed, arguments) | {
        "mode": arguments.mode,
        "id_mode": arguments.ids,
        "with_position": arguments.sink.startswith("upsert:"),
    }


def main(argv: Sequence[str] | None = None) -> None:
    arguments = _arguments(argv)
    name, feed = arguments.feed, FEEDS[arguments.feed]
    spark = build_session(f"feedloom-{name}")
    if arguments.command in ("plan", "missing"):
        places = (
            regions.read_regions(spark, arguments.regions)
            if arguments.regions
            else regions.active_regions(spark)
        )
        if arguments.command == "plan":
            requests = daily.plan_requests(name, places, arguments.date)
        else:
            requests = daily.plan_missing(
                spark, name, places, arguments.first, arguments.last,
                landed_root=arguments.landed_root,
            )
        requests.write.mode("overwrite").parquet(arguments.out)
    elif arguments.command == "redrive":
        path = arguments.sink.partition(":")[2]
        brought = daily.redrive_rejects(spark, name, path, **_read_options(feed, arguments))
        print(f"{brought} rejected records are accepted now")
    elif arguments.command == "publish":
        responses = landed.read_landed(spark, arguments.landed)
        daily.publish_landed(
            name, responses, log=_log(arguments), rejects=arguments.rejects, run=arguments.run
        )
    elif arguments.command == "run":
        daily.run(
            spark,
            name,
            arguments.date,
            landed_root=arguments.landed_root,
            log=_log(arguments),
            rejects=arguments.rejects,
            sink=_sink(spark, feed, arguments),
            checkpoints=arguments.checkpoints,
            **_row_options(feed, arguments),
        )
    else:
        query = runs.start(
            feed.rows(
                daily.stream_log(spark, _log(arguments), feed.topic), **_row_options(feed, arguments)
            ),
            _sink(spark, feed, arguments),
            name=f"ingest_{name}",
            checkpoints=arguments.checkpoints,
            once=arguments.once,
        )
        query.awaitTermination()


if __name__ == "__main__":
    main()
