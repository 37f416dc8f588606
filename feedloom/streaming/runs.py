"""Starting streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from feedloom.sources import storage
from feedloom.streaming.progress import BatchCounts, Report, counted
from feedloom.streaming.sinks import BatchSink, FormatSink


def checkpoint_path(root: str, name: str) -> str:
    """Every query has its own checkpoint: Spark does not notice when two queries share one."""
    return f"{root.rstrip('/')}/{name}"


def start(
    rows: DataFrame,
    sink: BatchSink | FormatSink,
    *,
    name: str,
    checkpoints: str,
    once: bool = False,
    report: Report | None = None,
) -> StreamingQuery:
    """Start appending a stream to a sink.

    Runs until stopped, or with ``once`` until everything there is at the start has been written. A
    ``report`` of the query's name gets the counts of its batches; whoever starts it removes it from the
    session's listeners.
    """
    spark = rows.sparkSession
    if report:
        rows = counted(rows)
        spark.streams.addListener(report)
    checkpoint = checkpoint_path(checkpoints, name)
    writer = (
        rows.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if once:
        writer = writer.trigger(availableNow=True)
    if isinstance(sink, FormatSink):
        return writer.format(sink.format).options(**sink.options).start()

    is_new = not storage.child_names(spark, f"{checkpoint}/offsets")
    if is_new and sink.batches(spark):
        # Batch numbers start again at 0 here and would overwrite rows of another query.
        raise ValueError(
            f"query {name!r} has no checkpoint at {checkpoint}, but its sink holds batches already"
        )
    return writer.foreachBatch(sink.write).start()


def run_to_end(
    rows: DataFrame, sink: BatchSink | FormatSink, *, name: str, checkpoints: str
) -> list[BatchCounts]:
    """Write everything the stream has now; an error in the query is raised here.

    Returns what each batch read, accepted and rejected.
    """
    report = Report(name)
    query = start(counted(rows), sink, name=name, checkpoints=checkpoints, once=True)
    query.awaitTermination()
    report.add(query)
    return report.batches
