"""Every record of a run once, however often the run was sent.

A publish to Kafka that failed half way is repeated as a whole, so the topic holds the records of the
first attempt twice. They are told by the run and by the record's name in it, which both attempts give
alike: the number among equal records, and a digest of the value. The stream keeps the names it has seen
and passes over what comes again.

Names are forgotten when a run has been quiet for ``within``, by the clock of the job that reads, not by
times in the records: a partition that is far behind the others, or a file that is old, is never late and
loses nothing. A record that comes again after that is passed on again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.sources import logs

_SEEN, _RUN, _NAME = "_seen_at", "_run", "_name"

def _header(name: str) -> Column:
    found = F.filter("headers", lambda h: h["key"] == name)
    return F.get(found, F.lit(0))["value"].cast("string")


def names(log: DataFrame) -> tuple[Column, Column]:
    """A record's run and its name in it; a record of unknown origin is named by its place."""
    place = F.concat_ws(":", *[F.col(c).cast("string") for c in ("topic", "partition", "offset")])
    if "headers" in log.columns:
        run, name = _header(logs.RUN_HEADER), _header(logs.RECORD_HEADER)
    elif "run" in log.columns:
        # Records of a file log that were given places of their own keep them apart.
        run = F.col("run")
        name = F.concat_ws(
            ":", F.col("offset").cast("string"), logs.record_name(F.col("partition"), F.col("value"))
        )
    else:
        run, name = F.lit(None), F.lit(None)
    known = run.isNotNull() & name.isNotNull()
    return F.when(known, run).otherwise(""), F.when(known, name).otherwise(place)


def drop_repeats(log: DataFrame, within: str) -> DataFrame:
    """The records of a log without those whose name came before; a stream or a batch.

    Of records with one name the first to be read stays. A batch forgets nothing. ``build_session`` keeps
    the names in RocksDB, as those of many days need not fit the memory of the executors.
    """
    run, name = names(log)
    named = log.withColumn(_RUN, run).withColumn(_NAME, name)
    if not log.isStreaming:
        return named.dropDuplicates([_RUN, _NAME]).select(*log.columns)
    seen = named.withColumn(_SEEN, F.current_timestamp()).withWatermark(_SEEN, within)
    return seen.dropDuplicatesWithinWatermark([_RUN, _NAME]).select(*log.columns)
