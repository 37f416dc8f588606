"""Keyed upsert on plain files: writes append, reads keep the last row of every key.

``deltas/batch_id=N`` holds the micro-batches as they came. ``compact`` folds them into a base that is
divided by a hash of the key, and rewrites only the buckets that have changed: ``base/through=N/bucket=B``
is bucket B as it was after batch N, and ``base/_manifests/N`` names the current files of all buckets.
A write needs no shuffle and never touches earlier files.

The number of buckets follows from the bytes that there are. A base that has outgrown its buckets is dealt
anew as a whole; as its size has at least doubled since the last time, that costs each row a constant
number of writes.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.latest import latest_by_key
from feedloom.sources import storage
from feedloom.streaming import sinks
from feedloom.streaming.tables import BATCH

BUCKET, THROUGH = "bucket", "through"

# A bucket is to hold about so many bytes of files.
BUCKET_BYTES = 128 << 20

# Where a record lies in its log, the last part last.
_POSITION = ["run", "partition", "offset"]


def _deltas(path: str) -> str:
    return f"{path}/deltas"


def upsert_files(path: str) -> sinks.BatchSink:
    return sinks.files(_deltas(path))


def _manifest(spark: SparkSession, path: str) -> dict:
    """What the base consists of: the last batch in it, and for each bucket the batch of its files."""
    folder = f"{path}/base/_manifests"
    last = max((int(name) for name in storage.child_names(spark, folder)), default=None)
    if last is None:
        return {THROUGH: -1, "buckets": {}, "of": 1}
    return json.loads(storage.read_text(spark, f"{folder}/{last}"))


def _bucket(keys: list[str], of: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(of)).cast("int")


def _order(rows: DataFrame, order: list[str] | None) -> list[str]:
    if order:
        return order
    if "offset" not in rows.columns:
        raise ValueError("name order columns that break ties, or keep the record's log position")
    return [BATCH, *[name for name in _POSITION if name in rows.columns]]


def _base_folders(path: str, manifest: dict, buckets: set[int]) -> list[str]:
    return [
        f"{path}/base/{THROUGH}={through}/{BUCKET}={bucket}"
        for bucket, through in manifest["buckets"].items()
        if int(bucket) in buckets
    ]


def _base(spark: SparkSession, path: str, manifest: dict, buckets: set[int]) -> DataFrame | None:
    folders = _base_folders(path, manifest, buckets)
    return spark.read.parquet(*folders) if folders else None


def _buckets_for(size: int, bucket_bytes: int) -> int:
    """The least power of two that leaves no bucket above its size, if keys are spread evenly."""
    return 1 << max(0, -(-size // bucket_bytes) - 1).bit_length()


def _changes(
    spark: SparkSession, path: str, manifest: dict, batches: list[int], keys: list[str],
    order: list[str] | None,
) -> tuple[DataFrame, set[int]]:
    """Current rows of the buckets that the batches touch, and those buckets."""
    deltas = sinks.read_files(spark, _deltas(path), batches)
    numbers = deltas.select(_bucket(keys, manifest["of"])).distinct().collect()
    touched = {row[0] for row in numbers}
    base = _base(spark, path, manifest, touched)
    rows = deltas if base is None else base.unionByName(deltas)
    return latest_by_key(rows, keys, _order(rows, order)), touched


def _new_batches(spark: SparkSession, path: str, manifest: dict) -> list[int]:
    batches = sinks.finished_batches(spark, _deltas(path))
    return [batch for batch in batches if batch > manifest[THROUGH]]


def read_latest(
    spark: SparkSession, path: str, keys: list[str], order: list[str] | None = None
) -> DataFrame:
    """The current row of every key.

    The row of the latest batch wins, and within a batch the last one in the log. Name ``order``
    columns to let the data decide; they have to break all ties, and may include ``batch_id``. Only
    buckets that have changed since the last compaction are shuffled.
    """
    manifest = _manifest(spark, path)
    batches = _new_batches(spark, path, manifest)
    present = {int(bucket) for bucket in manifest["buckets"]}
    if not batches:
        base = _base(spark, path, manifest, present)
        if base is None:
            raise ValueError(f"nothing has been written to {path}")
        return base
    changed, touched = _changes(spark, path, manifest, batches, keys, order)
    untouched = _base(spark, path, manifest, present - touched)
    return changed if untouched is None else untouched.unionByName(changed)


def compact(
    spark: SparkSession, path: str, keys: list[str], order: list[str] | None = None, *,
    least_share: float = 0.0, bucket_bytes: int = BUCKET_BYTES,
) -> int | None:
    """Fold all batches so far into the base and return the last one folded.

    ``least_share`` waits until the batches hold that share of the base's bytes: keys that are spread over
    all buckets make every fold rewrite the base, which then costs a row at most ``1 / least_share`` writes
    besides its own. Old files stay in place, so readers that started earlier go on undisturbed.
    """
    manifest = _manifest(spark, path)
    folded = manifest[THROUGH] if manifest[THROUGH] >= 0 else None
    batches = _new_batches(spark, path, manifest)
    if not batches:
        return folded
    present = {int(bucket) for bucket in manifest["buckets"]}
    old = storage.total_size(spark, _base_folders(path, manifest, present))
    new = storage.total_size(spark, [f"{_deltas(path)}/{BATCH}={batch}" for batch in batches])
    if old and new < least_share * old:
        return folded
    of = _buckets_for(old + new, bucket_bytes)
    if of > manifest["of"]:
        # All rows get other buckets.
        changed, touched = read_latest(spark, path, keys, order), set(range(of))
        manifest |= {"of": of, "buckets": {}}
    else:
        changed, touched = _changes(spark, path, manifest, batches, keys, order)
    last, target = batches[-1], f"{path}/base/{THROUGH}={batches[-1]}"
    by_bucket = changed.withColumn(BUCKET, _bucket(keys, manifest["of"]))
    # A bucket is written by one task, or by several if it is large.
    dealt = by_bucket.hint("rebalance", F.col(BUCKET))
    dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(target)
    written = set(storage.numbered(spark, target, BUCKET))
    manifest["buckets"] |= {str(bucket): last for bucket in touched & written}
    manifest[THROUGH] = last
    storage.write_text(spark, f"{path}/base/_manifests/{last}", json.dumps(manifest))
    return last
