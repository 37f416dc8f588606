"""Exact centroid clustering of integer vectors through dictionaries of subvectors.

Components become whole numbers, ``floor(scale * x)``. The vectors are gathered into shards, and each
shard is written once in an encoded form without loss: the dimensions are cut into blocks, and for each
block the shard holds the distinct subvectors and every vector's code among them. A round computes the
squared distance of each distinct subvector to the same block of each centroid once and adds up these
partial distances by code. The sums for the new centroids follow from the codes likewise: how often a
cluster has a code, times its subvector. All arithmetic is in whole numbers, so results do not depend on
the order of rows or on how they are dealt.

A shard is bounded in rows and the encoded shards lie in the shared folder; between rounds only ``k``
centroids travel, and of each task's sums one number for a centroid and dimension. No row is shuffled.

- Vectors that are null, of another length, or hold null or non-finite components take no part.
- Neither do vectors with a component beyond 2^27 after scaling: their distances need not fit a long.
- Every row counts as a vector, also one with a key that occurs before or is null.
- Initial centroids are the vectors whose keys hash lowest; equal keys go by their components. With fewer
  than ``k`` vectors there are fewer centroids, with none there are no rows.
- Of equally near centroids the one with the smaller number wins; a centroid without vectors stays.
- Further columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from feedloom.llm.tables import stored

DIMENSIONS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
SEED = 1
WIDTH = 2  # dimensions in a block
SHARD_ROWS = 8_192
LARGEST = 1 << 27  # 64 squares of twice this are less than 2^63


class Clusters(NamedTuple):
    """``rows``: key, ``cluster``, ``distance``. The others by the number of the centroid."""

    rows: DataFrame
    centroids: list[list[int]]
    inertia: list[int]


def _numbers(vector: str, dimensions: int, scale: int) -> tuple[Column, Column]:
    """Whether a row takes part, and its components as whole numbers."""
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    fits = F.forall(
        vector,
        lambda x: F.coalesce(
            ~F.isnan(x) & (F.abs(x.cast("double")) <= LARGEST / scale), F.lit(False)
        ),
    )
    # One expression, so that a null or short vector never reaches the components.
    takes_part = F.when(F.size(vector) == dimensions, fits).otherwise(False)
    return F.coalesce(takes_part, F.lit(False)), scaled


class Shard(NamedTuple):
    """Vectors as codes: ``codes[b]`` are places in ``words[b]``, the distinct subvectors of block b."""

    words: list[np.ndarray]
    codes: list[np.ndarray]

    @classmethod
    def encoded(cls, vectors: np.ndarray, width: int) -> Shard:
        words, codes = [], []
        for at in range(0, vectors.shape[1], width):
            block = np.ascontiguousarray(vectors[:, at : at + width], np.int32)
            kind = {4: np.int32, 8: np.int64}.get(4 * block.shape[1], f"V{4 * block.shape[1]}")
            found, code = np.unique(block.view(kind).ravel(), return_inverse=True)
            words.append(found.view(np.int32).reshape(-1, block.shape[1]))
            codes.append(code.astype(np.int32))
        return cls(words, codes)

    def decoded(self) -> np.ndarray:
        return np.concatenate([w[c] for w, c in zip(self.words, self.codes)], axis=1)

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        """Squared distances, a row for each centroid."""
        total = np.zeros((len(centroids), len(self.codes[0])), np.int64)
        at = 0
        for words, codes in zip(self.words, self.codes):
            part = centroids[:, None, at : at + words.shape[1]] - words[None].astype(np.int64)
            total += (part * part).sum(axis=2)[:, codes]
            at += words.shape[1]
        return total

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """Componentwise sums of each cluster's vectors."""
        out = []
        for words, codes in zip(self.words, self.codes):
            n = len(words)
            times = np.bincount(cluster * n + codes, minlength=k * n).reshape(k, n)
            out.append(times @ words.astype(np.int64))
        return np.concatenate(out, axis=1)

    def packed(self) -> tuple[bytes, list[int], bytes]:
        """The words of all blocks, how many each block has, and all codes in as few bytes as they need."""
        sizes = [len(w) for w in self.words]
        kind = np.uint16 if max(sizes) <= 1 << 16 else np.int32
        codes = np.stack(self.codes).astype(kind)
        return b"".join(w.tobytes() for w in self.words), sizes, codes.tobytes()

    @classmethod
    def unpacked(cls, words: bytes, sizes: list[int], codes: bytes, dimensions: int, width: int):
        kind = np.uint16 if max(sizes) <= 1 << 16 else np.int32
        widths = [min(width, dimensions - at) for at in range(0, dimensions, width)]
        ends = np.cumsum([0, *(s * w for s, w in zip(sizes, widths))])
        flat = np.frombuffer(words, np.int32)
        tables = [flat[a:b].reshape(-1, w) for a, b, w in zip(ends, ends[1:], widths)]
        return cls(tables, list(np.frombuffer(codes, kind).reshape(len(sizes), -1).astype(np.intp)))


def _encode(dimensions: int, width: int, shard_rows: int, names: list[str]):
    """Rows (key, numbers) into shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, np.ndarray]] = []
        count = 0

        def shard() -> pa.RecordBatch:
            keys = pa.concat_arrays([k for k, _ in held])
            words, sizes, codes = Shard.encoded(np.concatenate([v for _, v in held]), width).packed()
            listed = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)
            columns = [
                listed, pa.array([words], pa.binary()), pa.array([sizes], pa.list_(pa.int32())),
                pa.array([codes], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            vectors = flat.reshape(-1, dimensions).astype(np.int32)
            for at in range(0, batch.num_rows, shard_rows):
                part = batch.column(0)[at : at + shard_rows], vectors[at : at + shard_rows]
                if count + len(part[0]) > shard_rows:
                    yield shard()
                    held.clear()
                    count = 0
                held.append(part)
                count += len(part[0])
        if count:
            yield shard()

    return run


def _shards(batch: pa.RecordBatch, dimensions: int, width: int) -> Iterator[tuple[pa.Array, Shard]]:
    keys = batch.column(0)
    for i in range(batch.num_rows):
        words, sizes, codes = (batch.column(c)[i].as_py() for c in (1, 2, 3))
        yield keys[i].values, Shard.unpacked(words, sizes, codes, dimensions, width)


def _nearest(shard: Shard, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found = shard.distances(centroids)
    cluster = found.argmin(axis=0)  # the first of equals
    return cluster, found[cluster, np.arange(found.shape[1])]


def _totals(dimensions: int, width: int, centroids: np.ndarray):
    """Shards into (cluster, place, total): sums by dimension, then the number and the distance."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, shard in _shards(batch, dimensions, width):
                cluster, distance = _nearest(shard, centroids)
                count = np.bincount(cluster, minlength=k)
                # Distances may be large: their sum is taken in two halves that cannot overflow.
                halves = [np.zeros(k, np.int64), np.zeros(k, np.int64)]
                for half, part in zip(halves, (distance >> 32, distance & 0xFFFFFFFF)):
                    np.add.at(half, cluster, part)
                table = np.concatenate(
                    [shard.sums(cluster, k), count[:, None], *(h[:, None] for h in halves)], axis=1
                )
                at, place = np.nonzero(table)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at.astype(np.int32)), pa.array(place.astype(np.int32)),
                     pa.array(table[at, place])],
                    ["cluster", "place", "total"],
                )

    return run


def _gathered(shards: DataFrame, dimensions: int, width: int, centroids: np.ndarray) -> np.ndarray:
    """Totals of all shards; ``k * (dimensions + 3)`` numbers come to the driver."""
    totals = (
        shards.mapInArrow(_totals(dimensions, width, centroids), "cluster int, place int, total long")
        .groupBy("cluster", "place")
        .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    )
    out = np.zeros((len(centroids), dimensions + 3), object)
    for row in totals.collect():
        out[row.cluster, row.place] = int(row.total)
    return out


def _assigned(dimensions: int, width: int, centroids: np.ndarray, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, shard in _shards(batch, dimensions, width):
                cluster, distance = _nearest(shard, centroids)
                columns = [keys, pa.array(cluster.astype(np.int32)), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def cluster(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", *, dimensions: int = DIMENSIONS,
    scale: int = SCALE, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED,
    width: int = WIDTH, shard_rows: int = SHARD_ROWS,
) -> Clusters:
    """Assign, move the centroids ``rounds`` times, and assign once more."""
    kind = df.schema[key].dataType
    rows = df.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    takes_part, scaled = _numbers("vector", dimensions, scale)
    numbers = rows.where(takes_part).select("key", scaled.alias("numbers"))

    shard_schema = StructType.fromDDL("words binary, sizes array<int>, codes binary")
    schema = StructType([StructField("keys", ArrayType(kind)), *shard_schema.fields])
    encode = _encode(dimensions, width, shard_rows, schema.names)
    shards = stored(numbers.mapInArrow(encode, schema), "subvectors")

    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    lowest = numbers.orderBy(F.sha2(name.cast("binary"), 256), "numbers").limit(k)
    start = [row.numbers for row in lowest.select("numbers").collect()]
    found = StructType(
        [StructField(key, kind), StructField("cluster", IntegerType()), StructField("distance", LongType())]
    )
    if not start:
        return Clusters(df.sparkSession.createDataFrame([], found), [], [])

    centroids = np.array(start, np.int64)
    for _ in range(rounds):
        totals = _gathered(shards, dimensions, width, centroids)
        for i, count in enumerate(totals[:, dimensions]):
            if count:
                centroids[i] = [total // count for total in totals[i, :dimensions]]
    totals = _gathered(shards, dimensions, width, centroids)
    inertia = [(high << 32) + low for high, low in totals[:, -2:].tolist()]
    assign = _assigned(dimensions, width, centroids, found.names)
    return Clusters(shards.mapInArrow(assign, found), centroids.tolist(), inertia)


def described(found: Clusters) -> DataFrame:
    """The rows with their cluster's and the whole inertia and a digest of the cluster's centroid.

    An inertia beyond a long is null. The table that is joined has a row for each centroid.
    """
    spark = found.rows.sparkSession
    fitting = lambda x: x if x < 1 << 63 else None
    centers = [
        (i, fitting(own), fitting(sum(found.inertia)),
         hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest())
        for i, (centroid, own) in enumerate(zip(found.centroids, found.inertia))
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return found.rows.join(F.broadcast(spark.createDataFrame(centers, schema)), "cluster")
